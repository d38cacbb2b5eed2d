"""Classic TIFF rasters: header checks, reading to cells, writing one band or more."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

# Fixed values of the format: bytes of each field type, and sample formats.
FIELD = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 5: ("Q", 8), 12: ("d", 8), 11: ("f", 4), 9: ("i", 4), 8: ("h", 2), 6: ("b", 1)}
SAMPLE = {1: "uint", 2: "int", 3: "float"}
CELL_SCHEMA = "path string, row int, col int, e double, n double, z float"


def directory(data: bytes) -> dict[int, tuple] | None:
    """Fields of the first image by tag, or None if this is no classic TIFF."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8 or struct.unpack(order + "H", data[2:4])[0] != 42:
        return None
    try:
        at = struct.unpack(order + "I", data[4:8])[0]
        (count,) = struct.unpack(order + "H", data[at : at + 2])
        out: dict[int, tuple] = {0: (order,)}
        for k in range(count):
            entry = data[at + 2 + 12 * k : at + 14 + 12 * k]
            tag, kind, n = struct.unpack(order + "HHI", entry[:8])
            code, size = FIELD.get(kind, ("B", 1))
            where = entry[8:] if size * n <= 4 else data[(p := struct.unpack(order + "I", entry[8:])[0]) : p + size * n]
            out[tag] = (where[:n],) if code == "s" else struct.unpack(f"{order}{n}{code}", where[: size * n])
        return out
    except struct.error:
        return None


def info(data: bytes) -> dict | None:
    """width, height, dtype and nodata of the first image, or None."""
    tags = directory(data)
    if tags is None or 256 not in tags or 257 not in tags:
        return None
    try:
        nodata = float(tags[42113][0].rstrip(b"\0 ").decode("latin1")) if 42113 in tags else None
    except ValueError:
        nodata = None
    kind = SAMPLE.get(tags.get(339, (1,))[0], "uint")
    return {"width": tags[256][0], "height": tags[257][0], "dtype": f"{kind}{tags.get(258, (1,))[0]}", "nodata": nodata}


def _undo(raw: bytes, compression: int, predictor: int, rows: int, cols: int, bands: int, dtype: np.dtype) -> np.ndarray:
    if compression in (8, 32946):
        raw = zlib.decompress(raw)
    elif compression != 1:
        raise ValueError(f"TIFF compression {compression} is not read")
    width = dtype.itemsize
    if predictor == 3:  # bytes by significance, then differences
        rows_of = np.frombuffer(raw, np.uint8).reshape(rows, -1)
        plain = np.cumsum(rows_of, axis=1, dtype=np.uint8) if bands == 1 else None
        if plain is None:
            raise ValueError("predictor 3 is read for one band")
        planes = plain.reshape(rows, width, cols).transpose(0, 2, 1)
        return np.ascontiguousarray(planes).view(dtype.newbyteorder(">")).reshape(rows, cols, 1).astype(dtype.newbyteorder("="))
    block = np.frombuffer(raw, dtype)[: rows * cols * bands].reshape(rows, cols, bands)
    if predictor == 2:
        block = np.cumsum(block, axis=1, dtype=block.dtype)
    return block


def read(data: bytes) -> tuple[np.ndarray, tuple, float | None]:
    """Array (row, col, band), geotransform, nodata."""
    tags = directory(data)
    meta = info(data)
    if tags is None or meta is None:
        raise ValueError("no classic TIFF")
    order, w, h, bands = tags[0][0], meta["width"], meta["height"], tags.get(277, (1,))[0]
    kind = {"uint": "u", "int": "i", "float": "f"}[meta["dtype"].rstrip("0123456789")]
    dtype = np.dtype(f"{order}{kind}{int(tags.get(258, (8,))[0]) // 8}")
    compression, predictor = tags.get(259, (1,))[0], tags.get(317, (1,))[0]
    out = np.zeros((h, w, bands), dtype.newbyteorder("="))
    if 324 in tags:
        tw, th = tags[322][0], tags[323][0]
        across = -(-w // tw)
        for k, (a, n) in enumerate(zip(tags[324], tags[325], strict=True)):
            block = _undo(data[a : a + n], compression, predictor, th, tw, bands, dtype)
            r, c = k // across * th, k % across * tw
            out[r : r + th, c : c + tw] = block[: h - r, : w - c]
    else:
        per = tags.get(278, (h,))[0]
        for k, (a, n) in enumerate(zip(tags[273], tags[279], strict=True)):
            rows = min(per, h - k * per)
            out[k * per : k * per + rows] = _undo(data[a : a + n], compression, predictor, rows, w, bands, dtype)
    sx, sy = tags.get(33550, (1.0, 1.0, 0.0))[:2]
    i, j, _, x, y, _ = tags.get(33922, (0.0,) * 6)[:6]
    return out, (x - i * sx, sx, 0.0, y + j * sy, 0.0, -sy), meta["nodata"]


def write(values: np.ndarray, transform: tuple, nodata: float | None = None) -> bytes:
    """A deflated strip TIFF, little-endian, of an array (row, col) or (row, col, band)."""
    values = values if values.ndim == 3 else values[:, :, None]
    h, w, bands = values.shape
    kind = {"u": 1, "i": 2, "f": 3}[values.dtype.kind]
    body = zlib.compress(np.ascontiguousarray(values.astype(values.dtype.newbyteorder("<"))).tobytes(), 6)
    fields = [
        (256, "I", (w,)), (257, "I", (h,)), (258, "H", (values.dtype.itemsize * 8,) * bands), (259, "H", (8,)), (262, "H", (1,)), (273, "I", (0,)),
        (277, "H", (bands,)), (278, "I", (h,)), (279, "I", (len(body),)), (284, "H", (1,)), (339, "H", (kind,) * bands),
        (33550, "d", (transform[1], -transform[5], 0.0)), (33922, "d", (0.0, 0.0, 0.0, transform[0], transform[3], 0.0)),
    ]
    if nodata is not None:
        fields.append((42113, "s", (f"{nodata:g}".encode() + b"\0",)))
    code = {"H": 3, "I": 4, "d": 12, "s": 2}
    extra_at, extra, entries = 8 + 2 + 12 * len(fields) + 4, b"", []
    pack = lambda k, v: v[0] if k == "s" else struct.pack(f"<{len(v)}{k}", *v)
    size = extra_at + sum(len(x) + len(x) % 2 for _, k, v in fields if len(x := pack(k, v)) > 4)
    for tag, k, v in fields:
        raw = pack(k, (size,) if tag == 273 else v)
        if len(raw) > 4:
            where = struct.pack("<I", extra_at + len(extra))
            extra += raw + b"\0" * (len(raw) % 2)
        else:
            where = raw.ljust(4, b"\0")
        entries.append(struct.pack("<HHI", tag, code[k], len(raw) if k == "s" else len(v)) + where)
    return b"II*\0" + struct.pack("<IH", 8, len(fields)) + b"".join(entries) + struct.pack("<I", 0) + extra + body


def tile_status(spark: SparkSession, pattern: str, size: tuple[int, int], dtype: str = "float32") -> DataFrame:
    """path, bytes, status: ok, BAD (a TIFF of another shape), EMPTY (no TIFF)."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data in batch.column("content").to_pylist():
                found = info(data)
                good = found is not None and (found["width"], found["height"]) == size and found["dtype"] == dtype
                out.append("EMPTY" if found is None else "ok" if good else "BAD")
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array(out, pa.string())], names=["path", "bytes", "status"])

    ship(spark)
    files = spark.read.format("binaryFile").load(pattern).select("path", "length", "content")
    return files.mapInArrow(judge, "path string, bytes bigint, status string")


def read_cells(spark: SparkSession, pattern: str) -> DataFrame:
    """CELL_SCHEMA rows of the first band of all files; no data is null."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                values, gt, nodata = read(data)
                z = values[:, :, 0].astype(np.float32)
                bad = ~np.isfinite(z) | (z < -1e30)
                if nodata is not None:
                    bad |= np.abs(z - np.float32(nodata)) <= 1e-6
                h, w = z.shape
                row, col = np.divmod(np.arange(h * w, dtype=np.int32), w)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * (h * w)), pa.array(row), pa.array(col), pa.array(gt[0] + (col + 0.5) * gt[1]),
                        pa.array(gt[3] + (row + 0.5) * gt[5]), pa.array(z.ravel(), mask=bad.ravel()),
                    ],
                    names=["path", "row", "col", "e", "n", "z"],
                )

    ship(spark)
    return spark.read.format("binaryFile").load(pattern).select("path", "content").mapInArrow(cells, CELL_SCHEMA)


def tile_images(spark: SparkSession, cells: DataFrame, bands: list[str], dtype: str, transform_of) -> DataFrame:
    """tile_x, tile_y, image: one TIFF per tile from tile_x, tile_y, r, c and band columns."""

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        r, c = table["r"].to_numpy(), table["c"].to_numpy()
        grid = np.zeros((int(r.max()) + 1, int(c.max()) + 1, len(bands)), dtype)
        for k, b in enumerate(bands):
            grid[r, c, k] = table[b].to_numpy()
        x, y = key[0].as_py(), key[1].as_py()
        return pa.table({"tile_x": pa.array([x], pa.int32()), "tile_y": pa.array([y], pa.int32()), "image": pa.array([write(grid, transform_of(x, y))], pa.binary())})

    ship(spark)
    return cells.select("tile_x", "tile_y", "r", "c", *bands).groupBy("tile_x", "tile_y").applyInArrow(build, "tile_x int, tile_y int, image binary")
