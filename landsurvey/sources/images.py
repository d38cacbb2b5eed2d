"""Height and mask images for engines: 16-bit raw and PNG, one binary per tile."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..shipping import ship


def raw_u16(values: np.ndarray) -> bytes:
    """Little-endian 16-bit rows, as given."""
    return np.ascontiguousarray(values.astype("<u2")).tobytes()


def png(values: np.ndarray) -> bytes:
    """An 8-bit PNG of (row, col) grey or (row, col, 3) colour values."""
    values = np.ascontiguousarray(values.astype(np.uint8))
    h, w = values.shape[:2]
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = np.concatenate([np.zeros((h, 1), np.uint8), values.reshape(h, -1)], axis=1)  # filter 0 before each row
    head = struct.pack(">IIBBBBB", w, h, 8, 2 if values.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def tile_blobs(spark: SparkSession, cells: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """tile_x, tile_y, image from r, c and columns; kind is raw or png. A tile is
    bounded, and so is what one task holds."""

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        r, c = table["r"].to_numpy(), table["c"].to_numpy()
        grid = np.zeros((int(r.max()) + 1, int(c.max()) + 1, len(columns)), np.int64)
        for k, name in enumerate(columns):
            grid[r, c, k] = table[name].to_numpy()
        grid = grid[:, :, 0] if len(columns) == 1 else grid
        data = raw_u16(grid) if kind == "raw" else png(grid)
        return pa.table({"tile_x": pa.array([key[0].as_py()], pa.int32()), "tile_y": pa.array([key[1].as_py()], pa.int32()), "image": pa.array([data], pa.binary())})

    ship(spark)
    return cells.select("tile_x", "tile_y", "r", "c", *columns).groupBy("tile_x", "tile_y").applyInArrow(build, "tile_x int, tile_y int, image binary")
