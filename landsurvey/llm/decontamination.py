"""Benchmark decontamination: Wu-Manber search for windows of benchmark words.

The symbols are words, not bytes. Windows of one length L form a set; blocks of
two adjacent words (one, for L = 1) index a shift table that tells how far the
search may move on, blocks that can end a window index buckets of windows with
that ending, and a candidate counts only after all its words are compared: first
by hash, then byte by byte.

Many rows are searched at once: each step moves one position of every lane.

Spark makes the distinct windows and deals them into shards of bounded windows and
bytes in the shared folder. One shard at a time comes to the driver, becomes tables
and is broadcast, and each shard is a pass over the documents, so neither the driver
nor an executor holds more than one, however large the benchmark.

Defined results: null or empty text has no words and hits nothing; an item with
no words has no window; items with equal windows all count; windows of an item
without an id are found but name no item; repeated rows are answered row by row;
texts of any length are searched whole, in bounded steps; extra columns of any name
are ignored by ``report`` and carried by ``decontaminate``; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, map_batches, materialise, mix64, plain_columns, utf8_slices
from .words import ALNUM, FOLD, word_bounds, word_hashes

WINDOW = 10
SHARD_WINDOWS, SHARD_BYTES = 200_000, 32 << 20
SLICE_BYTES = 1 << 20
LANE_WORDS = 512
_STEP = np.uint64(0x9E3779B97F4A7C15)


def split_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = FOLD[raw]
    starts, ends = word_bounds(low, ALNUM, np.empty(0, np.int64))
    return low, starts, ends


def windows_of(raw: bytes, size: int = WINDOW) -> Iterator[tuple[int, bytes]]:
    """(number of words, words joined by blanks) of the windows of a UTF-8 text."""
    low, starts, ends = split_words(np.frombuffer(raw, np.uint8))
    n = min(size, len(starts))
    for i in range(len(starts) - n + 1 if n else 0):
        yield n, b" ".join([low[a:b].tobytes() for a, b in zip(starts[i : i + n], ends[i : i + n], strict=True)])


class WindowSet:
    """Wu-Manber tables for windows of one length."""

    def __init__(self, length: int, joined: list[bytes], items: list[list[int]]):
        self.length, windows = length, joined
        self.block = min(2, self.length)
        self.bits = max(12, min(22, int(np.ceil(np.log2(len(windows) * self.length + 1))) + 4))
        raw = np.frombuffer(b"\n".join(joined), np.uint8)
        low, starts, ends = split_words(raw)
        hashes = word_hashes(low, starts, ends).reshape(len(windows), self.length)
        blocks = self.blocks(hashes.ravel()).reshape(hashes.shape)
        most = self.length - self.block + 1
        self.shift = np.full(1 << self.bits, most, np.uint8 if most < 256 else np.int64)
        for j in range(self.block - 1, self.length):  # later blocks allow less
            np.minimum.at(self.shift, blocks[:, j], self.length - 1 - j)
        # buckets: windows in order of their last block
        order = np.argsort(blocks[:, -1], kind="stable")
        self.hashes, self.joined, self.items = hashes[order], [joined[i] for i in order], [items[i] for i in order]
        self.bucket = np.searchsorted(blocks[order, -1], np.arange((1 << self.bits) + 1))

    def blocks(self, hashes: np.ndarray) -> np.ndarray:
        """Table index of the block that ends at each word."""
        key = hashes.copy()
        if self.block == 2:
            key[1:] += hashes[:-1] * _STEP
        return (mix64(key) >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last word, window) of every hash match; rows: bounds of rows in words."""
        blocks = self.blocks(hashes)
        length, found_at, found_w = self.length, [], []
        # lanes: stretches of a row; a stretch looks at windows that end inside it
        first = rows[:-1] + length - 1
        n = np.maximum(0, rows[1:] - first)
        lanes = -(-n // LANE_WORDS)
        row = np.repeat(np.arange(len(n)), lanes)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = first[row] + nth * LANE_WORDS
        stop = np.minimum(at + LANE_WORDS, rows[1:][row])
        while len(at):
            key = blocks[at]
            move = self.shift[key].astype(np.int64)
            hit = np.flatnonzero(move == 0)
            if len(hit):
                p, k = at[hit], key[hit]
                lo, hi = self.bucket[k], self.bucket[k + 1]
                while len(p):  # the next window of each bucket
                    live = lo < hi
                    p, lo, hi = p[live], lo[live], hi[live]
                    same = self.hashes[lo, 0] == hashes[p - length + 1]
                    for j in range(1, length):
                        if not same.any():
                            break
                        same &= self.hashes[lo, j] == hashes[p - length + 1 + j]
                    found_at.append(p[same])
                    found_w.append(lo[same])
                    lo = lo + 1
            at = at + np.maximum(move, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        if not found_at:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(found_at), np.concatenate(found_w)


def shards(spark: SparkSession, benchmark: DataFrame, size: int = WINDOW) -> Iterator[list[WindowSet]]:
    """The windows of all items, shard by shard, as sets by length."""

    def run(batches):
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            out: list[tuple] = []
            for i, text in enumerate(batch.column("text").cast(pa.large_binary())):
                for n, window in windows_of(text.as_buffer().to_pybytes() if text.is_valid else b"", size):
                    out.append((ids[i], n, window))
                    if len(out) == 10_000:
                        yield _window_rows(out)
                        out = []
            yield _window_rows(out)

    rows = plain_columns(benchmark, item_id=F.col("item_id").cast("bigint"), text=F.col("text"))
    windows = map_batches(spark, rows, run, "item_id bigint, n bigint, window binary")
    windows = materialise(spark, windows.groupBy("n", "window").agg(F.array_sort(F.collect_set("item_id")).alias("items")), "benchmark-windows")
    total = windows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("window") + 8 * F.size("items")).alias("bytes")).first()
    count = max(-(-total["n"] // SHARD_WINDOWS), -(-(total["bytes"] or 0) // SHARD_BYTES))
    if count > 1:
        path = fresh_path(spark, "benchmark-shards")
        windows.withColumn("shard", F.pmod(F.xxhash64("n", "window"), F.lit(count)).cast("int")).write.partitionBy("shard").parquet(path)
        windows = spark.read.schema("n bigint, window binary, items array<bigint>, shard int").parquet(path)
    for k in range(max(1, count)):
        table = (windows.filter(F.col("shard") == k) if count > 1 else windows).select("n", "window", "items").toArrow().sort_by([("n", "ascending"), ("window", "ascending")])
        lengths = table["n"].to_numpy()
        edges = np.flatnonzero(np.diff(lengths, prepend=-1, append=-1)).tolist() if len(lengths) else []
        parts = [table.slice(a, b - a) for a, b in zip(edges, edges[1:])]
        yield [WindowSet(int(t["n"][0].as_py()), t["window"].to_pylist(), t["items"].to_pylist()) for t in parts]


def _window_rows(rows: list[tuple]) -> pa.RecordBatch:
    ids, sizes, windows = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(windows, pa.binary())], names=["item_id", "n", "window"])


def find_hits(sets: list[WindowSet], raw: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray, set]]:
    """For each row of a slice: number of words, hit words (indices), item ids."""
    low = FOLD[raw]
    starts, ends = word_bounds(low, ALNUM, bounds)
    hashes = word_hashes(low, starts, ends)
    rows = np.searchsorted(starts, bounds)
    edge = np.zeros(len(starts) + 1, np.int64)
    items: dict[int, set] = {}
    for s in sets:
        if len(starts) < s.length:
            continue
        at, windows = s.search(hashes, rows)
        for p, w in zip(at.tolist(), windows.tolist(), strict=True):
            a = p - s.length + 1
            if b" ".join([low[starts[i] : ends[i]].tobytes() for i in range(a, p + 1)]) == s.joined[w]:
                edge[a] += 1
                edge[p + 1] -= 1
                items.setdefault(int(np.searchsorted(rows, p, "right")) - 1, set()).update(s.items[w])
    hit = np.cumsum(edge[:-1]) > 0
    for i in range(len(bounds) - 1):
        yield int(rows[i + 1] - rows[i]), np.flatnonzero(hit[rows[i] : rows[i + 1]]), items.get(i, set())


def _search_rows(shared, first: bool):
    def run(batches):
        sets = shared.value
        for batch in batches:
            old = None if first else batch.column("hits").to_pylist()
            old_items = None if first else batch.column("items").to_pylist()
            n_words, hits, items = [], [], []
            for row, bounds, raw in utf8_slices(batch.column("text"), SLICE_BYTES):
                for i, (n, at, found) in enumerate(find_hits(sets, raw, bounds)):
                    if not first:
                        at, found = np.union1d(at, np.asarray(old[row + i], np.int64)), found | set(old_items[row + i])
                    n_words.append(n)
                    hits.append(at.tolist())
                    items.append(sorted(found))
            keep = [c for c in batch.schema.names if c not in ("n_words", "hits", "items")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.int64()))],
                names=[*keep, "n_words", "hits", "items"],
            )

    return run


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """docs (any columns, with text) plus n_words, hits (indices of hit words) and
    items (ids of the items with windows in the text)."""
    out, before = docs.drop("n_words", "hits", "items"), None
    for sets in shards(spark, benchmark, size):
        if before:  # write what the shard before finds, and let it go
            out = materialise(spark, out, "decontamination-pass")
            before.destroy()
        names = [f for f in out.schema.fields if f.name not in ("n_words", "hits", "items")]
        schema = ", ".join([f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in names] + ["n_words bigint, hits array<bigint>, items array<bigint>"])
        shared = spark.sparkContext.broadcast(sets)
        out, before = map_batches(spark, out, _search_rows(shared, before is None), schema), shared
    return out


def report(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per row of docs."""
    found = contamination(spark, plain_columns(docs, doc_id=F.col("doc_id"), text=F.col("text")), benchmark)
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("bigint").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs in which no benchmark window occurs, columns unchanged."""
    own = [f"c{i}" if name != "text" else "text" for i, name in enumerate(docs.columns)]
    return contamination(spark, docs.toDF(*own), benchmark).filter(F.size("hits") == 0).select(*own).toDF(*docs.columns)
