"""SimHash near-dedup with multi-index hashing.

Fingerprints: lower-case A-Z, words [^\\x20\\x09-\\x0D]+, shingles of ``width``
words (repeats count; a shorter text is one shingle), XXH64 with seed 42, and a
bit for each hash bit set in over half of them. No words: fingerprint zero.

Links: equal fingerprints are one vertex. For fingerprints at most r bits apart
the 64 bits are cut into (r + 1) / 2 segments, rounded up, of which one differs
in at most one bit. Each segment value is filed in a table; every fingerprint
looks up all values within one bit of its own, and what it meets is verified on
all 64 bits. Work is by distinct fingerprint, so copies cost nothing.

Components come from smallest-label propagation with pointer jumping over the
linked fingerprints, each round written to the shared folder. It runs first on a
few links of each fingerprint, to hubs, and then on links between what those
leave apart, so that a crowd of n near copies does not emit n * n pairs.

Defined results: null text is empty; texts without words share fingerprint zero
and so link with each other; repeated rows are answered row by row; null ids
never name a component unless it has no other id; extra columns are ignored by
``near_duplicates`` and carried by ``dedup``. Empty input gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .common import join_counted, map_batches, materialise, plain_columns, with_row_ids

SEED = 42
CHUNK, BLOCK = 255 * 64, 1 << 20
BLANK = re.compile(rb"[ \t\n\r\x0b\x0c]")


def _blocks(text: bytes):
    """The text in blocks that end before a blank, so that long ones are not held as words."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > BLOCK:
            blank = BLANK.search(text, at + BLOCK)
            end = blank.start() if blank else end
        yield text[at:end]
        at = end


def shingle_digests(text: bytes, width: int):
    """The XXH64 digests of the shingles of one UTF-8 text, repeats included, in blocks."""
    words, none = [], True
    for block in _blocks(text):
        words = words + block.lower().split()  # on bytes: A-Z and ASCII white space only
        if len(words) >= width:
            none = False
            yield from _digests(words, width)
            words = words[len(words) - width + 1 :]
    if none and words:
        yield xxhash.xxh64_digest(b" ".join(words), SEED)


def _digests(words: list[bytes], width: int):
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts, ends = np.concatenate([[0], ends[: len(words) - width] + 1]).tolist(), ends[width - 1 :].tolist()
    for i in range(0, len(starts), CHUNK):
        yield b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[i : i + CHUNK], ends[i : i + CHUNK], strict=True)])


def common_bits(digests) -> int:
    """The fingerprint of blocks of digests: a bit for each that is set in over half of them."""
    total, n = np.zeros(64, np.int64), 0
    for part in digests:
        n += len(part) // 8
        bits = np.unpackbits(np.frombuffer(part, np.uint8)).reshape(-1, 64)
        if pad := -len(bits) % 255:
            bits = np.concatenate([bits, np.zeros((pad, 64), np.uint8)])
        # 255 rows at a time fit eight one-byte counters in each 64-bit word
        sums = np.add.reduce(bits.view(np.uint64).reshape(-1, 255, 8), axis=1)
        total += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big") if n else 0


def fingerprint(text: bytes, width: int = 3) -> int:
    """Unsigned 64-bit fingerprint of one UTF-8 text."""
    return common_bits(shingle_digests(text, width))


def fingerprints(spark: SparkSession, docs: DataFrame, width: int = 3) -> DataFrame:
    """row_id, doc_id and the fingerprint as a signed bigint, for docs with text."""

    def run(batches):
        for batch in batches:
            out = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", width) for t in batch.column("text").cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("doc_id"), pa.array(np.array(out, np.uint64).view(np.int64))], names=["row_id", "doc_id", "fp"]
            )

    return map_batches(spark, docs.select("row_id", "doc_id", "text"), run, "row_id bigint, doc_id bigint, fp bigint")


def segment_keys(fp: Column, max_bits: int) -> list[tuple[Column, int]]:
    """(value with the segment's number above it, its width) of each segment."""
    n = max(1, (max_bits + 2) // 2)
    out, low = [], 0
    for i in range(n):
        width = (64 - low) // (n - i)
        value = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))
        out.append((value + F.lit(i << 40) if width < 40 else value, width))
        low += width
    return out


def within_one_bit(key: Column, width: int) -> Column:
    """All values that differ from key in at most one of its lower width bits."""
    masks = [0, *[1 << i if i < 63 else -(1 << 63) for i in range(width)]]
    return F.transform(F.array(*[F.lit(m) for m in masks]), lambda m: key.bitwiseXOR(m))


def _probes(distinct: DataFrame, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(table of b by key, look-ups of a by key) of the segments; other columns stay."""
    keys = segment_keys(F.col("fp"), max_bits)
    rest = [F.col(c) for c in distinct.columns if c != "fp"]
    table = distinct.select(F.col("fp").alias("b"), *rest, F.explode(F.array(*[k for k, _ in keys])).alias("key"))
    ball = F.flatten(F.array(*[within_one_bit(k, width) for k, width in keys]))
    return table, distinct.select(F.col("fp").alias("a"), *rest, F.explode(ball).alias("key"))


def _near(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def links(distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints at most max_bits apart. With a
    column label, only pairs of different labels."""
    table, probes = _probes(distinct, max_bits)
    pairs = (F.col("a") < F.col("b")) & _near("a", "b", max_bits)
    if "label" in distinct.columns:
        table = table.withColumnRenamed("label", "other")
        pairs = pairs & (F.col("label") != F.col("other"))
    return probes.join(table.hint("merge"), "key").filter(pairs).select("a", "b").distinct()


def hub_links(distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """At most two links (a, b) of each fingerprint a, so that a crowd of near copies
    falls together without a row for each pair of it.

    Every table value names two hubs, its least members under two scramblings;
    each fingerprint links to the least hub under either that is near it."""
    table, probes = _probes(distinct.select("fp"), max_bits)
    least = lambda seed: F.min(F.struct(F.xxhash64("b", F.lit(seed)).alias("h"), "b"))
    hubs = table.groupBy("key").agg(least(1).alias("one"), least(2).alias("two"))
    met = probes.join(hubs.hint("merge"), "key")
    fits = lambda c: F.min(F.when((F.col("a") != F.col(f"{c}.b")) & _near("a", f"{c}.b", max_bits), F.col(c)))
    chosen = met.groupBy("a").agg(fits("one").alias("one"), fits("two").alias("two"))
    return chosen.select("a", F.explode(F.array("one.b", "two.b")).alias("b")).filter("b IS NOT NULL").distinct()


def clusters(spark: SparkSession, distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """(v, label) of the linked fingerprints of distinct (fp): first by hubs, then by
    the links between what is still apart, which is exact."""
    hubbed = components(spark, hub_links(distinct, max_bits))
    named = distinct.join(hubbed.withColumnRenamed("v", "fp"), "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"))
    named = materialise(spark, named, "hub-labels")
    far = materialise(spark, links(named, max_bits), "links-apart")
    name_of = lambda v: named.select(F.col("fp").alias(v), F.col("label").alias(f"l{v}"))
    apart = far.join(name_of("a"), "a").join(name_of("b"), "b").select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()
    joined = components(spark, apart).select(F.col("v").alias("label"), F.col("label").alias("final"))
    # a label is linked or not; a vertex alone under its own name needs no row
    return named.join(joined, "label", "left").select(F.col("fp").alias("v"), F.coalesce("final", "label").alias("label"))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(v, label): the smallest vertex reachable from each vertex of edges (a, b)."""
    both = materialise(spark, edges.select(F.col("a").alias("v"), F.col("b").alias("w")).union(edges.select(F.col("b").alias("v"), F.col("a").alias("w"))), "links")
    labels = materialise(spark, both.groupBy("v").agg(F.least(F.col("v"), F.min("w")).alias("label")), "labels")
    while True:
        around = both.join(labels.select(F.col("v").alias("w"), "label"), "w").groupBy("v").agg(F.min("label").alias("met"))
        stepped = labels.join(around, "v").select("v", F.col("label").alias("old"), F.least("label", "met").alias("label"))
        jump = labels.select(F.col("v").alias("label"), F.col("label").alias("further"))
        moved = stepped.join(jump, "label").select("v", "old", F.least("label", "further").alias("label"))
        seen = Observation()
        done = materialise(spark, moved.observe(seen, F.count_if(F.col("label") != F.col("old")).alias("moved")), "labels")
        labels = done.select("v", "label")
        if not seen.get.get("moved"):
            return labels


def near_duplicates(spark: SparkSession, docs: DataFrame, width: int = 3, max_bits: int = 3, row_id: Column | None = None) -> DataFrame:
    """Per row of docs: row_id (the given one, or its own), doc_id, fp, component_id
    (smallest doc_id of its component), component_row (smallest row_id of that doc_id)."""
    row_id = F.monotonically_increasing_id() if row_id is None else row_id
    keyed = plain_columns(docs, row_id=row_id, doc_id=F.col("doc_id").cast("bigint"), text=F.col("text"))
    prints = materialise(spark, fingerprints(spark, keyed, width), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id"))
    distinct = materialise(spark, prints.groupBy("fp").agg(first.alias("first"), F.count(F.lit(1)).alias("n")), "distinct-fingerprints")
    labels = clusters(spark, distinct.select("fp"), max_bits)
    owned = distinct.join(labels.withColumnRenamed("v", "fp"), "fp", "left").select("fp", "n", "first", F.coalesce("label", "fp").alias("label"))
    linked = owned.filter(F.col("label") != F.col("fp")).select("label", "first")
    best = linked.groupBy("label").agg(F.min("first").alias("best"))
    tops = distinct.select(F.col("fp").alias("label"), F.col("first").alias("own")).join(best, "label").select("label", F.least("own", "best").alias("top"))
    facts = materialise(
        spark,
        owned.join(tops, "label", "left").select("fp", "n", F.coalesce("top", "first").alias("top")),
        "components",
    )
    return join_counted(prints, facts, "fp", prints.count()).select(
        "row_id", "doc_id", "fp", F.col("top.doc_id").alias("component_id"), F.col("top.row_id").alias("component_row")
    )


def report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits), component_id."""
    found = near_duplicates(spark, docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def dedup(spark: SparkSession, docs: DataFrame, width: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of docs that stay, one of each component, all columns unchanged."""
    held = with_row_ids(spark, docs, "near-input")
    keyed = held.select("row_id", F.col("doc.doc_id").alias("doc_id"), F.col("doc.text").alias("text"))
    found = near_duplicates(spark, keyed, width, max_bits, F.col("row_id"))
    return held.join(found.filter(F.col("row_id") == F.col("component_row")).select("row_id"), "row_id", "left_semi").select("doc.*")
