"""Near copies of five-word sets: fingerprints propose, exact Jaccard decides.

Sets: lower-case A-Z, words [^\\x20\\x09-\\x0D]+, the distinct XXH64 hashes of the
shingles of ``width`` words (a shorter text is one shingle). Two documents are
linked where 5 times their common shingles are at least 4 times those of both
together: similarity 0.8. Groups are the components of the links.

Proposals come from SimHash fingerprints and from prefixes. Multi-index hashing over
fingerprints of 64 bits proposes pairs within max_bits. Fingerprints alone cannot
reach all links (near 0.8 they lie about 9 bits apart), so the rest is completed by a
prefix filter: with all shingles in one order, sets of such similarity share one of
the first n - ceil(0.8 n) + 1 of each. Any order is right; rare shingles come first,
by counts in a sample, so that few documents meet. Lengths, positions and the complete
distance of two fingerprints rule out most that do: of 128 bits a pair of similarity
0.8 differs in 19 on average, and in over FAR with a probability under 1e-9; sets of
under SMALL shingles, too small for that, skip this test. What is left is compared
whole. A shingle shared by a crowd first pairs its members with hubs, a few members
of it, and only members of different groups then meet pair by pair, where their odd
sketches (one parity bit for each place that hashes fall on) allow 0.8: two sketches
differ in no more bits than their sets in members, so this loses no pair.

Defined results: texts without words (null too) have the same, empty set and so
are one group; equal sets are one vertex; of equal ids one row stays; null ids
never stay unless a group has no other id; texts of any length are taken whole;
extra columns of any name are carried; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, materialise, mix64, sweep, with_row_ids
from .simhash import common_bits, components, hub_links, shingle_digests

#: The sample that orders shingles, and how many it names; they change the cost, not the result.
SAMPLE_TEXTS, MOST_COMMON = 20_000, 500_000
#: Hubs of each crowd, by as many orders, and hubs that a document is compared with.
ORDERS, HUBS = 4, 8
#: A shingle that at most so many share pairs them all; more are a crowd.
CROWD = 8
#: Bits of the longest sketch, a power of two, and first crowds of a document by which open
#: pairs are told that met before; they change the cost, not the result.
MOST_BITS, FIRSTS = 1 << 14, 4
#: Bits of 128 beyond which two sets are not compared, and sizes that this is not asked of.
FAR, SMALL = 48, 32
#: Document ids, 8 bytes each, that are broadcast at most; more are joined.
BROADCAST_IDS = 500_000


def distinct(digests) -> np.ndarray:
    """The distinct shingle hashes of blocks of digests, ascending."""
    return np.unique(np.frombuffer(b"".join(digests), ">i8").astype(np.int64))


def shingles(text: bytes, width: int = 5) -> np.ndarray:
    """The distinct shingle hashes of one UTF-8 text, ascending."""
    return distinct(shingle_digests(text, width))


def _texts(batch: pa.RecordBatch):
    for text in batch.column("text").cast(pa.large_binary()):
        yield text.as_buffer().to_pybytes() if text.is_valid else b""


def _lists(sets: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*sets, np.empty(0, np.int64)])))


def shingle_sets(spark: SparkSession, texts: DataFrame, width: int) -> DataFrame:
    """v and shingles, of v and text."""

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays([part.column("v"), _lists([shingles(t, width) for t in _texts(part)])], names=["v", "shingles"])

    return map_batches(spark, texts.select("v", "text"), run, "v bigint, shingles array<bigint>")


def common_shingles(spark: SparkSession, keyed: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles, ascending, that occur in several texts of a sample, and in how many."""
    share = SAMPLE_TEXTS / max(1, keyed.count())
    texts = keyed.select(F.col("row_id").alias("v"), "text")
    sample = texts.sample(share, seed=1) if share < 1 else texts
    counted = shingle_sets(spark, sample, width).select(F.explode("shingles").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = counted.orderBy(F.desc("n"), "key").limit(MOST_COMMON).toArrow().sort_by("key")
    return found["key"].to_numpy(), found["n"].to_numpy()


def odd_sketch(s: np.ndarray) -> np.ndarray:
    """A parity bit for each place that the hashes of a set fall on, in words of 64. Places
    are the least power of two that is at least twice the set, 64 to MOST_BITS."""
    places = min(MOST_BITS, max(64, 1 << (2 * len(s) - 1).bit_length()))
    odd = np.bincount(s & (places - 1), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def prefixes(spark: SparkSession, keyed: DataFrame, width: int) -> DataFrame:
    """row_id, doc_id, digest of the shingle set, its size, its two fingerprints (each
    shingle counting once, as in the similarity), its prefix and its odd sketch."""
    keys, counts = common_shingles(spark, keyed, width)

    def first(s: np.ndarray) -> np.ndarray:
        n = len(s)
        if not n:
            return s
        often = np.zeros(n, np.int64)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
            often = np.where(keys[at] == s, counts[at], 0)
        return s[np.lexsort((s, often))[: n + 1 - (4 * n + 4) // 5]]

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                sets = [shingles(t, width) for t in _texts(part)]
                one, two = ([common_bits([f(s.view(np.uint64)).tobytes()]) for s in sets] for f in (np.asarray, mix64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row_id"), part.column("doc_id"), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()), *[pa.array(np.array(x, np.uint64).view(np.int64)) for x in (one, two)],
                        _lists([first(s) for s in sets]), _lists([odd_sketch(s) for s in sets]),
                    ],
                    names=["row_id", "doc_id", "digest", "size", "fp", "fq", "prefix", "sketch"],
                )

    return map_batches(spark, keyed, run, "row_id bigint, doc_id bigint, digest binary, size bigint, fp bigint, fq bigint, prefix array<bigint>, sketch array<bigint>")


def alike(common: Column, a: Column, b: Column) -> Column:
    """Whether sets of sizes a and b with so many common members are 0.8 similar."""
    return common * 9 >= (a + b) * 4


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    side = lambda c: sets.select(F.col("v").alias(c), F.col("shingles").alias(f"s{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.filter(alike(F.size(F.array_intersect("sa", "sb")), F.size("sa"), F.size("sb"))).select("a", "b")


def _possible(x: str, y: str) -> Column:
    """Whether sets may be similar that meet first at these positions."""
    of = lambda c: (F.col(f"{x}.{c}"), F.col(f"{y}.{c}"))
    (m, n), (i, j) = of("size"), of("at")
    apart = sum(F.bit_count(one.bitwiseXOR(two)) for one, two in (of("fp"), of("fq")))
    return alike(F.least(m - i, n - j), m, n) & ((F.least(m, n) < SMALL) | (apart <= FAR))


def fingerprint_pairs(prints: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): documents of prints (v, fp) with equal fingerprints, and with those of the
    hubs that a fingerprint's look-ups by segment meet within max_bits; a few each."""
    owners = prints.groupBy("fp").agg(F.min("v").alias("v"))
    same = prints.select("fp", F.col("v").alias("a")).join(owners.withColumnRenamed("v", "b"), "fp").filter("a <> b").select("a", "b")
    owner = lambda c: owners.select(F.col("fp").alias(c), F.col("v").alias(f"v{c}"))
    near = hub_links(owners, max_bits).join(owner("a"), "a").join(owner("b"), "b").select(F.col("va").alias("a"), F.col("vb").alias("b"))
    return same.union(near)


def hub_pairs(crowds: DataFrame) -> DataFrame:
    """(a, b): members of crowds (key, x) with at most HUBS of the hubs of their keys. All
    keys take their hubs by the same orders, so that the members of a crowd meet the same."""
    least = [F.min(F.struct(F.xxhash64("x.v", F.lit(k)).alias("h"), "x.*")) for k in range(ORDERS)]
    hubs = crowds.groupBy("key").agg(F.array_distinct(F.array(*least)).alias("hubs")).select("key", F.explode("hubs").alias("hub"))
    met = crowds.join(hubs, "key").filter((F.col("x.v") != F.col("hub.v")) & _possible("x", "hub")).select(F.col("x.v").alias("a"), F.struct("hub.h", "hub.v").alias("hub"))
    few = met.groupBy("a").agg(F.slice(F.array_sort(F.collect_set("hub")), 1, HUBS).alias("hubs"))
    return few.select("a", F.explode("hubs.v").alias("b"))


def small_pairs(groups: DataFrame) -> DataFrame:
    """(a, b): all possible pairs of groups (key, x) of at most CROWD members."""
    members = groups.groupBy("key").agg(F.collect_list("x").alias("m"))
    both = members.select("m", F.explode("m").alias("x")).select("x", F.explode("m").alias("y"))
    return both.filter((F.col("x.v") < F.col("y.v")) & _possible("x", "y")).select(F.col("x.v").alias("a"), F.col("y.v").alias("b"))


def differing(one: Column, two: Column) -> Column:
    """The bits in which two sketches differ, the longer one folded once: no more than the
    members of one set that the other lacks, both ways. Sets that may be 0.8 similar have
    sketches of equal length or one twice the other."""
    halves = lambda s, n: F.zip_with(F.slice(s, F.lit(1), n), F.slice(s, n + 1, n), lambda x, y: x.bitwiseXOR(y))
    folded = lambda s, t: F.when(F.size(s) > F.size(t), halves(s, F.size(t))).otherwise(s)
    bits = F.zip_with(folded(one, two), folded(two, one), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda total, n: total + F.coalesce(n, F.lit(0)))


def open_pairs(crowds: DataFrame, labels: DataFrame, sketch_of: DataFrame) -> DataFrame:
    """(a, b): possible pairs of members of crowds that are in different groups so far and
    whose sketches (v, sketch) allow 0.8, each once.

    A pair meets in every crowd that both are members of. Where the FIRSTS first crowds of
    both have one in common, it stays in the first of those only, which is the first of all."""
    named = labels.withColumnRenamed("v", "member")
    labelled = crowds.join(named, F.col("x.v") == F.col("member"), "left").select("key", "x", F.coalesce("label", "x.v").alias("label"))
    several = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("key")
    # one row a document moves its sketch and its first crowds, and then goes to each of its crowds
    own = labelled.join(several, "key").groupBy("x.v").agg(F.array_sort(F.collect_list(F.struct("x.at", "key"))).alias("met"), F.max("label").alias("label"), *[F.max(f"x.{c}").alias(c) for c in ("size", "fp", "fq")])
    own = own.join(sketch_of, "v").withColumn("firsts", F.slice("met.key", 1, FIRSTS))
    apart = own.select(F.explode("met").alias("m"), "v", "size", "fp", "fq", "label", "firsts", "sketch").select("m.key", F.struct("v", "size", "m.at", "fp", "fq").alias("x"), "label", "firsts", "sketch")
    one, two = apart.alias("one"), apart.hint("merge").alias("two")
    first = F.get(F.array_intersect("one.firsts", "two.firsts"), F.lit(0))
    differ = (F.col("one.x.v") < F.col("two.x.v")) & (F.col("one.label") != F.col("two.label")) & _possible("one.x", "two.x")
    once = F.coalesce(first == F.col("one.key"), F.lit(True))
    # of m + n members as many as differ are in one set only, the others are pairs of common ones
    sizes = F.col("one.x.size"), F.col("two.x.size")
    allowed = alike((sizes[0] + sizes[1] - differing(F.col("one.sketch"), F.col("two.sketch"))) / 2, *sizes)
    met = one.join(two, F.col("one.key") == F.col("two.key")).filter(differ & once & allowed)
    return met.select(F.col("one.x.v").alias("a"), F.col("two.x.v").alias("b")).distinct()


def links(spark: SparkSession, groups: DataFrame, sketch_of: DataFrame, texts: DataFrame, width: int, max_bits: int) -> DataFrame:
    """(v, label) of the components of all links among texts (v, text).

    groups (key, n, x): for each prefix shingle that several share, how many, and the
    documents x (v, size, at, fp, fq); sketch_of: v, sketch."""
    crowds = groups.filter(F.col("n") > CROWD)
    prints = groups.select("x.v", "x.fp").distinct()
    pairs = fingerprint_pairs(prints, max_bits).union(hub_pairs(crowds)).union(small_pairs(groups.filter(F.col("n") <= CROWD)))
    pairs = materialise(spark, pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near-pairs")
    sweep(spark)
    sets = named_sets(spark, pairs, texts, width)
    found = materialise(spark, verified(pairs, sets), "near-links")
    labels = components(spark, found)
    sweep(spark)
    rest = materialise(spark, open_pairs(crowds, labels, sketch_of).join(pairs, ["a", "b"], "left_anti"), "near-pairs")
    sweep(spark)
    if rest.isEmpty():
        return labels
    new = named_sets(spark, rest, texts, width, sets)
    return components(spark, found.union(materialise(spark, verified(rest, sets.union(new)), "near-links")))


def named_sets(spark: SparkSession, pairs: DataFrame, texts: DataFrame, width: int, have: DataFrame | None = None) -> DataFrame:
    """The shingle sets of the documents that pairs name, but for those that are there."""
    ids = pairs.select(F.col("a").alias("v")).union(pairs.select("b")).distinct()
    ids = materialise(spark, ids if have is None else ids.join(have.select("v"), "v", "left_anti"), "near-named")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return materialise(spark, shingle_sets(spark, texts.join(ids, "v", "left_semi"), width), "near-shingles")


def near_copies(spark: SparkSession, keyed: DataFrame, width: int = 5, max_bits: int = 5) -> DataFrame:
    """The row_id of every row of keyed (row_id, doc_id, text) that goes: all but that
    with the smallest id of each group."""
    found = materialise(spark, prefixes(spark, keyed, width), "near-prefixes")
    sweep(spark)
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")
    groups = found.groupBy("digest").agg(F.min(rank)["row_id"].alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    equal = materialise(spark, found.select("row_id", "digest").join(groups, "digest").filter("row_id <> top").select("row_id"), "near-equal")
    different = found.join(equal, "row_id", "left_anti")
    rows = different.select(F.col("row_id").alias("v"), F.posexplode("prefix").alias("at", "key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    facts = different.select(F.col("row_id").alias("v"), "size", "fp", "fq")
    groups = rows.join(shared, "key").join(facts, "v").select("key", "n", F.struct("v", "size", "at", "fp", "fq").alias("x"))
    groups = materialise(spark, groups, "near-groups")
    sweep(spark)
    labels = links(spark, groups, found.select(F.col("row_id").alias("v"), "sketch"), keyed.select(F.col("row_id").alias("v"), "text"), width, max_bits)
    ranked = labels.join(found.select(F.col("row_id").alias("v"), rank.alias("rank")), "v")
    least = ranked.groupBy("label").agg(F.min("rank").alias("top"))
    gone = ranked.join(least, "label").filter(F.col("rank") != F.col("top")).select(F.col("v").alias("row_id"))
    return materialise(spark, gone.union(equal), "near-gone")


def dedup(spark: SparkSession, docs: DataFrame, width: int = 5, max_bits: int = 5) -> DataFrame:
    """The rows of docs that stay, one of each group, all columns unchanged."""
    held = with_row_ids(spark, docs, "near-input")
    keyed = held.select("row_id", F.col("doc.doc_id").cast("bigint").alias("doc_id"), F.col("doc.text").alias("text"))
    return held.join(near_copies(spark, keyed, width, max_bits), "row_id", "left_anti").select("doc.*")
