"""Mixing sources to target weights by hash-threshold histograms, without sorting.

Every document has a 60-bit hash of its id. The words of each source are summed
by the leading hash bits; the bucket in which the source's budget runs out is
the only one refined, by the next bits, until one hash value is left. Documents
below that value are taken whole and those above are not. If several rows have
that value (equal ids, or none), they are refined in the same way by a hash of
their text, and rows that are equal in this too by their row number, in which any
order gives the same rows. So one document at most is cut, at a word, and a
source's words meet its target to a word. A budget of more than the source's size
takes every document once and applies the thresholds to the second copy.

Defined results: null text has size 0; a null source is a source of its own,
last in order; repeated rows are separate documents; no rows or no words give
targets of 0; extra columns of any name are carried by ``mixed``, but for those
that it adds. Only DataFrame operations are used. The targets are worked out in one
task, a row a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, materialise, plain_columns, with_row_ids

WORD = r"[^\x20\x09-\x0D]+"
BITS, LEVELS = 12, 5  # 60 hash bits, 4096 buckets a level
ROW_LEVELS = 6  # for the 63 bits of row numbers
BEYOND = 1 << 62  # above every hash


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _attach(big: DataFrame, small: DataFrame, small_rows: int) -> DataFrame:
    """Join per-source facts to rows. Few sources are broadcast; many are joined on
    a salted key, so that a source of a third of all rows is spread."""
    if small_rows <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), "skey")
    salts = 16
    salted = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.withColumn("salt", F.pmod(F.xxhash64("row_id"), F.lit(salts)).cast("int")).join(salted, ["skey", "salt"]).drop("salt")


def source_targets(sources: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Target of each source (skey, source, source_size): share of all words by
    weight, none above most times its size, the excess given to the others.

    Resharing until none is above has a closed form: with sources in order of
    most * size / weight, the first k are at their limit and the rest get weight
    times one level. The row count is that of the sources.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "skey")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    every = Window.partitionBy(F.lit(1))
    ranked = (
        sources.withColumn("at", (F.row_number().over(by_name) - 1) % len(weights))
        .withColumn("weight", F.element_at(cycle, F.col("at") + 1))
        .withColumn("limit", F.col("source_size") * F.lit(float(most)))
        .withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("rest_weight", F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("limits_before", F.coalesce(F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("level", (F.col("budget") - F.col("limits_before")) / F.col("rest_weight"))
        .withColumn("free", F.col("level") * F.col("weight") <= F.col("limit"))
    )
    # Once one source is free all later ones are, at the level of the first free one.
    level = F.min(F.when(F.col("free"), F.struct((F.col("limit") / F.col("weight")).alias("r"), "skey", "level"))).over(every)["level"]
    return ranked.withColumn("level", level).select(
        "skey", "source_size", F.least("limit", F.coalesce(F.col("level") * F.col("weight"), F.col("limit"))).alias("target")
    )


def narrow(spark: SparkSession, rows: DataFrame, state: DataFrame, key: str, levels: int, n_sources: int) -> DataFrame:
    """The threshold of key at which each source's words run out.

    rows: row_id, skey, key, size; state: skey, left (words that may be taken).
    Returns skey, prefix (rows below it are taken), left (words of those at it that
    are taken) and at_rows (how many are at it)."""
    by_bucket = Window.partitionBy("skey").orderBy("bucket")
    state = state.select("skey", "left", F.lit(0).cast("bigint").alias("prefix"))
    for level in range(1, levels + 1):
        shift = BITS * (levels - level)
        if level > 1:  # only what is in the boundary bucket
            inside = _attach(rows, state.select("skey", "prefix"), n_sources)
            rows = inside.filter(F.shiftright(key, shift + BITS) == F.col("prefix")).select(*rows.columns)
            if level == 2:
                rows = materialise(spark, rows, "mix-boundary")
        sums = rows.groupBy("skey", F.shiftright(key, shift).alias("bucket")).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
        # At most 4096 buckets a source reach this window, whatever its size.
        crossed = (
            sums.withColumn("upto", F.sum("words").over(by_bucket))
            .join(state.select("skey", "left"), "skey")
            .filter(F.col("upto") > F.col("left"))
            .groupBy("skey")
            .agg(F.min(F.struct("bucket", "upto", "words", "rows")).alias("b"))
        )
        state = materialise(
            spark,
            state.join(crossed, "skey", "left").select(
                "skey",
                F.when(F.col("b").isNull(), F.col("left")).otherwise(F.col("left") - (F.col("b.upto") - F.col("b.words"))).alias("left"),
                # no crossing: everything is below, the prefix is beyond every bucket
                F.coalesce("b.bucket", F.lit(BEYOND)).alias("prefix"), F.coalesce("b.rows", F.lit(0)).alias("at_rows"),
            ),
            f"mix-{key}-{level}",
        )
    return state


def mix(
    spark: SparkSession, docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, row_id: Column | None = None
) -> DataFrame:
    """One row per document: row_id (the given one, or its own), doc_id, source, size,
    source_size, target, taken."""
    row_id = F.monotonically_increasing_id() if row_id is None else row_id
    hashed = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("bigint")
    sized = materialise(
        spark,
        plain_columns(
            docs, row_id=row_id, doc_id=F.col("doc_id"), source=F.col("source"), h=hashed, size=word_count(F.col("text")),
            t=F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 4),
            skey=F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source"))),
        ),
        "mix-sizes",
    )
    sources = sized.groupBy("skey").agg(F.min("source").alias("source"), F.sum("size").alias("source_size"))
    targets = materialise(spark, source_targets(sources, weights, share, most), "mix-targets")
    n_sources = targets.count()
    whole = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))
    facts = targets.withColumn("copies", whole)
    state = targets.select("skey", (F.floor(F.col("target") + 0.5) - whole * F.col("source_size")).alias("left"))
    # thresholds of each key in turn, the next among the rows at the one before
    rows, part, names = sized.select("row_id", "skey", "h", "t", "size"), None, []
    for key, levels in (("h", LEVELS), ("t", LEVELS), ("row_id", ROW_LEVELS)):
        state = narrow(spark, rows, state, key, levels, n_sources)
        facts = facts.join(state.select("skey", F.col("prefix").alias(f"{key}_at"), F.col("left").alias(f"{key}_left")), "skey", "left")
        names.append(key)
        if key == "row_id" or state.filter("at_rows > 1").isEmpty():
            break
        tied = state.filter("at_rows > 1").select("skey", "prefix", "left")
        state = materialise(spark, tied.select("skey", "left"), "mix-ties")
        rows = materialise(spark, _attach(rows, tied, n_sources).filter(F.col(key) == F.col("prefix")).select(*rows.columns), "mix-tied")
    for key in reversed(names):
        at = F.col(f"{key}_left") if part is None else F.when(part["known"], part["taken"]).otherwise(F.col(f"{key}_left"))
        part = {"known": F.col(f"{key}_at").isNotNull(), "taken": F.when(F.col(key) < F.col(f"{key}_at"), F.col("size")).when(F.col(key) == F.col(f"{key}_at"), at).otherwise(0)}
    return _attach(sized, facts, n_sources).select(
        "row_id", "doc_id", "source", "size", "source_size", "target",
        (F.col("copies") * F.col("size") + part["taken"]).cast("bigint").alias("taken"),
    )


def mixed(spark: SparkSession, docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The rows of docs that the mix takes words of, with size, source_size, target
    and taken, which replace columns of those names."""
    held = with_row_ids(spark, docs, "mix-input")
    keyed = held.select("row_id", *[F.col("doc").getField(c).alias(c) for c in ("doc_id", "text", "source")])
    facts = ["size", "source_size", "target", "taken"]
    chosen = mix(spark, keyed, weights, share, most, F.col("row_id")).filter("taken > 0").select("row_id", *facts)
    own = [F.col("doc").getField(c).alias(c) for c in docs.columns if c not in facts]
    return held.join(chosen, "row_id").select(*own, *facts)
