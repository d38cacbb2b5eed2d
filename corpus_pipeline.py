"""From raw documents to a training mix in five stages.

Each stage takes (spark, docs, sf_dir) and returns the rows that stay, with all their
columns as they were; the last adds size, source_size, target and taken. What one
stage writes is what the next one reads.

In every stage null text counts as empty text, repeated rows are rows of their own,
texts of any length are taken whole, columns of any other name are carried, and no
rows give no rows. What a stage decides on ties and empty texts is said there.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from landsurvey.llm import decontamination, exact_dedup, mixing, near_copies, toxicity
from landsurvey.llm.common import collected, materialise, read_table, release

#: Bits of 64 within which fingerprints propose near copies; similarity decides.
NEAR_BITS = 5


#: Folders that stages have written on the way and that are still there.
_leftovers: list[str] = []


def stage(f):
    """A stage that first clears what earlier stages wrote on the way. Their results
    are written by then, or are this stage's input, which keeps what it reads."""

    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _leftovers, docs)
        with collected(_leftovers):
            return f(spark, docs, sf_dir)

    return run_stage


@stage
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network does not reject: a score of 0.5 is rejected,
    and empty texts score as a text without words."""
    return toxicity.reject(spark, docs, read_table(spark, sf_dir, "labels"))


@stage
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the largest id of each text, letters A-Z in either case; one row
    of those that repeat it. Empty texts are equal; a null id is the smallest."""
    return exact_dedup.dedup(spark, docs)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies: similarity of 0.8
    or more of the five-word shingles, proposed by SimHash look-ups and completed beyond
    their reach. Texts without words are one group; of equal ids one row stays, and a
    null id only where a group has no other."""
    return near_copies.dedup(spark, docs, max_bits=NEAR_BITS)


@stage
def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs; empty texts stay."""
    return decontamination.decontaminate(spark, docs, read_table(spark, sf_dir, "benchmark"))


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes words of, and how many; empty texts give none and go.
    One document of a source at most is cut; of equal ids the text's hash decides."""
    return mixing.mixed(spark, docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("source mixing", mix_sources),
]

#: A trained network and XXH64 are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table. What a stage wrote goes when the next
    one has written its own."""
    docs, before = read_table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        now: list[str] = []
        with collected(now):
            docs = materialise(spark, stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        release(spark, before, docs)
        before = now
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
