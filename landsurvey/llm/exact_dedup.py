"""Exact dedup against a persistent digest index, in DataFrame operations only.

The index is a Parquet table of one row per distinct normalised text, bucketed
and sorted by digest. New data is reduced to one row per digest, loses to what
the index already holds by a sort-merge anti-join on the buckets, and the rest
is appended. Appending twice the same rows gives the same decisions: a row is
kept when the index names it as the one that stays. Each append adds a file to each
bucket; after MOST_APPENDS of them, or when buckets have grown to twice their size,
the index is written anew with as many buckets as its rows need.

Defined results: null text is empty text; texts are equal when identical after
lower-casing A-Z only; of equal texts the largest doc_id stays (null ids are
smallest), and of repeated rows with that id exactly one; a row without an id stays
only in the batch that brought its text first. Empty input gives no rows. Other
columns of any name are ignored by ``decide`` and carried by ``dedup``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, fresh_path, join_counted, materialise, plain_columns, with_row_ids

LEAST_BUCKETS, ROWS_A_BUCKET, MOST_APPENDS = 48, 4_000_000, 16
ROW_BYTES = 40  # of the index, about


class DigestIndex:
    """One folder holding (digest, keep_id, batch), hashed into buckets.

    A new index gets a bucket for each ROWS_A_BUCKET rows expected, at least
    LEAST_BUCKETS; one that is there keeps its number until it is compacted. The rows
    are in the folder's newest ``digests_<generation>_<buckets>``."""

    def __init__(self, spark: SparkSession, location: str, buckets: int | None = None, rows: int = 0):
        self.spark, self.location, self.table = spark, location, None
        self.generation, self.buckets = self._newest() or (0, buckets or max(LEAST_BUCKETS, rows // ROWS_A_BUCKET))
        self._files.mkdirs(self._path(self._home()))  # names the number of buckets
        self._files.mkdirs(self._path(self._appends()))

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)

    @property
    def _files(self):
        return self._path(self.location).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _home(self) -> str:
        return f"{self.location}/digests_{self.generation:06d}_{self.buckets}"

    def _newest(self) -> tuple[int, int] | None:
        found = self._files.globStatus(self._path(f"{self.location}/digests_*_*"))
        names = [f.getPath().getName().split("_") for f in found or []]
        return max((int(g), int(n)) for _, g, n in names) if names else None

    def _open(self) -> str:
        """The name under which the newest generation is registered until ``close``."""
        if not self.table:
            self.table = f"digest_index_{uuid.uuid4().hex}"
            self.spark.sql(
                f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
                f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self._home()}'"
            )
        return self.table

    def close(self) -> None:
        """Take the table out of the catalog; its files stay."""
        if self.table:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        self.table = None

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self._open())
        return self.spark.table(self.table)

    def add(self, groups: DataFrame, batch: str = "") -> None:
        """Append the groups (digest, keep_id) whose digest the index lacks."""
        known = self.rows().select("digest")
        fresh = (
            groups.select("digest", "keep_id", F.lit(batch).alias("batch"))
            .repartition(self.buckets, "digest")
            .join(known.hint("merge"), "digest", "left_anti")
        )
        fresh.write.insertInto(self.table)
        self._files.mkdirs(self._path(f"{self._appends()}/{uuid.uuid4().hex}"))

    def _appends(self) -> str:
        """The folder that holds one mark for each append to this generation."""
        return f"{self.location}/appends_{self.generation:06d}"

    def compact(self, buckets: int | None = None) -> None:
        """Write the index anew, one sorted file a bucket; the old generation goes when
        the new one is whole, so a run that ends midway changes nothing."""
        old, rows = [self._home(), self._appends()], self.rows()
        n = buckets or max(LEAST_BUCKETS, rows.count() // ROWS_A_BUCKET)
        building, name = f"{self.location}/building_{uuid.uuid4().hex}", f"digest_index_{uuid.uuid4().hex}"
        rows.repartition(n, "digest").write.bucketBy(n, "digest").sortBy("digest").option("path", building).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")
        self.close()
        self.generation, self.buckets = self.generation + 1, n
        self._files.rename(self._path(building), self._path(self._home()))
        self._files.mkdirs(self._path(self._appends()))
        for folder in old:
            self._files.delete(self._path(folder), True)

    def tidy(self) -> None:
        """Compact the index after many appends, or where buckets are too large."""
        appends = self._files.getContentSummary(self._path(self._appends())).getDirectoryCount() - 1
        size = self._files.getContentSummary(self._path(self._home())).getLength()
        if appends > MOST_APPENDS or size > 2 * ROW_BYTES * ROWS_A_BUCKET * self.buckets:
            self.compact()

    def decide(self, docs: DataFrame, row_id: Column | None = None) -> DataFrame:
        """Add docs (doc_id, text) and tell for each row which row stays.

        Columns: row_id (the given one, or its own), doc_id, keep_id,
        group_size (rows of docs with that text), kept, text_sha256.
        """
        row_id, batch = F.monotonically_increasing_id() if row_id is None else row_id, uuid.uuid4().hex
        digests = materialise(
            self.spark,
            plain_columns(
                docs, row_id=row_id, doc_id=F.col("doc_id").cast("bigint"),
                digest=F.unhex(F.sha2(ascii_lower(F.col("text")).cast("binary"), 256)),
            ),
            "digests",
        )
        groups = materialise(
            self.spark,
            digests.groupBy("digest")
            .agg(F.max(F.struct("doc_id", "row_id")).alias("top"), F.count(F.lit(1)).alias("group_size"))
            .select("digest", F.col("top.doc_id").alias("keep_id"), F.col("top.row_id").alias("top_row"), "group_size"),
            "digest-groups",
        )
        self.add(groups, batch)
        owner = self.rows().select("digest", F.col("keep_id").alias("owner"), (F.col("batch") == batch).alias("brought"))
        settled = materialise(
            self.spark,
            groups.repartition(self.buckets, "digest").join(owner.hint("merge"), "digest").withColumnRenamed("group_size", "n"),
            "digest-owners",
        )
        self.tidy()
        self.close()
        names = (F.col("owner") == F.col("keep_id")) | (F.col("owner").isNull() & F.col("keep_id").isNull() & F.col("brought"))
        return join_counted(digests, settled.withColumn("group_size", F.col("n")), "digest", digests.count()).select(
            "row_id", "doc_id",
            F.col("owner").alias("keep_id"), "group_size",
            (F.coalesce(names, F.lit(False)) & (F.col("row_id") == F.col("top_row"))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )


def exact_duplicates(spark: SparkSession, docs: DataFrame, location: str | None = None, buckets: int | None = None, row_id: Column | None = None) -> DataFrame:
    """Decisions on docs against the index in location (a new one if not given)."""
    return DigestIndex(spark, location or fresh_path(spark, "digest-index"), buckets, docs.count()).decide(docs, row_id)


def dedup(spark: SparkSession, docs: DataFrame, location: str | None = None, buckets: int | None = None) -> DataFrame:
    """The rows of docs that stay, all columns unchanged."""
    held = with_row_ids(spark, docs, "exact-input")
    keyed = held.select("row_id", F.col("doc.doc_id").alias("doc_id"), F.col("doc.text").alias("text"))
    kept = exact_duplicates(spark, keyed, location, buckets, F.col("row_id")).filter("kept").select("row_id")
    return held.join(kept, "row_id", "left_semi").select("doc.*")
