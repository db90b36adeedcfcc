"""Exact dedup against a persistent digest index, bucketed and sorted by digest.

Texts are equal when they are identical after every run of ``[\\x20\\x09-\\x0D]`` became one
space. The index holds one row (digest, doc_id) for every text seen so far. A batch is
reduced to its distinct digests, anti-joined with the index by a sort-merge join that reads
the buckets as they lie, and what is left is appended.

Defined results: a null text counts as empty; every row counts and gives a row, also one that
repeats both doc_id and text; a null doc_id stays only where no row of its group has an id; other columns are
ignored, whatever their names; an empty table gives no rows and leaves the index as it was.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkstats.llm.common import SPACE_RUN, same, shuffle_width, table, text_of
from linkstats.session import ensure_checkpoint_dir, materialize, path_exists


def digest(col: str = "text"):
    """Lower-case hex SHA-256 of the text with white-space runs as one space."""
    return F.sha2(F.regexp_replace(text_of(col), SPACE_RUN, " "), 256)


class DigestIndex:
    """An external bucketed table at ``path``; reopened, in any session, it goes on where it
    stopped, with the bucket number stored beside it (another one is refused). A failed append
    leaves no rows (Spark commits whole jobs)."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/digest-index-{uuid.uuid4().hex}"
        stored = f"{self.path}/_buckets"  # an underscore hides it from readers of the table
        if not path_exists(spark, stored):
            spark.range(1).select(F.lit(buckets or shuffle_width(spark)).alias("n")).write.parquet(stored)
        self.buckets = spark.read.parquet(stored).first()[0]
        if buckets not in (None, self.buckets):
            raise ValueError(f"the index at {self.path} has {self.buckets} buckets, not {buckets}")
        self.name = f"digest_index_{hashlib.md5(self.path.encode()).hexdigest()}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, doc_id BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def known(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def append_new(self, firsts: DataFrame) -> None:
        """Appends the rows of ``firsts`` (digest, doc_id; distinct digests) not yet known."""
        (firsts.repartition(self.buckets, "digest").hint("merge").join(self.known(), "digest", "left_anti")
         .select("digest", "doc_id")
         .write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
         .mode("append").saveAsTable(self.name))


def dedupe(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep_id`` is the row the index holds for the text: the smallest doc_id of the first
    batch that had it. ``group_size`` counts the rows of this batch with that text.
    """
    rows = materialize(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), digest(text_col).alias("digest")), "digests")
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("group_size"))
    groups = materialize(groups, "digest_groups")
    index.append_new(groups)
    keepers = materialize(index.known().withColumnRenamed("doc_id", "keep_id")
                          .join(groups.select("digest", "group_size").hint("merge"), "digest"), "digest_keepers")
    return (rows.join(keepers.hint("merge"), "digest")  # both sides shuffled, so a hot digest is split
            .select("doc_id", "keep_id", "group_size", same(F.col("doc_id"), F.col("keep_id")).alias("kept"),
                    F.col("digest").alias("text_sha256")))


def keep_first(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; of rows that repeat both id and
    text one stays. Texts move by (digest, id), so a hot digest is spread."""
    kept = dedupe(docs, index, id_col, text_col).where("kept").select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__kept"))
    mark = "__digest"
    while mark in docs.columns:
        mark += "_"
    tagged = docs.withColumn(mark, digest(text_col))
    joined = tagged.join(kept, same(tagged[mark], kept["__kept"])
                         & same(tagged[id_col].cast("bigint"), kept["__id"]), "left_semi")
    return joined.dropDuplicates([id_col, mark]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(table(spark, sf_dir, "documents"), DigestIndex(spark))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
