"""A stored vocabulary (P11): token -> id and id -> token, in versions that keep old ids.

Every version is two external tables of the same rows (token, token_id, count), one bucketed
and sorted by token, one by id, so that both lookups join buckets as they lie. A manifest
table holds one row for each finished version with its bucket number and largest id; a
version exists from the moment its row is written, so a job that dies leaves the last one.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkstats.operators.tokens import with_dense_ids
from linkstats.session import delete_path, path_exists

UNKNOWN_ID, UNKNOWN = 0, "<UNKNOWN>"
MANIFEST = "version bigint, buckets int, max_id bigint, size bigint, total bigint"


class VocabularyStore:
    """The vocabulary under ``path``; opened again, in this session or another, it goes on at
    its last version with the bucket number it was written with."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.version, self.max_id, self.size, self.total = 0, 0, 0, 0
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if path_exists(spark, f"{self.path}/manifest"):
            last = spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest").orderBy(F.col("version").desc()).first()
            if last:
                self.version, self.buckets, self.max_id, self.size, self.total = last

    def _table(self, key: str, version: int) -> str:
        """The catalog's name of one version's table; made where this session lacks it."""
        name = f"vocabulary_{hashlib.md5(self.path.encode()).hexdigest()}_{version}_{key}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (token STRING, token_id BIGINT, count BIGINT) USING parquet "
                       f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS "
                       f"LOCATION '{self.path}/v{version}/{key}'")
        return name

    def entries(self, key: str = "token") -> DataFrame:
        """(token, token_id, count) of this version, bucketed by ``key``."""
        if not self.version:
            return self.spark.createDataFrame([], "token string, token_id bigint, count bigint")
        return self.spark.table(self._table(key, self.version))

    def add(self, counts: DataFrame) -> None:
        """A new version with the tokens and counts of ``counts`` (token, count; a token may
        stand in many rows) added: known tokens keep their ids, new ones get the next ids in
        token order. Null tokens count as none."""
        new = counts.where(F.col("token").isNotNull()).groupBy("token").agg(F.sum("count").cast("long").alias("_more"))
        known = self.entries().join(new, "token", "left").select(
            "token", "token_id", (F.col("count") + F.coalesce("_more", F.lit(0))).alias("count"))
        fresh = with_dense_ids(new.join(self.entries().select("token"), "token", "left_anti"), "token")
        fresh = fresh.select("token", (F.col("token_id") + self.max_id).alias("token_id"), F.col("_more").alias("count"))
        rows, version = known.unionByName(fresh), self.version + 1
        delete_path(self.spark, f"{self.path}/v{version}")  # of a version that was not finished
        for key, source in (("token", rows), ("token_id", None)):
            name = self._table(key, version)
            source = source if source is not None else self.spark.table(self._table("token", version))
            (source.repartition(self.buckets, key).write.format("parquet").bucketBy(self.buckets, key).sortBy(key)
             .mode("append").saveAsTable(name))
            self.spark.catalog.refreshTable(name)
        row = self.spark.table(self._table("token", version)).agg(
            F.lit(version).cast("long"), F.lit(self.buckets), F.coalesce(F.max("token_id"), F.lit(0)),
            F.count(F.lit(1)), F.coalesce(F.sum("count"), F.lit(0)))
        row.toDF("version", "buckets", "max_id", "size", "total").coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        self.__init__(self.spark, self.path)

    def ids_of(self, tokens: DataFrame, token_col: str = "token") -> DataFrame:
        """``tokens`` with (token_id, vocab_count); id 0 and count 0 for unknown tokens."""
        v = self.entries("token").select(F.col("token").alias("_v"), F.col("token_id").alias("_id"), F.col("count").alias("_n"))
        j = tokens.join(v, tokens[token_col] == v["_v"], "left")
        return j.select(*tokens.columns, F.coalesce("_id", F.lit(UNKNOWN_ID)).cast("long").alias("token_id"),
                        F.coalesce("_n", F.lit(0)).cast("long").alias("vocab_count"))

    def tokens_of(self, ids: DataFrame, id_col: str = "token_id") -> DataFrame:
        """``ids`` with (token, vocab_count); UNKNOWN and count 0 for ids that are not given."""
        v = self.entries("token_id").select(F.col("token").alias("_v"), F.col("token_id").alias("_id"), F.col("count").alias("_n"))
        j = ids.join(v, ids[id_col] == v["_id"], "left")
        return j.select(*ids.columns, F.coalesce("_v", F.lit(UNKNOWN)).alias("token"),
                        F.coalesce("_n", F.lit(0)).cast("long").alias("vocab_count"))

    def keep_last(self, versions: int = 1) -> None:
        """Deletes the tables of all but the last versions."""
        for version in range(1, self.version - versions + 1):
            for key in ("token", "token_id"):
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table(key, version)}")
            delete_path(self.spark, f"{self.path}/v{version}")
