"""P6 at size: ids are exactly 1..n in token order over many partitions."""

from pyspark.sql import functions as F

from linkstats.operators import tokens as tk


def test_dense_ids_over_many_partitions(spark):
    n = 400_000
    words = spark.range(0, n, 1, 16).select(F.sha1(F.col("id").cast("string")).alias("token"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        out = tk.with_dense_ids(words, "token").cache()
        r = out.agg(F.count_distinct("token_id").alias("d"), F.min("token_id").alias("lo"), F.max("token_id").alias("hi"),
                    F.count(F.lit(1)).alias("n")).first()
        assert (r.d, r.lo, r.hi, r.n) == (n, 1, n, n)
        ordered = [x[0] for x in out.orderBy("token").select("token_id").limit(1000).collect()]
        assert ordered == list(range(1, 1001))
        out.unpersist()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
