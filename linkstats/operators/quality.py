"""Data-quality checks (Q1-Q5): each returns one row (check, n_rows, n_violations)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _row(name: str, df: DataFrame, violation) -> DataFrame:
    return df.agg(F.lit(name).alias("check"),
                  F.count(F.lit(1)).alias("n_rows"),
                  F.coalesce(F.sum(F.when(violation, 1).otherwise(0)), F.lit(0)).cast("long").alias("n_violations"))


def empty_surface_forms(surface_forms: DataFrame) -> DataFrame:
    """Q1: no surface form is empty or null."""
    return _row("empty_sf", surface_forms, F.col("sf").isNull() | (F.col("sf") == ""))


def redirect_count(redirect_edges: DataFrame) -> DataFrame:
    """Q2: redirect pages; a violation is a title that occurs more than once."""
    per_title = redirect_edges.groupBy("src").agg(F.count(F.lit(1)).alias("c"))
    return per_title.agg(F.lit("redirect_count").alias("check"),
                         F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("n_rows"),
                         F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("long").alias("n_violations"))


def redirect_terminal(resolved: DataFrame, edges: DataFrame) -> DataFrame:
    """Q3: on an acyclic redirect graph every final target is not itself a redirect."""
    srcs = edges.select(F.col("src").alias("final")).distinct().withColumn("_is_src", F.lit(True))
    j = resolved.join(srcs, "final", "left")
    return _row("redirect_terminal", j, F.col("_is_src").isNotNull())


def annotated_total(totals: DataFrame, link_facts: DataFrame) -> DataFrame:
    """Q4: the annotated counts (-1 read as 0) add up to the number of link facts."""
    a = totals.select(F.when(F.col("annotated") == -1, 0).otherwise(F.col("annotated")).cast("long").alias("a"),
                      F.lit(0).cast("long").alias("l"))
    links = link_facts.select(F.lit(0).cast("long").alias("a"), F.lit(1).cast("long").alias("l"))
    s = a.unionByName(links).agg(F.coalesce(F.sum("a"), F.lit(0)).alias("s"),
                                 F.coalesce(F.sum("l"), F.lit(0)).alias("n"))
    return s.select(F.lit("annotated_total").alias("check"), F.col("n").cast("long").alias("n_rows"),
                    F.abs(F.col("s") - F.col("n")).cast("long").alias("n_violations"))


def spot_offsets(spots: DataFrame, texts: DataFrame, id_col: str = "wid", text_col: str = "text") -> DataFrame:
    """Q5: every spot's sf equals the text at its offset."""
    j = spots.join(texts.select(id_col, text_col), id_col)
    bad = F.substring(F.col(text_col), F.col("offset") + 1, F.length("sf")) != F.col("sf")
    return _row("spot_offsets", j, bad)
