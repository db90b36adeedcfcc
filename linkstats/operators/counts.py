"""Entity, pair and surface-form counts.

Weights: the reference counts the rows of links LEFT JOIN spots ON (wid, sf), so a
(wid, sf, uri) with k links and n spots weighs k * n (k when n = 0). We compute that
from both sides pre-aggregated per (wid, sf): no k x n rows are ever materialised and
the join moves one row per page anchor. ``weight="links"`` counts links only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WEIGHTS = ("occurrences", "links")


def link_spot_join(link_facts: DataFrame, spots: DataFrame) -> DataFrame:
    """J1 over pre-aggregated sides: (wid, sf, uri, links, spots, weight).

    Link facts are hash-partitioned by (wid, sf) once: the (wid, sf, uri) aggregate and
    the join on (wid, sf) both reuse that partitioning (one exchange on the link side)."""
    k = (link_facts.repartition("wid", "sf")
         .groupBy("wid", "sf", "uri").agg(F.count(F.lit(1)).alias("links")))
    n = spots.groupBy("wid", "sf").agg(F.count(F.lit(1)).alias("spots"))
    j = k.join(n, ["wid", "sf"], "left")
    return j.select("wid", "sf", "uri", "links", F.coalesce("spots", F.lit(0)).alias("spots"),
                    (F.col("links") * F.coalesce("spots", F.lit(1))).alias("weight"))


def weighted_pairs(link_facts: DataFrame, spots: DataFrame | None = None,
                   resolved: DataFrame | None = None, weight: str = "occurrences") -> DataFrame:
    """(sf, uri, weight) rows before grouping: link rows, plus (U1) one row per redirect
    title pointing at its final target. Empty and null uris are dropped up front."""
    if weight not in WEIGHTS:
        raise ValueError(f"weight must be one of {WEIGHTS}")
    if weight == "links" or spots is None:
        rows = link_facts.select("sf", "uri", F.lit(1).cast("long").alias("weight"))
    else:
        rows = link_spot_join(link_facts, spots).select("sf", "uri", "weight")
    if resolved is not None:
        rows = rows.unionByName(resolved.select(F.col("title").alias("sf"), F.col("final").alias("uri"),
                                                F.lit(1).cast("long").alias("weight")))
    return rows.where(F.col("uri").isNotNull() & (F.length("uri") > 0))


def pair_counts(link_facts: DataFrame, spots: DataFrame | None = None, resolved: DataFrame | None = None,
                weight: str = "occurrences") -> DataFrame:
    """A2: (sf, uri, n)."""
    return (weighted_pairs(link_facts, spots, resolved, weight)
            .groupBy("sf", "uri").agg(F.sum("weight").cast("long").alias("n")))


def uri_counts_from_pairs(pairs: DataFrame) -> DataFrame:
    """A1 as the roll-up of A2: (uri, n)."""
    return pairs.groupBy("uri").agg(F.sum("n").cast("long").alias("n"))


def uri_counts(link_facts: DataFrame, spots: DataFrame | None = None, resolved: DataFrame | None = None,
               weight: str = "occurrences") -> DataFrame:
    """A1: (uri, n)."""
    return (weighted_pairs(link_facts, spots, resolved, weight)
            .groupBy("uri").agg(F.sum("weight").cast("long").alias("n")))


def sf_annotated_counts(link_facts: DataFrame) -> DataFrame:
    """A3: (sf, annotated) = number of link facts per anchor text."""
    return (link_facts.where(F.col("sf").isNotNull())
            .groupBy("sf").agg(F.count(F.lit(1)).alias("annotated")))


def sf_spotted_counts(spots: DataFrame) -> DataFrame:
    """A4: (sf, spotted) = number of spots per surface form."""
    return spots.where(F.col("sf").isNotNull()).groupBy("sf").agg(F.count(F.lit(1)).alias("spotted"))


def annotated_with_totals(link_facts: DataFrame, spots: DataFrame) -> DataFrame:
    """A5 before U2: (sf, annotated, total); an anchor never spotted gets total 1 (even
    when annotated more often), spotted-only forms are absent."""
    a = sf_annotated_counts(link_facts)
    s = sf_spotted_counts(spots)
    return (a.join(s, "sf", "left")
            .select("sf", "annotated", F.coalesce("spotted", F.lit(1)).cast("long").alias("total")))


def lowercase_phantoms(totals: DataFrame) -> DataFrame:
    """One (lower(sf), -1, 1) row for every sf that differs from its lower case."""
    return (totals.where(F.col("sf") != F.lower("sf"))
            .select(F.lower("sf").alias("sf"), F.lit(-1).cast("long").alias("annotated"),
                    F.lit(1).cast("long").alias("total")))


def total_sf_counts(link_facts: DataFrame, spots: DataFrame, dedupe_lowercase: bool = False) -> DataFrame:
    """A5 + U2: (sf, annotated, total) with the lower-case rows appended (UNION ALL).
    ``dedupe_lowercase`` keeps one phantom per lower-case form and none where the
    lower-case form is itself an annotated anchor."""
    totals = annotated_with_totals(link_facts, spots)
    ph = lowercase_phantoms(totals)
    if dedupe_lowercase:
        ph = ph.distinct().join(totals.select("sf"), "sf", "left_anti")
    return totals.unionByName(ph)
