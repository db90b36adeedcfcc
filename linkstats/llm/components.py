"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkstats.llm.common import map_arrow
from linkstats.session import checked_broadcast, materialize

# Edges that a task merges at once, and the measured bytes of a row of two numbers.
EDGES, ROW_BYTES = 1 << 20, 32


def merged(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges (a, b) as a forest of stars: each node but the smallest of its component with
    the smallest. Roots are hooked to smaller ones and paths halved until nothing moves."""
    node, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[:len(a)], ends[len(a):]
    root = np.arange(len(node))
    while True:
        low, high = np.minimum(root[left], root[right]), np.maximum(root[left], root[right])
        apart = low != high
        if not apart.any():
            break
        left, right = left[apart], right[apart]
        np.minimum.at(root, high[apart], low[apart])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    moved = np.flatnonzero(root != np.arange(len(node)))
    return node[moved], node[root[moved]]


def _merged_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's edges (a, b), ``EDGES`` at a time, as stars: the same components by no more
    edges than nodes."""
    def out(a, b):
        high, low = merged(np.concatenate(a), np.concatenate(b))
        return pa.RecordBatch.from_arrays([pa.array(high, pa.int64()), pa.array(low, pa.int64())], names=["a", "b"])
    a, b, n = [], [], 0
    for batch in batches:
        a.append(batch.column("a").to_numpy())
        b.append(batch.column("b").to_numpy())
        n += batch.num_rows
        if n >= EDGES:
            yield out(a, b)
            a, b, n = [], [], 0
    if n:
        yield out(a, b)


def _local(edges: DataFrame, n: int) -> DataFrame:
    """The ``n`` edges merged by as many tasks as hold ``EDGES`` of them each: a node that stands
    in the edges of several tasks comes out of each of them."""
    return map_arrow(edges.select("a", "b").coalesce(-(-n // EDGES) or 1), _merged_in_task, "a long, b long")


def _step(edges: DataFrame, name: str) -> tuple[DataFrame, int, bool]:
    """The edges, each once, merged by their tasks; their number, and whether they are stars."""
    edges = materialize(edges.distinct(), f"{name}_edges")
    n = edges.count()
    edges = materialize(_local(edges, n), name)
    return (edges, n, True) if n <= EDGES else (edges, *_stars(edges))


def _star(edges: DataFrame, large: bool, n: int) -> DataFrame:
    """Links the larger (large star) or the smaller (small star) neighbours of every node,
    and the node itself, to the smallest of them. Minima are aggregated before the shuffle,
    so a hub's neighbours never meet in one task; those of ``n`` edges are broadcast if few.
    An edge may come several times."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    low = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    joined = both.hint("merge").join(checked_broadcast(low, ROW_BYTES * n * (2 if large else 1)), "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
    return moved.where("a <> b")


def _stars(edges: DataFrame) -> tuple[int, bool]:
    """The number of edges (a, b), and whether they are stars: each a has one b, which is no a."""
    none = F.lit(None).cast("long")
    ends = edges.select(F.col("a").alias("node"), "b", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), none.alias("b"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("node").agg(F.min("b").alias("low"), F.max("b").alias("high"), F.sum("up").alias("up"), F.max("down").alias("down"))
    bad = (F.col("low") < F.col("high")) | ((F.col("up") > 0) & (F.col("down") > 0))
    n, some = ends.agg(F.coalesce(F.sum("up"), F.lit(0)), F.coalesce(F.max(F.coalesce(bad, F.lit(False)).cast("int")), F.lit(0))).first()
    return int(n), not some


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of the edges (a, b) with the smallest node it reaches.

    Each task first merges the edges it holds; up to ``EDGES`` of them need no more. Rounds are
    written tables, in which an edge that several tasks give out stays once; their number grows
    with the logarithm of the longest path, and the last one is known by its edges being stars.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    (edges, n, done), large = _step(edges, "cc"), False
    while not done:
        edges, n, done = _step(_star(edges, large, n), "cc_large" if large else "cc_small")
        large = not large
    edges = materialize(edges.distinct(), "cc_stars")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
