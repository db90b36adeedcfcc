"""Mixing sources to target weights by cube-method balanced sampling.

Sources in code-point order (null last) weigh 3, 1, 2, repeating, and share ``share`` times
all words; a source's target stops at ``max_repeat`` times its size and the excess is
reshared by weight until none is above (a water level, found by a few one-row aggregates).

With r = target / size of a source, every document is taken floor(r) times, and once more
with inclusion probability p = r - floor(r). Which ones is decided by the cube method: the
vector of probabilities moves at random through the null space of the constraints (documents
and words keep their totals) until at most two entries stay fractional. A source is cut into
hash blocks of about ``block`` documents, each balanced by itself; the two entries that a
block leaves meet again in the next level, until the source is one block. ``HELD`` entries of
all sizes are held back, by that block or by those that meet in it, and are rounded with its
last two to the nearest word total (the landing), whatever the size of other sources. So a
hot source is many tasks,
and every group has a bounded number of rows. Random numbers are seeded by source, level and
block: reruns agree.

Defined results: a null text has size 0; documents of size 0 are taken 0 times; a null source
is a source; repeated rows are documents of their own; other columns are ignored, whatever
their names; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkstats.llm.common import same, ship, table, text_of
from linkstats.operators.tokens import with_dense_ids
from linkstats.session import materialize

WEIGHTS, SHARE, MAX_REPEAT, BLOCK, HELD = (3, 1, 2), 1.5, 2.0, 4096, 10
_EPS = 1e-9


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """(source, source_size, n_docs, target), one row per source."""
    sums = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.when(F.col("size") > 0, 1).otherwise(0)).alias("n_docs"))
    ranked = with_dense_ids(sums, F.asc_nulls_last("source"), "__rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("__rank") - 1) % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.withColumn("__weight", weight), "mix_sources")
    cap = max_repeat * F.col("source_size")
    total, weight_sum = ranked.agg(F.sum("source_size"), F.sum("__weight")).first()
    goal = share * (total or 0)
    level, full = (goal / weight_sum if weight_sum else 0.0), -1
    while True:
        over = cap <= F.col("__weight") * level
        n, used, rest = ranked.agg(F.coalesce(F.sum(F.when(over, 1)), F.lit(0)), F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)),
                                   F.coalesce(F.sum(F.when(~over, F.col("__weight"))), F.lit(0.0))).first()
        if n == full or rest == 0:
            break
        full, level = n, (goal - used) / rest
    return ranked.select("source", "source_size", "n_docs", F.least(cap, F.col("__weight") * level).alias("target"))


def flight(size: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Moves ``p`` within [0, 1] so that sum(p) and sum(p * size) stay as they are, until at
    most two entries are fractional."""
    p, active = p.copy(), []
    for unit in rng.permutation(len(p)).tolist():
        if not _EPS < p[unit] < 1 - _EPS:
            continue
        active.append(unit)
        if len(active) < 3:
            continue
        a, b, c = active
        u = (size[c] - size[b], size[a] - size[c], size[b] - size[a])
        if u == (0, 0, 0):
            u = (1.0, -1.0, 0.0)
        up = min(((1 - p[i]) if v > 0 else p[i]) / abs(v) for i, v in zip(active, u) if v)
        down = min((p[i] if v > 0 else 1 - p[i]) / abs(v) for i, v in zip(active, u) if v)
        step = up if rng.random() * (up + down) < down else -down
        for i, v in zip(active, u):
            p[i] = min(1.0, max(0.0, p[i] + step * v))
            if p[i] <= _EPS or p[i] >= 1 - _EPS:
                p[i] = round(p[i])
        active = [i for i in active if 0 < p[i] < 1]
    return p


def held_back(size: np.ndarray, count: int = HELD, block: int = 0, blocks: int = 1) -> np.ndarray:
    """Up to ``count`` entries, evenly spaced by size, that wait for the landing; of several
    blocks each holds its part of them."""
    order = np.argsort(size, kind="stable")
    spaced = np.linspace(0, len(order) - 1, count).astype(int)[block::blocks]
    return order[np.unique(spaced)] if len(order) else order


def land(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Rounds the fractional entries (HELD + 2 at most) to the words, then documents, nearest
    to their expected totals."""
    open_ = np.flatnonzero((p > 0) & (p < 1))
    if not len(open_):
        return p
    p = p.copy()
    choices = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    words = np.abs(choices @ size[open_] - size[open_] @ p[open_])
    number = np.abs(choices.sum(axis=1) - p[open_].sum())
    p[open_] = choices[np.lexsort([number, words])[0]]
    return p


def _balance(level: int, fan: int):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["salt", "doc_id", "size"], kind="stable", na_position="last").reset_index(drop=True)
        block, blocks = int(g["block"].iloc[0]), int(g["blocks"].iloc[0])
        rng = np.random.default_rng([level, int(g["key"].iloc[0]) & (2**63 - 1), block])
        size, p = g["size"].to_numpy(dtype=float), g["p"].to_numpy(dtype=float)
        if blocks > fan:
            g["p"] = flight(size, p, rng)
            return g
        held = held_back(size, block=block, blocks=blocks)  # the source lands here or in the next level
        moved = p.copy()
        moved[held] = 0.0  # flight() passes over them
        moved = flight(size, moved, rng)
        moved[held] = p[held]
        g["p"] = land(size, moved) if blocks <= 1 else moved
        return g
    return run


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, max_repeat: float = MAX_REPEAT, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken."""
    text = text_of(text_col)
    sizes = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
                        F.xxhash64(F.col(id_col), text).alias("salt"))
    sizes = materialize(sizes, "mix_sizes")
    targets = materialize(source_targets(sizes, weights, share, max_repeat), "mix_targets")
    t = targets.withColumnRenamed("source", "t_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = (sizes.join(t, same(sizes["source"], t["t_source"])).drop("t_source")
            .withColumn("rate", rate).withColumn("base", F.floor(F.col("rate") + _EPS))
            .withColumn("p", F.when(F.col("size") > 0, F.greatest(F.col("rate") - F.col("base"), F.lit(0.0))).otherwise(F.lit(0.0)))
            .withColumn("p", F.when(F.col("p") > _EPS, F.col("p")).otherwise(F.lit(0.0)))
            .withColumn("blocks", F.ceil(F.col("n_docs") / block).cast("long"))
            .withColumn("block", F.pmod(F.col("salt"), F.greatest("blocks", F.lit(1).cast("long"))))
            .withColumn("key", F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull()))
            .drop("rate", "n_docs"))
    rows = materialize(rows, "mix_rows")
    done = [rows.where("p = 0")]
    open_ = rows.where("p > 0")
    blocks = rows.agg(F.coalesce(F.max("blocks"), F.lit(1))).first()[0]
    ship(docs.sparkSession)
    level, fan = 0, block // 2  # a block leaves two entries at most, besides those held back
    while True:
        out = open_.groupBy("key", "source", "block").applyInPandas(_balance(level, fan), open_.schema)
        out = materialize(out, "mix_level")
        done.append(out.where("p in (0, 1)"))
        if blocks <= 1:
            break
        open_ = (out.where("p not in (0, 1)").withColumn("block", F.expr(f"block div {fan}"))
                 .withColumn("blocks", F.expr(f"(blocks + {fan - 1}) div {fan}")))
        blocks, level = -(-blocks // fan), level + 1
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    taken = (F.col("size") * (F.col("base") + F.col("p"))).cast("long")
    return result.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")
