"""Redirect resolution over the redirect graph (R1-R3) and link target lookup.

Rule for a title s with target map m: walk x1 = m(s), x2 = m(x1), ...; stop at the first
x_k with no target (return it) or the first x_k already visited on this walk (return
it). The start title is not part of the visited set, so a title on a cycle resolves to
its direct target, a tail into a cycle to the cycle entry, and a self-loop to itself.

Resolved by pointer doubling at every size: rounds grow with the logarithm of the longest
walk. Every round is a table written under the session's checkpoint folder, so lineage
stays one round deep and a lost executor only recomputes the last round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkstats import session as sess


def unique_edges(edges: DataFrame) -> DataFrame:
    """One target per title: the smallest, so duplicate titles resolve deterministically."""
    return (edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
            .groupBy("src").agg(F.min("dst").alias("dst")))


def resolve(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """R2: (title, final) for every redirect title, in O(log longest walk) rounds.

    Give every terminal title a self-loop, so every walk ends on a cycle. Doubling the
    successor pointer until the image of p^(2^k) stops shrinking yields exactly the cycle
    and terminal nodes; a second doubling jumps each node to the first such node on its
    walk. A title resolves to that node for its direct target, which is the walk rule. Where
    the first doubling comes to rest at titles without a target, there is no cycle and the
    second is not needed.
    Each round is one self-join over all nodes, written as a table.
    """
    e = sess.materialize(unique_edges(edges), "redirect_edges")
    nodes = e.select(F.col("src").alias("v")).union(e.select(F.col("dst").alias("v"))).distinct()
    succ = sess.materialize(nodes.join(e.select(F.col("src").alias("v"), F.col("dst").alias("p")), "v", "left")
                            .select("v", F.coalesce("p", "v").alias("p")), "redirect_succ")

    def square(t: DataFrame, col: str) -> DataFrame:
        b = t.select(F.col("v").alias("_b"), F.col(col).alias("_next"))
        return sess.materialize(t.join(b, t[col] == b["_b"]).select("v", F.col("_next").alias(col), F.col(col).alias("_old")),
                                "redirect_round").select("v", col, "_old")

    def state(t: DataFrame, old) -> tuple[int, int]:
        """(how many pointers moved in the last round, how many nodes are pointed to)."""
        r = t.agg(F.coalesce(F.sum((F.col("j") != old).cast("int")), F.lit(0)), F.countDistinct("j")).first()
        return r[0], r[1]

    jump = succ.select("v", F.col("p").alias("j"))
    moved, size = state(jump, F.col("v"))
    for _ in range(max_rounds):
        if not moved:
            break
        nxt = square(jump, "j")
        moved, nxt_size = state(nxt, F.col("_old"))
        if nxt_size == size and moved:  # only the places on cycles change any more
            break
        jump, size = nxt.select("v", "j"), nxt_size
    else:
        raise RuntimeError(f"no fixpoint after {max_rounds} doubling rounds")

    def finals(ends: DataFrame) -> DataFrame:
        return e.join(ends.toDF("dst", "final"), "dst").select(F.col("src").alias("title"), "final")

    # Pointers at rest stand at titles without a target, unless a cycle's length divides the step.
    if not moved and jump.join(e.select(F.col("src").alias("j")), "j", "left_semi").isEmpty():
        return finals(jump)
    stops = jump.select(F.col("j").alias("v")).distinct().withColumn("_stop", F.lit(True))

    first = sess.materialize(succ.join(stops, "v", "left")
                             .select("v", F.when(F.col("_stop"), F.col("v")).otherwise(F.col("p")).alias("t")), "redirect_first")
    for _ in range(max_rounds):
        stepped = square(first, "t")
        first = stepped.select("v", "t")
        if stepped.where("t <> _old").isEmpty():
            break
    else:
        raise RuntimeError(f"no fixpoint after {max_rounds} doubling rounds")
    return finals(first)


def resolve_final_first(edges: DataFrame) -> DataFrame:
    """(final, title), the orientation the surface-form counts consume."""
    return resolve(edges).select("final", "title")


def resolve_targets(uris: DataFrame, resolved: DataFrame, uri_col: str = "uri") -> DataFrame:
    """Resolved target of each id through the redirect map: an exact title match
    first, else the smallest final among titles equal ignoring case, else the id.
    Looks up distinct ids only, then joins back."""
    distinct_ids = uris.select(F.col(uri_col).alias("_u")).distinct()
    exact = resolved.select(F.col("title").alias("_u"), F.col("final").alias("_exact"))
    folded = (resolved.groupBy(F.lower("title").alias("_lu"))
              .agg(F.min("final").alias("_folded")))
    looked = (distinct_ids.join(exact, "_u", "left")
              .join(folded, F.lower(F.col("_u")) == F.col("_lu"), "left")
              .select("_u", F.coalesce("_exact", "_folded", "_u").alias("target")))
    return uris.join(looked, uris[uri_col] == looked["_u"], "left").drop("_u")
