"""MinHash near-dedup by an inverted join of signature coordinates.

A document's set holds the 64-bit hashes of its distinct k-word shingles (words: lower-cased
runs outside ``[\\x20\\x09-\\x0D]``; fewer words make one shingle, none make an empty set).
Documents with the same set are one class, represented by the smallest doc_id. A class posts
itself under (coordinate, value) pairs of its ``COORDINATES`` MinHash coordinates:

* prefix: two signatures that agree in at least ``MATCHES`` coordinates share one of the
  PREFIX rarest of either; only those are posted, rarest first, so values that are common in
  the corpus are skipped wherever a signature has rarer ones. A posted key is two
  coordinates with both their values (of 26 coordinates that differ, each spoils one of 32
  keys, so 6 keys are equal at least), which unrelated documents share by chance far less often
  than one value, and the less the larger the corpus;
* merge: a list is first merged as a star: its smallest member against all others. Members
  that are connected then need no comparison any more, so a large group of near copies costs
  a pass over it instead of its square. Lists that still hold several components form
  clusters (lists that share members); in each, the members outside the largest component
  are compared with all members of similar set size, in blocks of about ``BLOCK`` shingles
  that a task holds while the outsiders stream past it;
* match: of each pair of a star the agreeing coordinates are counted, and pairs with at least
  MATCHES are confirmed on their full sets, 100 * intersection >= 80 * union; in a block the
  full sets are compared at once, by merging their shingles with those of the block.

At a similarity of 0.8 a pair agrees in 51 of 64 coordinates on average; fewer than 38 agree
with a probability below 1e-4. Within that, no link between components is lost: two members
of a list that end in different components have been compared on their full sets.

Defined results: a null or empty text has an empty set and is linked with nothing; a document
with a null doc_id is linked with nothing, has a null component_id and is kept; rows that
repeat a doc_id are one document with the links of all its texts; other columns are ignored,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkstats.llm import wordhash as wh
from linkstats.llm.common import map_arrow, same, table
from linkstats.llm.components import components
from linkstats.session import checked_broadcast, materialize, scratch_tables

COORDINATES, MATCHES, PERCENT, BLOCK = 64, 38, 80, 1 << 20
KEYS = COORDINATES // 2
COMMON = KEYS - (COORDINATES - MATCHES)  # equal keys of two signatures that agree in MATCHES coordinates
PREFIX = KEYS - COMMON + 1
_RNG = np.random.default_rng(4711)
_A = (_RNG.integers(0, 1 << 31, COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_B = _RNG.integers(0, 1 << 32, COORDINATES, dtype=np.uint32)[:, None]

_SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()),
                     ("sig", pa.list_(pa.int32()))])


def signature(sets: np.ndarray) -> np.ndarray:
    """The MinHash coordinates of a set of 64-bit hashes."""
    x = (sets >> np.uint64(32)).astype(np.uint32)
    low = np.full(COORDINATES, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(x), 1024):
        np.minimum(low, (x[None, i:i + 1024] * _A + _B).min(axis=1), out=low)
    return low.view(np.int32)


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words, at in wh.word_blocks(batch.column("text")):
                n, f1, f2, sig = [], [], [], []
                for i in range(b - a):
                    s = wh.shingles(words[at[i]:at[i + 1]], k)
                    n.append(len(s))
                    f1.append(int(np.add.reduce(wh.mix(s)).view(np.int64)))
                    f2.append(int(np.add.reduce(wh.mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5))).view(np.int64)))
                    sig.append(signature(s) if len(s) else np.zeros(0, dtype=np.int32))
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in sig])]).astype(np.int32),
                                                 np.concatenate(sig))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(n, pa.int64()), pa.array(f1, pa.int64()),
                                                  pa.array(f2, pa.int64()), lists], schema=_SIGNED)
    return run


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose signatures agree in MATCHES coordinates or more."""
    for batch in batches:
        sa, sb = (np.asarray(batch.column(c).flatten()).reshape(-1, COORDINATES) for c in ("sig_a", "sig_b"))
        near = (sa == sb).sum(axis=1) >= MATCHES
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(near))


def _linked(k: int, percent: int):
    """Confirms pairs on their full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                a, b = batch.column("text_a")[i].as_py() or "", batch.column("text_b")[i].as_py() or ""
                if a != last:
                    last, left = a, shingle_set(a, k)
                right = shingle_set(b, k)
                both = len(left) + len(right)
                common = both - len(np.unique(np.concatenate([left, right])))
                keep[i] = 100 * common >= percent * (both - common)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))
    return run


def shingle_set(text: str, k: int) -> np.ndarray:
    parts = [w for _, _, w, _ in wh.word_blocks(pa.array([text], pa.string()))]
    return wh.shingles(parts[0], k)


def _postings(nodes: DataFrame) -> DataFrame:
    """(token, node, n_shingles): each class under those of its PREFIX rarest keys that
    another class has too. A key that no other class has takes its place in the prefix but
    needs no posting."""
    keys = F.array(*[F.xxhash64(F.lit(i), F.get("sig", F.lit(2 * i)), F.get("sig", F.lit(2 * i + 1))) for i in range(KEYS)])
    tokens = nodes.select("node", "f1", "n_shingles", F.explode(keys).alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    own = (tokens.hint("merge").join(shared, "token")
           .groupBy("node", "f1", "n_shingles").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("own")))
    taken = F.slice("own", F.lit(1), F.greatest(F.lit(PREFIX - KEYS) + F.size("own"), F.lit(0)))
    return own.select("node", "n_shingles", F.explode(taken).alias("t")).select("t.token", "node", "n_shingles").distinct()


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


class _Block:
    """The members of one block, by shingle."""

    def __init__(self, nodes: list[int], components: list[int], texts: list[str], k: int):
        sets = [shingle_set(t or "", k) for t in texts]
        self.node, self.component, self.size = np.array(nodes), np.array(components), np.array([len(s) for s in sets])
        shingle, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(shingle, kind="stable")
        self.shingle, self.owner = shingle[order], owner[order]

    def linked(self, own: np.ndarray, component: int, percent: int) -> np.ndarray:
        """One member of each other component that is linked with the set ``own``."""
        lo, hi = np.searchsorted(self.shingle, own), np.searchsorted(self.shingle, own, side="right")
        n = hi - lo
        at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        common = np.bincount(self.owner[at], minlength=len(self.node))
        ok = np.flatnonzero((100 * common >= percent * (self.size + len(own) - common)) & (self.component != component))
        return self.node[ok[np.unique(self.component[ok], return_index=True)[1]]]


def _outsiders(k: int, percent: int):
    """Rows sorted by (cluster, band, block, outside): members first, then the outsiders."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, block = None, ([], [], []), None
        for batch in batches:
            a, b = [], []
            for *key, outside, node, component, text in zip(*(batch.column(c).to_pylist() for c in (
                    "cluster", "band", "block", "outside", "node", "component", "text"))):
                if key != now:
                    now, held, block = key, ([], [], []), None
                if not outside:
                    for column, value in zip(held, (node, component, text)):
                        column.append(value)
                elif held[0]:
                    block = block or _Block(*held, k)
                    links = block.linked(shingle_set(text or "", k), component, percent)
                    a += [node] * len(links)
                    b += links.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_PAIR)
    return run


def _star_links(postings: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): confirmed links of every list's smallest member. The signatures are compared
    first, so texts move only for the pairs that agree."""
    pivots = postings.groupBy("token").agg(F.min(F.struct("node", "n_shingles")).alias("p"))
    pairs = (postings.hint("merge").join(pivots, "token").where(F.col("node") > F.col("p.node"))
             .where(100 * F.least("n_shingles", "p.n_shingles") >= percent * F.greatest("n_shingles", "p.n_shingles"))
             .select(F.col("p.node").alias("a"), F.col("node").alias("b")).distinct())

    def with_both(pairs: DataFrame, column: str) -> DataFrame:
        of_a, of_b = (texts.select(F.col("node").alias(x), F.col(column).alias(f"{column}_{x}")) for x in ("a", "b"))
        return pairs.join(of_b.hint("merge"), "b").join(of_a.hint("merge"), "a").select("a", "b", f"{column}_a", f"{column}_b")

    near = materialize(map_arrow(with_both(pairs, "sig"), _agreeing, "a long, b long"), "near_agreeing")
    return materialize(map_arrow(with_both(near, "text"), _linked(k, percent), "a long, b long"), "near_star")


def _outside_links(postings: DataFrame, known: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): links between members of different components in lists that have several."""
    postings = materialize(postings.join(known, "node", "left").withColumn("component", F.coalesce("component", "node")), "near_postings")
    lists = (postings.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("node").alias("b"))
             .where("low <> high").select("token", "b"))
    active = materialize(postings.join(lists, "token"), "near_active")
    clusters = components(active.select(F.col("node").alias("a"), "b")).withColumnRenamed("component", "cluster")
    members = active.select("node", "n_shingles", "component").distinct().join(clusters, "node")
    members = materialize(members.withColumn("band", F.floor(F.log("n_shingles") / F.log(F.lit(100 / percent)))), "near_members")
    main = (members.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("cluster").agg(F.max_by("component", F.struct("n", "component")).alias("main")))
    bands = members.groupBy("cluster", "band").agg(F.ceil(F.sum("n_shingles") / BLOCK).alias("blocks"))
    inside = members.join(bands, ["cluster", "band"]).select(
        "cluster", "band", F.pmod(F.xxhash64("node"), "blocks").alias("block"), F.lit(False).alias("outside"), "node", "component")
    out = (members.join(main, "cluster").where("component <> main")
           .withColumn("band", F.explode(F.array(*[F.col("band") + i for i in (-1, 0, 1)])))
           .join(bands, ["cluster", "band"])
           .select("cluster", "band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
                   F.lit(True).alias("outside"), "node", "component"))
    rows = inside.unionByName(out).join(texts.select("node", "text"), "node")
    rows = rows.repartition("cluster", "band", "block").sortWithinPartitions("cluster", "band", "block", "outside")
    return materialize(map_arrow(rows, _outsiders(k, percent), "a long, b long"), "near_outside")


def _links(docs: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, component) of every class that is linked with another."""
    postings = materialize(_postings(nodes), "near_postings")
    posted = materialize(postings.select("node").distinct(), "near_posted")
    texts = docs.join(checked_broadcast(posted), docs["doc_id"] == posted["node"], "left_semi")
    texts = texts.select(F.col("doc_id").alias("node"), "text").join(nodes.select("node", "sig"), "node")
    texts = materialize(texts, "near_texts")
    known = components(_star_links(postings, texts, k, percent))
    more = _outside_links(postings, known, texts, k, percent)
    c = known.select(F.col("node"), F.col("component"))
    between = (more.join(c.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
               .join(c.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
               .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    merged = components(between)
    moved = (known.join(merged.select(F.col("node").alias("component"), F.col("component").alias("new")), "component", "left")
             .select("node", F.coalesce("new", "component").alias("component")))
    return moved.unionByName(merged.join(known.select("node"), "node", "left_anti"))


def near_components(docs: DataFrame, k: int = 5, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = materialize(map_arrow(docs, _sign(k), "doc_id long, n_shingles long, f1 long, f2 long, sig array<int>"), "near_signed")
    nodes = (signed.where("n_shingles > 0 and doc_id is not null").groupBy("f1", "f2", "n_shingles")
             .agg(F.min("doc_id").alias("node"), F.first("sig").alias("sig")))
    nodes = materialize(nodes, "near_nodes")
    rows = signed.select("doc_id", "n_shingles", "f1", "f2")
    with scratch_tables(docs.sparkSession) as scope:  # postings, texts and rounds go when the links are known
        linked = scope.keep(_links(docs, nodes, k, percent), "near_linked")
    classes = (nodes.select("f1", "f2", "n_shingles", "node").join(linked, "node", "left")
               .select("f1", "f2", "n_shingles", F.coalesce("component", "node").alias("component")))
    classes = materialize(classes, "near_classes")
    out = rows.join(classes.hint("merge"), ["f1", "f2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      same(F.col("doc_id"), component).alias("kept"))


def keep_one_of_each(docs: DataFrame, k: int = 5, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    gone = materialize(near_components(docs, k, percent, id_col, text_col).where("not kept")
                       .select(F.col("doc_id").alias("__gone")).distinct(), "near_gone")
    return docs.join(checked_broadcast(gone), docs[id_col].cast("bigint") == gone["__gone"], "left_anti")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"), k=2)
