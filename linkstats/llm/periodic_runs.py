"""Periodic runs (operator 13) by grammar compression.

The word ids of a block of documents are compressed by Re-Pair: every round counts the
neighbouring pairs and replaces repeated ones by new symbols, the more frequent first (pairs
of one class of doubling counts in a mixed order, so that a round replaces many pairs that do
not overlap). What is left of a document is paired up as it stands, so each document becomes
one symbol. A run lies across the boundary of the smallest symbol that covers it: for each
symbol the runs across its boundary are computed once, at one place where it stands, then
carried to all places where the symbol is derived; pieces of one run are merged into the
longest. Words and stretches are compared by 64-bit hashes, and every run is then verified
word by word.

A run is a longest stretch of words with smallest period q (words q apart are equal) of at
least ``max(MIN_WORDS, EXPONENT * q)`` words. A document is one row and one unit of work; a
block of documents holds about ``BLOCK_BYTES`` of text, and memory is about 400 bytes a word
of the block or of its only document.

Defined cases: a null or empty text has no words and no runs, and collapses to the empty
text; rows with equal or null ids are rows like others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkstats.llm import wordhash as wh
from linkstats.llm.common import map_arrow, table, text_of

MIN_WORDS, EXPONENT = 6, 4
BLOCK_BYTES = 1 << 21
_PAIRS = 1 << 21  # (symbol, period) pairs looked at in one go
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Grammar:
    """Symbols over word ids. Symbol ``n_words + i`` is rule i: it stands for the words from
    ``lo[i]`` to ``hi[i]``, and its two symbols meet at ``mid[i]``."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray):
        """``ids``: word ids from 0 of documents laid end to end, ``doc``: their documents."""
        self.n_words = int(ids.max()) + 1 if len(ids) else 0
        self._rules: list[tuple[np.ndarray, ...]] = []
        self._n = self.n_words
        symbol, at, until = ids.astype(np.int64), np.arange(len(ids)), np.arange(1, len(ids) + 1)
        while True:
            chosen, which = self._repeated_pairs(symbol, doc)
            if not len(chosen):
                break
            symbol, at, until, doc = self._replace(symbol, at, until, doc, chosen, which)
        while True:
            first = np.concatenate([[0], np.flatnonzero(doc[1:] != doc[:-1]) + 1]) if len(doc) else np.zeros(0, np.int64)
            size = np.diff(np.append(first, len(doc)))
            place = np.arange(len(doc)) - np.repeat(first, size)
            chosen = np.flatnonzero((place % 2 == 0) & (place + 1 < np.repeat(size, size)))
            if not len(chosen):
                break
            symbol, at, until, doc = self._replace(symbol, at, until, doc, chosen, np.arange(len(chosen)))
        self.roots, self.root_at = symbol, at
        empty = [np.zeros(0, dtype=np.int64)] * 5
        self.left, self.right, self.lo, self.mid, self.hi = (
            map(np.concatenate, zip(*self._rules)) if self._rules else empty)
        self.rounds = [len(r[0]) for r in self._rules]

    def _repeated_pairs(self, symbol, doc):
        """Places of the pairs to replace now, and the number of each one's rule: of the pairs
        that stand twice or more, those before both neighbours in the order of replacement."""
        none = np.zeros(0, dtype=np.int64)
        if len(symbol) < 2:
            return none, none
        pair = symbol[:-1] * np.int64(self._n) + symbol[1:]
        inside = np.flatnonzero(doc[:-1] == doc[1:])
        kinds, kind, count = np.unique(pair[inside], return_inverse=True, return_counts=True)
        # frequency class above 56 mixed bits; 0 marks what is no candidate
        rank = np.floor(np.log2(count)).astype(np.uint64) << np.uint64(56)
        rank = np.where(count > 1, rank | (wh.mix(kinds.astype(np.uint64)) >> np.uint64(8)), np.uint64(0))
        order = np.zeros(len(symbol) + 1, dtype=np.uint64)  # of the pair that begins at i, at i + 1
        order[inside + 1] = rank[kind]
        change = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]]))
        before = np.concatenate([[0], order[change[:-1]]]).astype(np.uint64)
        after = np.append(order[change[1:]], np.uint64(0))
        size = np.diff(np.append(change, len(order)))
        top = (order[change] > before) & (order[change] > after)
        # equal neighbours (a a a a) are one stretch, of which every other pair is replaced
        step = np.arange(len(order)) - np.repeat(change, size)
        chosen = np.flatnonzero(np.repeat(top, size) & (step % 2 == 0)) - 1
        if not len(chosen):
            return none, none
        return chosen, np.unique(pair[chosen], return_inverse=True)[1]

    def _replace(self, symbol, at, until, doc, chosen, which):
        n = int(which.max()) + 1
        example = np.zeros(n, dtype=np.int64)
        example[which] = chosen
        self._rules.append((symbol[example], symbol[example + 1], at[example], until[example], until[example + 1]))
        symbol, until = symbol.copy(), until.copy()
        symbol[chosen] = self._n + which
        until[chosen] = until[chosen + 1]
        self._n += n
        keep = np.ones(len(symbol), dtype=bool)
        keep[chosen + 1] = False
        return symbol[keep], at[keep], until[keep], doc[keep]


class Stretches:
    """Compares stretches of words by the running sums of their hashes."""

    def __init__(self, ids: np.ndarray):
        values = wh.mix(ids.astype(np.uint64) + np.uint64(1)) | np.uint64(1)
        self._power = wh.powers("base", int(_BASE), len(ids) + 1)
        self._sum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * self._power[:len(ids)], dtype=np.uint64)])

    def equal(self, a, b, size):
        """Whether the ``size`` words from ``a`` and from ``b`` > a are the same."""
        s = self._sum
        return (s[a + size] - s[a]) * self._power[b - a] == s[b + size] - s[b]

    def reach(self, a, b, most, forward: bool):
        """How many words from ``a`` and from ``b`` on (or before them) are the same, up to ``most``."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            half = (low + high + 1) // 2
            same = self.equal(a, b, half) if forward else self.equal(a - half, b - half, half)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low


def boundary_runs(ids: np.ndarray, g: Grammar) -> tuple[np.ndarray, ...]:
    """(rule, start, end, period) of the runs of each rule's words across its boundary, by
    rule, at the rule's own example. A run of 4 periods has 2 on one side of the boundary, so
    a period q shows as an equal pair of neighbours of q words there."""
    same = Stretches(ids)
    found = []
    for right in (True, False):
        side = g.hi - g.mid if right else g.mid - g.lo
        most = np.where(g.hi - g.lo >= MIN_WORDS, np.minimum(side // 2, (g.hi - g.lo) // EXPONENT), 0)
        rules = np.flatnonzero(most > 0)
        until = np.cumsum(most[rules])
        a = 0
        while a < len(rules):
            done = until[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(until, done + _PAIRS, side="right")))
            part = rules[a:b]
            rule = np.repeat(part, most[part])
            q = np.arange(len(rule)) - np.repeat(until[a:b] - most[part] - done, most[part]) + 1
            mid = g.mid[rule]
            hit = ids[mid] == ids[mid + q] if right else ids[mid - 1] == ids[mid - 1 - q]
            rule, q = rule[hit], q[hit]
            start = g.mid[rule] if right else g.mid[rule] - 2 * q
            hit = same.equal(start, start + q, q)
            found.append((rule[hit], q[hit], g.mid[rule[hit]] if right else g.mid[rule[hit]] - q[hit]))
            a = b
    rule, q, at = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
    end = at + q + same.reach(at, at + q, g.hi[rule] - at - q, True)
    start = at - same.reach(at, at + q, at - g.lo[rule], False)
    good = (end - start >= np.maximum(MIN_WORDS, EXPONENT * q)) & (start < g.mid[rule]) & (end > g.mid[rule])
    rule, start, end, q = rule[good], start[good], end[good], q[good]
    order = np.lexsort((q, end, start, rule))  # of several periods of one stretch the smallest stays
    rule, start, end, q = rule[order], start[order], end[order], q[order]
    first = np.concatenate([[True], (rule[1:] != rule[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])])[:len(rule)]
    return rule[first], start[first], end[first], q[first]


def all_runs(ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run of documents laid end to end, by start and period."""
    g = Grammar(ids, doc)
    rule, start, end, q = boundary_runs(ids, g)
    none = np.zeros(0, dtype=np.int64)
    if not len(rule):
        return none, none, none
    n = np.bincount(rule, minlength=len(g.lo))
    first = np.cumsum(n) - n
    holds = np.concatenate([np.zeros(g.n_words, dtype=bool), n > 0])  # symbols with runs at or below them
    a = g.n_words
    for size in g.rounds:
        at = slice(a - g.n_words, a - g.n_words + size)
        holds[a:a + size] |= holds[g.left[at]] | holds[g.right[at]]
        a += size
    symbol, place = g.roots[holds[g.roots]], g.root_at[holds[g.roots]]
    starts, lengths, periods = [], [], []
    while len(symbol):
        i = symbol - g.n_words
        k = n[i]
        which = np.repeat(first[i], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        starts.append(start[which] - np.repeat(g.lo[i], k) + np.repeat(place, k))
        lengths.append(end[which] - start[which])
        periods.append(q[which])
        symbol, place = (np.concatenate([g.left[i], g.right[i]]),
                         np.concatenate([place, place + g.mid[i] - g.lo[i]]))
        below = holds[symbol]
        symbol, place = symbol[below], place[below]
    start, length, q = (np.concatenate(x) for x in (starts, lengths, periods))
    order = np.lexsort((-length, start, q))
    start, end, q = start[order], (start + length)[order], q[order]
    # within a period, what ends no later than an earlier start's run is a piece of that run
    lift = np.cumsum(np.concatenate([[0], q[1:] != q[:-1]])) * np.int64(len(ids) + 1)
    longest = np.maximum.accumulate(end + lift)
    whole = np.concatenate([[True], (end + lift)[1:] > longest[:-1]])
    start, length, q = start[whole], (end - start)[whole], q[whole]
    order = np.lexsort((q, start))
    start, length, q = start[order], length[order], q[order]
    at = np.repeat(start - (np.cumsum(length - q) - (length - q)), length - q) + np.arange((length - q).sum())
    if not (ids[at] == ids[at + np.repeat(q, length - q)]).all():
        raise ArithmeticError("two different stretches of words have one hash")
    return start, length, q


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words one after the other, each with one space behind it, and where each ends."""
    size = end - start + 1
    until = np.cumsum(size)
    out = np.append(data, np.uint8(32))[np.repeat(start - (until - size), size) + np.arange(until[-1] if len(until) else 0)]
    out[until - 1] = 32
    return out, until


OUT = pa.schema([("n_words", pa.int64()), ("starts", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                 ("periods", pa.list_(pa.int64())), ("collapsed", pa.string())])


def _block(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    n = len(offsets) - 1
    first, last = wh.word_spans(data, offsets)
    until = np.searchsorted(first, offsets)
    ids = np.unique(wh.span_hashes(wh.running_sums(data), first, last), return_inverse=True)[1]
    doc = np.repeat(np.arange(n), np.diff(until))
    start, length, q = all_runs(ids, doc)
    change = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(change, start + q, 1)
    np.add.at(change, start + length, -1)
    keep = np.cumsum(change[:-1]) == 0
    text, ends = _joined(data, first[keep], last[keep])
    # each document's bytes without the space behind its last word
    kept = np.concatenate([[0], np.cumsum(keep)])[until]
    ends = np.concatenate([[0], ends])[kept]
    raw = text.tobytes()
    collapsed = [raw[a:max(a, b - 1)].decode() for a, b in zip(ends[:-1], ends[1:])]
    of = doc[start] if len(start) else np.zeros(0, np.int64)
    bounds = pa.array(np.searchsorted(of, np.arange(n + 1)), pa.int32())
    lists = [pa.ListArray.from_arrays(bounds, pa.array(x, pa.int64())) for x in (start - until[of], length, q)]
    return [pa.array(np.diff(until), pa.int64()), *lists, pa.array(collapsed, pa.string())]


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = wh.bytes_of(batch.column(1))
        for a, b in wh.blocks(offsets, BLOCK_BYTES):
            part = offsets[a:b + 1]
            found = _block(data[part[0]:part[-1]], part - part[0])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *found],
                                             names=[batch.schema.names[0], *OUT.names])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, starts, lengths, periods, collapsed) for every row: its runs by start
    and period, in words from 0, and the text without the words that lie in a run behind its
    first period, joined by one space. Narrow; no row is left out."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    lists = ", ".join(f"{c} array<bigint>" for c in ("starts", "lengths", "periods"))
    return map_arrow(rows, _find, f"doc_id {id_type}, n_words bigint, {lists}, collapsed string")


def best_run(starts: Column, lengths: Column, periods: Column) -> Column:
    """The run (start, length, period) with the greatest length / period, compared exactly;
    of equal ones the smallest start, then period; null without runs."""
    runs = F.arrays_zip(starts.alias("start"), lengths.alias("length"), periods.alias("period"))

    def better(best, x):
        # lengths are below 2**31, so the products are exact; runs come by start and period
        return F.when(best["period"].isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best)
    nothing = F.struct(*[F.lit(None).cast("long").alias(c) for c in ("start", "length", "period")])
    return F.aggregate(runs, nothing, better)


def with_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in every tenth document, by a hash h of its id, the words from a on
    repeat those from a to a + p: a = g % n, p = 1 + (n - a) div (3 + g % 8), g = h div 10."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    d = docs.select("doc_id", text_of().alias("text"), F.floor(h / 10).cast("long").alias("g"), (h % 10 == 0).alias("hit"))

    def repeated(words):
        n = F.size(words)
        a = (F.col("g") % n).cast("int")
        p = (F.floor((n - a) / (3 + F.col("g") % 8)) + 1).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), times))
        return F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), tail), F.lit(1), n), " ")
    # the words are bound by a lambda, so that a text is split once
    words = F.array(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0))
    text = F.get(F.transform(words, lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit(""))), 0)
    return d.select("doc_id", F.when(F.col("hit"), text).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of all documents, every tenth with a repeated tail."""
    found = periodic_runs(with_tails(table(spark, sf_dir, "documents")))
    lines = F.transform(F.arrays_zip("starts", "lengths", "periods"), lambda r: F.concat(
        r["starts"].cast("string"), F.lit(","), r["lengths"].cast("string"), F.lit(","), r["periods"].cast("string"), F.lit("\n")))
    found = found.withColumn("best", best_run(F.col("starts"), F.col("lengths"), F.col("periods")))
    return found.select(
        "doc_id", F.size("starts").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
