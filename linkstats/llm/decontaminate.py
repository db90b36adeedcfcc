"""Benchmark decontamination by spaced-seed hashing.

Words are lower-cased runs of letters, digits and non-ASCII characters. Every place of
every benchmark item and of every document is hashed under a few fixed masks that look at six
words and ignore those between them, so that substituted words leave some mask untouched. The
masks are computed, not drawn: every window of 13 to 25 words of which 80 % match, whichever
they are, is hit by one of them. A longer overlap can be halved until it is such a window, as
one half always keeps the share. Test and training hashes are joined, and around each hit the two
texts are laid side by side: of the aligned words the longest segment that begins and ends on
a match and of which at least 80 % match is an overlap when it has ``MIN_WORDS`` words, or the
whole item where that is shorter.

The test side is joined from memory in blocks of at most ``block_words`` words, a stated bound
whatever the benchmark's size; each block is matched against all documents, which are never
shuffled. Items of fewer than ``MIN_WORDS`` words are hashed whole, with as many places ignored
as may differ, and match where the whole item lies in the document and 80 % of its words, end
words or others, match. Items of fewer than ``min_item`` words (``MIN_ITEM`` unless given) are too common
to be evidence and match nothing; with ``min_item=1`` every item counts, and one of fewer than
five words matches where it lies in the document word for word.

Defined results: null or empty texts and items match nothing; repeated rows give repeated
results; repeated items are matched alike; other columns are ignored, whatever their names;
an empty table gives no rows, an empty benchmark marks nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkstats.llm import wordhash as wh
from linkstats.llm.common import map_arrow, table

# The masks; 1 marks a word that counts.
MASKS = ("1110111", "11100001011", "11011001001")
MIN_WORDS, MIN_ITEM = 13, 5
BLOCK_WORDS = 500_000
_FILTER_BITS = 22
_COMPARED_WORDS = 1 << 18
_LOWERED_ROWS = 500
_SCALE = np.random.default_rng(77).integers(1, 1 << 62, 64, dtype=np.uint64) * 2 + 1


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the words that count under ``mask``, for every place that it fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    acc = np.full(n, hash_of_mask(mask), dtype=np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            acc += words[i:n + i] * _SCALE[i]
    return wh.mix(acc)


def hash_of_mask(mask: str) -> int:
    return int(mask.replace("0", "2"))


def masks_of(n_words: int) -> tuple[str, ...]:
    """The masks for an item of so many words."""
    if n_words >= MIN_WORDS:
        return MASKS
    return _whole_masks(n_words) if n_words else ()


@lru_cache
def _whole_masks(n_words: int) -> tuple[str, ...]:
    """Masks over a whole short item: of its pieces, each ignores as many as words may differ."""
    differ = n_words // 5
    pieces = [set(p.tolist()) for p in np.array_split(np.arange(n_words), differ + 2)]
    return tuple("".join("0" if i in set().union(*out) else "1" for i in range(n_words))
                 for out in combinations(pieces, differ))


class Seeds:
    """The seeds of one block of items, sorted by hash."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.items, self.size = items, np.array([len(w) for _, w in items], dtype=np.int64)
        self.words = np.concatenate([w for _, w in items] or [np.zeros(0, np.uint64)])
        self.first = np.cumsum(self.size) - self.size
        self.masks = sorted({m for _, w in items for m in masks_of(len(w))})
        found = [(seed_hashes(w, m), k) for k, (_, w) in enumerate(items) for m in masks_of(len(w))]
        self.hash = np.concatenate([h for h, _ in found] or [np.zeros(0, np.uint64)])
        self.item = np.concatenate([np.full(len(h), k) for h, k in found] or [np.zeros(0, np.int64)]).astype(np.int32)
        self.at = np.concatenate([np.arange(len(h)) for h, _ in found] or [np.zeros(0, np.int64)]).astype(np.int32)
        order = np.argsort(self.hash, kind="stable")
        self.hash, self.item, self.at = self.hash[order], self.item[order], self.at[order]

    def filter(self) -> np.ndarray:
        bits = np.zeros(1 << _FILTER_BITS, dtype=bool)
        bits[self.hash >> np.uint64(64 - _FILTER_BITS)] = True
        return bits

    def overlaps(self, words: np.ndarray, offsets: np.ndarray, bits: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, item number, overlap in words) of rows laid end to end."""
        place, seed = [], []
        for m in self.masks:
            h = seed_hashes(words, m)
            p = np.flatnonzero(bits[h >> np.uint64(64 - _FILTER_BITS)])
            lo, hi = np.searchsorted(self.hash, h[p]), np.searchsorted(self.hash, h[p], side="right")
            hit = hi > lo
            p, lo, n = p[hit], lo[hit], (hi - lo)[hit]
            place.append(np.repeat(p, n))
            seed.append(np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        if not place:
            return []
        place, seed = np.concatenate(place), np.concatenate(seed)
        row = np.searchsorted(offsets, place, side="right") - 1
        diagonals = np.unique(np.stack([row, self.item[seed], place - self.at[seed]], axis=1), axis=0)
        row, k, d = diagonals.T
        lo, hi = np.maximum(d, offsets[row]), np.minimum(d + self.size[k], offsets[row + 1])
        least = np.minimum(MIN_WORDS, self.size[k])
        long = hi - lo >= least
        row, k, d, lo, hi, least = (x[long] for x in (row, k, d, lo, hi, least))
        out, ends = [], np.cumsum(hi - lo)
        a = 0
        while a < len(row):  # the words of many pairs are compared at once
            done = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, done + _COMPARED_WORDS, side="right")))
            n = (hi - lo)[a:b]
            at = np.cumsum(n) - n
            here = np.repeat(lo[a:b] - at, n) + np.arange(n.sum())
            equal = words[here] == self.words[here + np.repeat((self.first[k] - d)[a:b], n)]
            enough = 5 * np.add.reduceat(equal, at, dtype=np.int64) >= 4 * least[a:b]
            for i in np.flatnonzero(enough).tolist():
                item = int(k[a + i])
                size = int(self.size[item])
                found = size if size < MIN_WORDS else best_overlap(equal[at[i]:at[i] + n[i]], MIN_WORDS)
                if found:
                    out.append((int(row[a + i]), item, found))
            a = b
        return out


def best_overlap(equal: np.ndarray, least: int) -> int:
    """Length of the longest segment that begins and ends on a match and has at least four
    matches in five words, if it has ``least`` words, else 0."""
    at = np.flatnonzero(equal)
    if 5 * len(at) < 4 * least:
        return 0
    # With 1 for a match and -4 for a mismatch, a segment qualifies if its sum is not below 0.
    before = 5 * np.arange(len(at)) - 4 * at
    best_end = np.maximum.accumulate(before[::-1] + 1)[::-1]
    last = np.searchsorted(-best_end, -before, side="right") - 1
    longest = int((at[last] - at).max()) + 1
    return longest if longest >= least else 0


def seed_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                block_words: int = BLOCK_WORDS, min_item: int = MIN_ITEM) -> Iterator[Seeds]:
    """The benchmark's items of ``min_item`` words or more as blocks of seeds, read row by row."""
    items, n = [], 0
    for row in benchmark.select(F.col(id_col).cast("bigint"), F.coalesce(F.col(text_col), F.lit(""))).orderBy(id_col).toLocalIterator():
        _, _, words, _ = next(wh.plain_word_blocks(pc.utf8_lower(pa.array([row[1]]))))
        if len(words) < max(min_item, 1):
            continue
        items.append((row[0], words))
        n += len(words)
        if n >= block_words:
            yield Seeds(items)
            items, n = [], 0
    if items:
        yield Seeds(items)


def _hits(seeds: Seeds, column: pa.Array, bits: np.ndarray) -> dict[int, dict[int, int]]:
    """row -> item number -> longest overlap"""
    out: dict[int, dict[int, int]] = {}
    for start in range(0, len(column), _LOWERED_ROWS):  # a copy of some rows, not of the whole batch
        for a, _, words, offsets in wh.plain_word_blocks(pc.utf8_lower(column.slice(start, _LOWERED_ROWS))):
            for r, k, n in seeds.overlaps(words, offsets, bits):
                own = out.setdefault(start + a + r, {})
                own[k] = max(n, own.get(k, 0))
    return out


_SCHEMA = "doc_id long, text string, item_ids array<long>, longest long"


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             block_words: int = BLOCK_WORDS, min_item: int = MIN_ITEM) -> DataFrame:
    """One row per document: doc_id, contaminated, item_ids (sorted), longest (overlap in words).
    The rows pass the blocks of the benchmark one after the other, each adding what it finds,
    so a row is read once and stays one row however many blocks there are."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.array().cast("array<bigint>").alias("item_ids"), F.lit(0).cast("bigint").alias("longest"))
    for seeds in seed_blocks(benchmark, block_words=block_words, min_item=min_item):
        def run(batches: Iterator[pa.RecordBatch], seeds: Seeds = seeds) -> Iterator[pa.RecordBatch]:
            bits = seeds.filter()
            for batch in batches:
                found = _hits(seeds, batch.column("text"), bits)
                ids, longest = batch.column("item_ids").to_pylist(), batch.column("longest").to_pylist()
                for i, own in found.items():
                    ids[i] = sorted({*ids[i], *(seeds.items[k][0] for k in own if seeds.items[k][0] is not None)})
                    longest[i] = max(longest[i], *own.values())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text"), pa.array(ids, pa.list_(pa.int64())), pa.array(longest, pa.int64())],
                    names=["doc_id", "text", "item_ids", "longest"])
        rows = map_arrow(rows, run, _SCHEMA)
    return rows.select("doc_id", (F.col("longest") > 0).alias("contaminated"), "item_ids", "longest")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", block_words: int = BLOCK_WORDS,
                      min_item: int = MIN_ITEM) -> DataFrame:
    """The rows of ``docs`` that overlap with no item, with their columns."""
    for seeds in seed_blocks(benchmark, block_words=block_words, min_item=min_item):
        def run(batches: Iterator[pa.RecordBatch], seeds: Seeds = seeds) -> Iterator[pa.RecordBatch]:
            bits = seeds.filter()
            for batch in batches:
                found = _hits(seeds, batch.column(text_col), bits)
                yield batch.filter(pa.array([i not in found for i in range(batch.num_rows)], pa.bool_()))
        docs = map_arrow(docs, run, docs.schema)
    return docs


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
