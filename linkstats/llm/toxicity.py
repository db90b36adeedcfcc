"""Toxicity: a counterfactual-regularised logistic classifier over hashed word features.

Features of a text are its distinct lower-cased words and word beginnings of 3 to 8 bytes,
each with log(1 + count). From at most ``max_labelled`` labelled rows (those with the
smallest hash of the id) the ``max_features`` features that lean most to label 1 are chosen,
and a logistic model with an L1 penalty is fitted to them by accelerated proximal gradient.
The weight of that penalty is the one of ``L1_CHOICES`` with the least log loss over folds of
those rows, features chosen anew in each; held-out rows have no part in it.

Counterfactual part: every sentence of those labelled rows that holds an identity term is
written again with each of ``swaps`` other terms, and the squared change of its score is
penalised, so that neutral mentions of one group are not scored above those of another.

Only vectors over the chosen features reach the driver, for at most ``max_labelled`` rows and
``max_sentences`` swapped sentences; scoring is one pass over all texts with the non-zero
weights. lang, source and ids are never inputs of a score.

Defined results: a null text is empty, and an empty text scores the bias; null labels and
labels without a document are ignored; without labelled rows all scores are 0; repeated rows
score alike; other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkstats.llm import wordhash as wh
from linkstats.llm.common import map_arrow, table
from linkstats.session import materialize

MAX_LABELLED, MAX_FEATURES, MAX_SENTENCES, SWAPS = 8_000, 30_000, 20_000, 3
LENGTHS = (0, 3, 4, 5, 6, 7, 8)  # 0: the whole word
L1_CHOICES, FOLDS, FOLD_STEPS = (5e-5, 2e-4, 8e-4), 3, 150
L1, COUNTERFACTUAL, STEPS = 2e-4, 1.0, 400  # L1: where no fold has both classes
MIN_TEXTS, MIN_LEAN = 3, 3.0
BLOCK_BYTES = 1 << 19  # working arrays take about a hundred times that
# Identity terms, swapped for one another.
IDENTITY = ["african", "american", "arab", "asian", "atheist", "black", "blind", "buddhist", "catholic", "christian", "deaf",
            "disabled", "elderly", "european", "female", "gay", "heterosexual", "hindu", "homosexual", "immigrant", "jewish",
            "latino", "lesbian", "male", "mexican", "muslim", "old", "protestant", "queer", "refugee", "straight", "trans",
            "transgender", "white", "young"]
MENTION = "They live next to {} people."
_IDENTITY = re.compile(r"(?<![a-z])(" + "|".join(IDENTITY) + r")(?![a-z])", re.I)
_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")


def features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Yields (first row, last row + 1, row, feature, log(1 + count)), distinct by row and feature."""
    data, offsets = wh.bytes_of(column)
    for a, b in wh.blocks(offsets, BLOCK_BYTES):
        part = offsets[a:b + 1] - offsets[a]
        block = data[offsets[a]:offsets[b]]
        if not len(block):
            empty = np.zeros(0, dtype=np.int64)
            yield a, b, empty, empty.view(np.uint64), empty.astype(float)
            continue
        start, end = wh.word_spans(block, part)
        sums, row = wh.running_sums(block, wh._BYTE_LOWER), np.searchsorted(part, start, side="right") - 1
        rows, found = [], []
        for n in LENGTHS:
            long = end - start >= max(n, 1)
            stop = end[long] if n == 0 else start[long] + n
            found.append(wh.span_hashes(sums, start[long], stop) ^ np.uint64(n * 0x9E3779B97F4A7C15 % 2**64))
            rows.append(row[long])
        rows, found = np.concatenate(rows), np.concatenate(found)
        order = np.lexsort([found, rows])
        rows, found = rows[order], found[order]
        first = np.flatnonzero(np.concatenate([[True], (found[1:] != found[:-1]) | (rows[1:] != rows[:-1])])[:len(found)])
        yield a, b, rows[first] + a, found[first], np.log1p(np.diff(np.append(first, len(found))))


def swapped(text: str, swaps: int = SWAPS) -> list[tuple[str, str]]:
    """(sentence, the sentence with other identity terms) pairs of a text. A text that names
    no group gets a neutral mention of one beside one of its sentences (both chosen by its
    checksum), so that every text has pairs."""
    sentences = _SENTENCE.findall(text)
    named = [s for s in sentences if _IDENTITY.search(s)]
    if not named and sentences:
        pick = zlib.crc32(text.encode())
        named = [f"{sentences[pick % len(sentences)]} {MENTION.format(IDENTITY[pick % len(IDENTITY)])}"]
    out = []
    for sentence in named:
        for k in range(1, swaps + 1):
            out.append((sentence, _IDENTITY.sub(
                lambda m, k=k: IDENTITY[(IDENTITY.index(m[0].lower()) + k * (len(IDENTITY) // (swaps + 1))) % len(IDENTITY)],
                sentence)))
    return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, texts, texts labelled 1), summed by block."""
    for batch in batches:
        label = batch.column("label").to_numpy(zero_copy_only=False)
        for _, _, row, found, _ in features(batch.column("text")):
            u, at, n = np.unique(found, return_inverse=True, return_counts=True)
            ones = np.bincount(at, weights=label[row], minlength=len(u)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n), pa.array(ones)], names=["feature", "n", "ones"])


_VECTORS = pa.schema([("label", pa.int64()), ("sign", pa.int64()), ("pair", pa.int64()), ("at", pa.list_(pa.int32())),
                      ("value", pa.list_(pa.float64()))])


def _vectors(chosen: np.ndarray):
    """Rows (label, 0, null, at, value) for texts; with sign -1 and 1 for the two sentences of a swap."""
    def one(column: pa.Array, label: list, sign: list, pair: list):
        rows = [([], []) for _ in range(len(column))]
        for _, _, row, found, value in features(column):
            at = np.searchsorted(chosen, found)
            hit = np.flatnonzero(chosen[np.minimum(at, len(chosen) - 1)] == found)
            for r, i, v in zip(row[hit].tolist(), at[hit].tolist(), value[hit].tolist()):
                rows[r][0].append(i)
                rows[r][1].append(v)
        return pa.RecordBatch.from_arrays([pa.array(label, pa.int64()), pa.array(sign, pa.int64()), pa.array(pair, pa.int64()),
                                           pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                                           pa.array([r[1] for r in rows], pa.list_(pa.float64()))], schema=_VECTORS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0  # pairs are numbered over all batches of a partition
        for batch in batches:
            n = batch.num_rows
            yield one(batch.column("text"), batch.column("label").to_pylist(), [0] * n, [None] * n)
            pairs = [p for t in batch.column("text").to_pylist() for p in swapped(t)]
            if pairs:
                number = list(range(done, done + len(pairs)))
                done += len(pairs)
                yield one(pa.array([p[0] for p in pairs] + [p[1] for p in pairs]), [None] * 2 * len(pairs),
                          [-1] * len(pairs) + [1] * len(pairs), number * 2)
    return run


def fit_weights(vectors: list, n_features: int, l1: float = L1, counterfactual: float = COUNTERFACTUAL,
                steps: int = STEPS) -> tuple[np.ndarray, float]:
    """(weights, bias) minimising log loss + l1 * |w| + counterfactual * mean squared score change."""
    texts, swaps = [v for v in vectors if v["sign"] == 0], [v for v in vectors if v["sign"] != 0]

    def flat(rows):
        at = np.concatenate([np.asarray(v["at"], dtype=np.int64) for v in rows] or [np.zeros(0, np.int64)])
        value = np.concatenate([np.asarray(v["value"], dtype=float) * (v["sign"] or 1) for v in rows] or [np.zeros(0)])
        return at, value, np.repeat(np.arange(len(rows)), [len(v["at"]) for v in rows])

    at, value, row = flat(texts)
    y, n = np.array([v["label"] for v in texts], dtype=float), len(texts)
    s_at, s_value, s_row = flat(swaps)  # the two sentences of a swap follow each other, so their rows pair up
    s_row, pairs = s_row // 2, max(1, len(swaps) // 2)

    def forward(w):
        return np.bincount(row, weights=w[at] * value, minlength=n), np.bincount(s_row, weights=w[s_at] * s_value, minlength=pairs)

    def back(a, b):
        return (np.bincount(at, weights=a[row] * value, minlength=n_features),
                np.bincount(s_at, weights=b[s_row] * s_value, minlength=n_features))

    x = np.random.default_rng(0).normal(size=n_features)
    for _ in range(30):  # the largest curvature, by power iteration
        a, b = forward(x)
        a, b = back(a, b)
        x = 0.25 * a / n + 2 * counterfactual * b / pairs
        curve = float(np.linalg.norm(x))
        x = x / curve if curve else x
    curve = (curve + 0.25) * 1.05
    rate = min(max(y.mean(), 0.5 / n), 1 - 0.5 / n)
    w = ahead = np.zeros(n_features)
    bias = bias_ahead = float(np.log(rate / (1 - rate)))
    t = 1.0
    for _ in range(steps):
        a, b = forward(ahead)
        g = 1 / (1 + np.exp(-(a + bias_ahead))) - y
        ga, gb = back(g / n, b / pairs)
        moved = ahead - (ga + 2 * counterfactual * gb) / curve
        new = np.sign(moved) * np.maximum(np.abs(moved) - l1 / curve, 0)
        new_bias = bias_ahead - g.mean() / curve
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, bias_ahead = new + (t - 1) / t_new * (new - w), new_bias + (t - 1) / t_new * (new_bias - bias)
        w, bias, t = new, new_bias, t_new
    return w, float(bias)


def choose_l1(vectors: list, n_features: int, choices=L1_CHOICES, counterfactual: float = COUNTERFACTUAL) -> float:
    """The penalty weight with the least log loss on left-out folds of the labelled rows. Rows of
    equal features share a fold, and the features of a fold are those that lean to label 1
    in its other rows."""
    texts, swaps = [v for v in vectors if v["sign"] == 0], [v for v in vectors if v["sign"] != 0]
    fold = np.array([zlib.crc32(np.asarray(v["at"], dtype=np.int32).tobytes()) % FOLDS for v in texts])
    label = np.array([v["label"] for v in texts], dtype=float)
    loss, used = dict.fromkeys(sorted(choices, reverse=True), 0.0), False
    for f in range(FOLDS):
        own, rest = np.flatnonzero(fold == f), np.flatnonzero(fold != f)
        rate = label[rest].mean() if len(rest) else 0.0
        if not len(own) or not 0 < rate < 1:
            continue
        used = True
        at = np.concatenate([np.asarray(texts[i]["at"], dtype=np.int64) for i in rest])
        n = np.bincount(at, minlength=n_features)
        ones = np.bincount(at, weights=np.repeat(label[rest], [len(texts[i]["at"]) for i in rest]), minlength=n_features)
        kept = (n >= MIN_TEXTS) & (ones - n * rate > MIN_LEAN * np.sqrt(n * rate * (1 - rate) + 1e-9))

        def narrowed(v):
            a, x = np.asarray(v["at"], dtype=np.int64), np.asarray(v["value"], dtype=float)
            return {"label": v["label"], "sign": v["sign"], "at": a[kept[a]], "value": x[kept[a]]}
        train, left = [narrowed(texts[i]) for i in rest] + [narrowed(v) for v in swaps], [narrowed(texts[i]) for i in own]
        for l1 in loss:
            w, bias = fit_weights(train, n_features, l1, counterfactual, FOLD_STEPS)
            z = bias + np.array([w[v["at"]] @ v["value"] for v in left])
            loss[l1] += float(np.logaddexp(0, np.where(label[own] == 1, -z, z)).sum())
    return min(loss, key=loss.get) if used else L1


class ToxicityModel:
    """Non-zero weights by feature hash, and the bias; ``bias`` is None without labels."""

    def __init__(self, feature: np.ndarray, weight: np.ndarray, bias: float | None):
        order = np.argsort(feature)
        self.feature, self.weight, self.bias = feature[order], weight[order], bias

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.bias is None:
            return np.zeros(len(column))
        out = np.full(len(column), self.bias)
        if len(self.feature):
            for _, _, row, found, value in features(column):
                at = np.minimum(np.searchsorted(self.feature, found), len(self.feature) - 1)
                hit = self.feature[at] == found
                out += np.bincount(row[hit], weights=value[hit] * self.weight[at[hit]], minlength=len(column))
        return 1 / (1 + np.exp(-out))


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_labelled: int = MAX_LABELLED, max_features: int = MAX_FEATURES, counterfactual: float = COUNTERFACTUAL,
        l1: float | None = None) -> ToxicityModel:
    """Fits on labelled rows that are not held out; ``l1`` is chosen on them unless given."""
    chosen = (labels.where(~held_out(id_col) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("long").alias("label"))
              .orderBy(F.xxhash64("__id"), "__id").limit(max_labelled))
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # The broadcast side has max_labelled rows of two numbers at most.
    # Of rows that share an id one is taken, so the sample has no more rows than ids.
    sample = (texts.join(F.broadcast(chosen), "__id").groupBy("__id").agg(F.min("text").alias("text"), F.max("label").alias("label")))
    sample = materialize(sample.select("text", "label"), "toxicity_sample")
    n, ones = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not n:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), None)
    rate = ones / n
    counts = (map_arrow(sample.select("text", "label"), _counts, "feature long, n long, ones long")
              .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones")))
    lean = (F.col("ones") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate) + 1e-9)
    best = (counts.where(F.col("n") >= MIN_TEXTS).withColumn("lean", lean).where(F.col("lean") > MIN_LEAN)
            .orderBy(F.desc("lean"), "feature").limit(max_features).select("feature").collect())
    names = np.sort(np.array([r[0] for r in best], dtype=np.int64).view(np.uint64))
    if not len(names):
        return ToxicityModel(names, np.zeros(0), float(np.log((ones + 0.5) / (n - ones + 0.5))))
    vectors = map_arrow(sample.select("text", "label"), _vectors(names),
                        "label long, sign long, pair long, at array<int>, value array<double>")
    vectors = materialize(vectors.withColumn("part", F.spark_partition_id()), "toxicity_vectors")
    rows = vectors.where("sign = 0").collect()
    pairs = vectors.where("sign <> 0 and size(at) > 0").select("part", "pair").distinct().orderBy(F.xxhash64("part", "pair")).limit(MAX_SENTENCES)
    rows += (vectors.where("sign <> 0").join(F.broadcast(pairs), ["part", "pair"])
             .dropDuplicates(["part", "pair", "sign"]).orderBy("part", "pair", "sign").collect())
    l1 = choose_l1(rows, len(names), counterfactual=counterfactual) if l1 is None else l1
    weight, bias = fit_weights(rows, len(names), l1, counterfactual)
    used = weight != 0
    return ToxicityModel(names[used], weight[used], bias)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s),
                                              pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return map_arrow(rows, run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with their columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column(text_col)) < 0.5))
    return map_arrow(docs, run, docs.schema)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
