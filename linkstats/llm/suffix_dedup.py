"""Removal of long repeated substrings with a logarithmic family of sparse suffix arrays.

Bytes covered by a ``LENGTH``-byte string that starts in more than one place go. A batch's
suffix array holds the suffixes at its anchors (see suffix_anchors): rows sorted by the
fingerprint of their first ``GRAM`` bytes (``core``), then by that of the whole run of windows
that share the anchor (``run``), equal runs counted as one class. A new batch is merge-scanned
against every level of the index: a core found on both sides, or twice in the batch, is a
possible long match. Then it becomes a level of its own, and as long as two levels have the
same rank they merge, bucket by bucket and without a shuffle, into one of the next rank, so
there are at most log2(batches) levels and each row is rewritten that often. Levels are
bucketed by core and run together: a core that a third of all documents hold, each with
another run, spreads over all buckets.

An index with a path of its own is kept, with the texts of its batches beside the levels, so a
later batch, in any session, also finds the passages that only older texts share in part.

A class with two or more members repeats as a whole. Classes that share a core but not the
run differ somewhere in their context: their representatives alone are cut into stretches of
``STEPS`` windows, with the bytes common to a stretch as the new core, and compared again; the
last step compares single windows. So the result is exact up to 64-bit collisions, no pairs
are made, and a passage held by a third of all documents is one class after the partial
aggregates. Windows become byte spans where they are found, before they meet by document.

Defined results: a null text is empty; texts are UTF-8 bytes; matches never cross documents
and may lie in one document; rows that repeat both doc_id and text count as two places;
other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkstats.llm import suffix_anchors as sa
from linkstats.llm import wordhash as wh
from linkstats.llm.common import map_arrow, release, shuffle_width, table, text_of
from linkstats.session import checked_broadcast, ensure_checkpoint_dir, materialize, path_exists, scratch_tables

LENGTH, GRAM, STEPS, BATCHES = sa.LENGTH, sa.GRAM, (34, 1), 2
_ROWS = pa.schema([("core", pa.int64()), ("run", pa.int64()), ("rid", pa.int64()), ("pos", pa.int64())])
ROWS = "core long, run long, rid long, pos long"
MANIFEST = "version bigint, buckets int, level int, name string"


def pack(first: np.ndarray, last: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """First window, and last window and anchor relative to it, in one number."""
    return (first.astype(np.int64) << 16) | ((last - first) << 8) | (anchor - first)


def unpack(pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = pos >> 16
    return first, first + ((pos >> 8) & 255), first + (pos & 255)


def _rows(core: np.ndarray, run: np.ndarray, rid: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(core.view(np.int64)), pa.array(run.view(np.int64)), pa.array(rid), pa.array(pos)], schema=_ROWS)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchored runs of every text."""
    for batch in batches:
        rid = batch.column("rid").to_numpy()
        data, offsets = wh.bytes_of(batch.column("text"))
        for a, b in wh.blocks(offsets, sa.BLOCK_BYTES):
            part = offsets[a:b + 1] - offsets[a]
            row, first, last, anchor, sums = sa.runs_of(data[offsets[a]:offsets[b]], part)
            if len(row):
                start = part[row]
                yield _rows(wh.span_hashes(sums, anchor, anchor + GRAM), wh.span_hashes(sums, first, last + LENGTH),
                            rid[a + row], pack(first - start, last - start, anchor - start))


def _stretches(step: int):
    """The given runs of every text, cut where the distance to the anchor passes a multiple
    of ``step``; the core of a stretch is what all its windows would share if it were whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = batch.column("rid").to_numpy()
            data, offsets = wh.bytes_of(batch.column("text"))
            places = batch.column("places")
            at, pos = np.asarray(places.offsets) - places.offsets[0].as_py(), np.asarray(places.flatten())
            for x, y in wh.blocks(offsets, sa.BLOCK_BYTES):
                sums = wh.running_sums(data[offsets[x]:offsets[y]])
                row = np.repeat(np.arange(x, y), np.diff(at[x:y + 1]))
                first, last, anchor = unpack(pos[at[x]:at[y]])
                low = (anchor - last) // step
                count = (anchor - first) // step - low + 1
                k = np.repeat(np.arange(len(row)), count)
                edge = anchor[k] - step * (low[k] + np.arange(len(k)) - np.repeat(np.cumsum(count) - count, count))
                lo, hi = np.maximum(first[k], edge - step + 1), np.minimum(last[k], edge)
                start = (offsets[row] - offsets[x])[k]
                core = wh.span_hashes(sums, start + edge, start + edge - step + 1 + LENGTH)
                whole = wh.span_hashes(sums, start + lo, start + hi + LENGTH)
                yield _rows(core, whole, rid[row][k], pack(lo, hi, anchor[k]))
    return run


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes of each batch of rows, so that a hot class leaves a task as few rows."""
    for batch in batches:
        core, run, rid, pos = (batch.column(c).to_numpy() for c in ("core", "run", "rid", "pos"))
        order = np.lexsort([run, core])
        core, run = core[order], run[order]
        first = np.flatnonzero(np.concatenate([[True], (core[1:] != core[:-1]) | (run[1:] != run[:-1])])[:len(core)])
        n = np.diff(np.append(first, len(core)))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (core[first], run[first], n, rid[order][first], pos[order][first])],
                                         names=["core", "run", "n", "rid", "pos"])


def _classes(rows: DataFrame) -> DataFrame:
    """(core, run, n, rid, pos): equal runs as one class with a representative place."""
    return rows.groupBy("core", "run").agg(F.sum("n").alias("n"), F.first("rid").alias("rid"), F.first("pos").alias("pos"))


def _marked(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """(rid, span): the windows of the rows whose class, named by the columns of ``repeated``,
    is one of those. The classes grow with the corpus: no broadcast."""
    return map_arrow(rows.hint("merge").join(repeated, repeated.columns).select("rid", "pos"), _spans, "rid long, span long")


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


class SuffixIndex:
    """Levels of rank 0, 1, 2, ...: tables bucketed and sorted by (core, run).

    With a ``path`` the index is kept there: ``commit`` appends its levels, its bucket number and
    its text tables to a manifest, and an index opened at the path goes on from the last committed
    version (another bucket number is refused). A batch whose job died before the commit is not in
    it and can be added again; one that is added twice counts as copies. Without a path the index
    lives as long as the object.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark, self.kept, self.version = spark, path is not None, 0
        self.path = (path or f"{ensure_checkpoint_dir(spark)}/tables/suffix-index-{uuid.uuid4().hex}").rstrip("/")
        self.levels: dict[int, str] = {}
        self.batches: list[str] = []
        self._stale: list[str] = []
        stored = None
        if self.kept and path_exists(spark, f"{self.path}/manifest"):
            rows = spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")
            self.version = rows.agg(F.max("version")).first()[0]
            for row in rows.where(F.col("version") == self.version).collect():  # one row for each level and batch
                stored = row.buckets
                if row.level is None:
                    self.batches.append(row.name)
                else:
                    self.levels[row.level] = row.name
        self.buckets = stored or buckets or shuffle_width(spark)
        if buckets not in (None, self.buckets):
            raise ValueError(f"the index at {self.path} has {self.buckets} buckets, not {buckets}")

    def _level(self, name: str) -> DataFrame:
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (core BIGINT, run BIGINT, n BIGINT, rid BIGINT, pos BIGINT) USING parquet "
                       f"CLUSTERED BY (core, run) SORTED BY (core, run) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{name}'")
        return self.spark.table(name)

    def _write(self, classes: DataFrame) -> str:
        name = f"suffix_level_{uuid.uuid4().hex}"
        (classes.select("core", "run", "n", "rid", "pos")
         .write.format("parquet").bucketBy(self.buckets, "core", "run").sortBy("core", "run")
         .option("path", f"{self.path}/{name}").saveAsTable(name))
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        release(self.spark, f"{self.path}/{name}")

    def _merge(self, older: str, newer: str) -> str:
        """Writes two levels as one, bucket by bucket. A join: Spark 4.1 gives the union of two
        bucketed tables out as bucketed but sets their partitions side by side, so that a class
        held by both would come out twice."""
        both = self._level(older).alias("a").hint("merge").join(self._level(newer).alias("b"), ["core", "run"], "full")
        n = F.coalesce("a.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))
        return self._write(both.select("core", "run", n.alias("n"), *(F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in ("rid", "pos"))))

    def add(self, rows: DataFrame) -> DataFrame:
        """Adds a batch; returns the cores (core) that repeat in it or in an older level."""
        rows = map_arrow(rows, _combine, "core long, run long, n long, rid long, pos long")
        name = self._write(_classes(rows.repartition(self.buckets, "core", "run")))
        cores = self._level(name).groupBy("core").agg((F.sum("n") > 1).alias("repeats"))
        for older in self.levels.values():
            known = self._level(older).select("core").distinct().withColumn("known", F.lit(True))
            cores = (cores.hint("merge").join(known, "core", "left")
                     .select("core", (F.col("repeats") | F.col("known").isNotNull()).alias("repeats")))
        matches = materialize(cores.where("repeats").select("core"), "suffix_matches")
        rank = 0
        while rank in self.levels:
            older = self.levels.pop(rank)
            merged = self._merge(older, name)
            self._stale += [older, name]
            if not self.kept:
                self._forget()
            name, rank = merged, rank + 1
        self.levels[rank] = name
        return matches

    def add_texts(self, texts: DataFrame) -> None:
        """Keeps the texts (rid, text) of a batch."""
        name = f"texts_{uuid.uuid4().hex}"
        texts.write.parquet(f"{self.path}/{name}")
        self.batches.append(name)

    def texts(self) -> DataFrame:
        return union([self.spark.read.parquet(f"{self.path}/{b}") for b in self.batches])

    def classes(self) -> DataFrame:
        """The levels as one, written if there are several; the next commit or merge drops it."""
        name, *older = (self.levels[rank] for rank in sorted(self.levels))
        for level in older:
            name = self._merge(level, name)
            self._stale.append(name)
        return self._level(name)

    def commit(self) -> None:
        """Makes the batches added since the last commit part of the kept index."""
        entries = [*self.levels.items(), *((None, b) for b in self.batches)]
        rows = [(self.version + 1, self.buckets, level, name) for level, name in entries]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        self.version += 1
        self._forget()

    def _forget(self) -> None:
        for name in self._stale:
            self._drop(name)
        self._stale = []

    def close(self) -> None:
        """Deletes an index that is not kept."""
        if not self.kept:
            self._stale += self.levels.values()
            self._forget()
            release(self.spark, self.path)


def _open(classes: DataFrame) -> DataFrame:
    """(rid, places): the representatives of classes (core, rid, pos) that share their core with
    another."""
    several = classes.groupBy("core").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1").select("core")
    return classes.join(several, "core").groupBy("rid").agg(F.collect_list("pos").alias("places"))


SPAN_BITS = 31  # a text is shorter than 2 GiB


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of each batch of (rid, pos) as byte spans, merged by text: (rid, span),
    where span packs start and length."""
    for batch in batches:
        rid, (first, last, _) = batch.column("rid").to_numpy(), unpack(batch.column("pos").to_numpy())
        ids, row = np.unique(rid, return_inverse=True)
        base = row.astype(np.int64) << (SPAN_BITS + 1)  # texts end to end, far apart
        order = np.argsort(base + first, kind="stable")
        start, end = (base + first)[order], (base + last + LENGTH)[order]
        reach = np.maximum.accumulate(end)
        at = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]])[:len(start)])
        length = reach[np.append(at[1:], len(start)) - 1] - start[at] if len(at) else at
        inner = start[at] & ((1 << (SPAN_BITS + 1)) - 1)
        yield pa.RecordBatch.from_arrays([pa.array(ids[start[at] >> (SPAN_BITS + 1)]), pa.array((inner << SPAN_BITS) | length)], names=["rid", "span"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of each text, which may overlap, to the removed byte spans."""
    for batch in batches:
        starts, ends = [], []
        for spans in batch.column("spans"):
            spans = np.sort(np.asarray(spans.values))
            first = spans >> SPAN_BITS
            reach = np.maximum.accumulate(first + (spans & ((1 << SPAN_BITS) - 1)))
            new = np.concatenate([[True], first[1:] > reach[:-1]])
            starts.append(first[new])
            ends.append(reach[np.append(np.flatnonzero(new)[1:], len(first)) - 1])
        yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64()))],
                                         names=["rid", "starts", "ends"])


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text")).withColumn("rid", F.xxhash64("doc_id", "text"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES,
                   index: SuffixIndex | None = None) -> DataFrame:
    """(rid, starts, ends): the byte spans of ``docs`` to remove, those found in the older batches
    of ``index`` included; rid is the xxhash64 of (doc_id, text).

    ``docs`` is added to ``index`` (a new one by default) in ``batches`` batches and committed
    there when the result is written. Spans of older documents are not returned.
    """
    spark, kept = docs.sparkSession, index is not None and index.kept
    own = index is None
    index = index or SuffixIndex(spark)
    with scratch_tables(spark) as scope:
        added = texts = _texts(docs, id_col, text_col).where(F.octet_length("text") >= LENGTH).select("rid", "text")
        with scratch_tables(spark) as first:  # a step's tables go before the next one, but for its marks and what it leaves open
            rows = materialize(map_arrow(texts, _suffixes, ROWS), "suffix_rows")
            found = [index.add(rows.where(F.pmod("rid", F.lit(batches)) == i)) for i in range(batches)]
            if kept:
                index.add_texts(texts)
                texts = index.texts()
            classes, matches = index.classes(), union(found).distinct()
            whole = materialize(classes.where("n > 1").select("core", "run"), "suffix_whole")
            shared = materialize(classes.select("core", "rid", "pos").hint("merge").join(matches, "core", "left_semi"), "suffix_shared")
            if own:
                index.close()
            open_ = first.keep(_open(shared), "suffix_open")
            marks = [first.keep(_marked(rows, whole), "suffix_marks")]
        for step in STEPS:
            with scratch_tables(spark) as stage:
                picked = texts.join(checked_broadcast(open_), "rid").select("rid", "text", "places")
                cut = map_arrow(picked, _stretches(step), ROWS)
                if step > 1:  # a place is listed twice only if its whole row of the table repeats
                    cut = materialize(cut, "suffix_stretches")
                    classes = materialize(_classes(cut.withColumn("n", F.lit(1))), "suffix_classes")
                    open_ = stage.keep(_open(classes), "suffix_open")
                    repeated = classes.where("n > 1").select("core", "run")
                else:  # a window is its own core, and none stays open
                    cut = materialize(cut.select("run", "rid", "pos"), "suffix_windows")
                    repeated = cut.groupBy("run").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("run")
                    repeated = materialize(repeated, "suffix_repeated")
                marks.append(stage.keep(_marked(cut, repeated), "suffix_marks"))
        spans = union(marks).groupBy("rid").agg(F.collect_set("span").alias("spans"))
        if not own:
            spans = spans.join(added.select("rid").distinct(), "rid", "left_semi")
        out = scope.keep(map_arrow(spans, _merge, "rid long, starts array<long>, ends array<long>"), "suffix_spans")
        if kept:
            index.commit()
    return out


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                     ("kept", pa.string()), ("kept_sha256", pa.string())])


def _cut(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "starts", "ends"))):
                raw, starts, ends = text.encode(), starts or [], ends or []
                kept = b"".join(raw[a:b] for a, b in zip([0, *ends], [*starts, len(raw)]))
                out.append((doc_id, len(raw), len(raw) - len(kept), len(starts), kept.decode(errors="replace") if with_text else None,
                            hashlib.sha256(kept).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _RESULT)], schema=_RESULT)
    return run


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES, with_text: bool = True,
                index: SuffixIndex | None = None) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (bytes that are cut
    inside a character are replaced), kept_sha256 (of the exact bytes)."""
    spans = repeated_spans(docs, id_col, text_col, batches, index)
    joined = _texts(docs, id_col, text_col).join(checked_broadcast(spans), "rid", "left").select("doc_id", "text", "starts", "ends")
    return map_arrow(joined, _cut(with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept string, kept_sha256 string")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept")
