"""Incremental link statistics with Structured Streaming.

New pages arrive as files; each micro-batch is parsed with the same narrow page-table
expressions as the batch jobs, exploded into link facts, and folded into the running
(sf, uri) and uri counts kept in Spark's state store (partial aggregation happens before
the state shuffle). The spot-weighted counts need the dictionary of the whole corpus
and stay batch jobs; link counts are exact on an append-only stream.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linkstats import session as sess
from linkstats.operators import counts as ct
from linkstats.operators import extract as ex
from linkstats.sources import pages as pg


def page_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame of pages (page_id, url, html) from the Parquet files that
    arrive in ``folder`` (or from one file)."""
    schema = "page_id long, url string, html string"
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder)


def streaming_link_facts(pages: DataFrame) -> DataFrame:
    """(wid, sf, uri) of every new page; narrow, no state."""
    return ex.link_facts(pg.article_rows(pg.page_table(pages, with_paragraphs=False)))


def streaming_pair_link_counts(pages: DataFrame) -> DataFrame:
    """Running (sf, uri, n) over all pages seen so far."""
    return ct.pair_counts(streaming_link_facts(pages), weight="links")


def streaming_uri_link_counts(pages: DataFrame) -> DataFrame:
    """Running (uri, n) over all pages seen so far."""
    return ct.uri_counts(streaming_link_facts(pages), weight="links")


def start(counts: DataFrame, state: str, out: str, available_now: bool = True) -> StreamingQuery:
    """Start a counts stream that writes what each micro-batch changed.

    ``state`` holds the progress and the running counts, ``out`` the changes, one folder
    ``epoch=N`` for each micro-batch; both belong on shared storage. A query started again
    with the same two folders goes on where it stopped and reads new files only; a batch that
    is run again after a failure replaces its own folder. ``current`` reads the counts.
    """
    def write_changes(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/epoch={epoch}")

    w = counts.writeStream.outputMode("update").option("checkpointLocation", state).foreachBatch(write_changes)
    return (w.trigger(availableNow=True) if available_now else w).start()


def current(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """The counts as they stand: the last change of every key."""
    changes = spark.read.parquet(out)
    return changes.groupBy(*keys).agg(F.max_by("n", "epoch").cast("long").alias("n"))


def compact(spark: SparkSession, out: str, keys: list[str]) -> int:
    """Folds all change folders but the newest into one; returns how many are gone.

    The newest may be replaced by a batch that runs again, so it is left alone. The folded rows
    are written aside, moved into the last folder they cover, and only then are the older ones
    deleted: a key's last change keeps its value under that later epoch, so ``current`` is right
    after every step, and a call that died is made good by the next. One call at a time; a
    reader that has listed the folders before may have to read again.
    """
    out = out.rstrip("/")
    names = sess.child_names(spark, out)
    for left in (n for n in names if n.startswith("_compact-")):
        sess.delete_path(spark, f"{out}/{left}")
    epochs = sorted(int(n.removeprefix("epoch=")) for n in names if n.startswith("epoch="))
    if len(epochs) < 3:
        return 0
    last, aside = epochs[-2], f"{out}/_compact-{uuid.uuid4().hex}"
    changes = spark.read.parquet(out).where(F.col("epoch") <= last)
    changes.groupBy(*keys).agg(F.max_by("n", "epoch").cast("long").alias("n")).write.parquet(aside)
    for part in sess.child_names(spark, aside):
        if part.endswith(".parquet"):
            sess.move_path(spark, f"{aside}/{part}", f"{out}/epoch={last}/{part}")
    for epoch in epochs[:-2]:
        sess.delete_path(spark, f"{out}/epoch={epoch}")
    sess.delete_path(spark, aside)
    return len(epochs) - 2


def run_to_table(counts: DataFrame, name: str) -> DataFrame:
    """Drain everything available and return the final counts as a batch DataFrame. The
    executors write the changes under the checkpoint folder; the driver holds nothing."""
    base = f"{sess.ensure_checkpoint_dir(counts.sparkSession).rstrip('/')}/streams/{name}"
    start(counts, f"{base}-state", f"{base}-out").awaitTermination()
    return current(counts.sparkSession, f"{base}-out", [c for c in counts.columns if c != "n"])


def stream_pair_link_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The registered streaming query: pair link counts computed incrementally over the
    page files of ``folder``, or of that one file; equals the batch ``pair_link_counts``."""
    head, _, name = folder.rstrip("/").rpartition("/")
    folder = f"{head}/[{name[0]}]{name[1:]}"  # a glob may match a single file, a plain path must be a folder
    name = f"pair_link_counts_stream_{uuid.uuid4().hex[:8]}"
    return run_to_table(streaming_pair_link_counts(page_stream(spark, folder)), name).select("sf", "uri", "n")
