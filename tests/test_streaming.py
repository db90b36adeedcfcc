"""Structured Streaming link counts: two arrivals, one restarted query, batch-equal."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import rows
from linkstats.operators import counts as ct
from linkstats.operators import extract as ex
from linkstats.sources import pages as pg
from linkstats.streaming import link_counts as sl

PAGES = "/root/testdata/sf0.001/pages.parquet"


def run_once(spark, inbox, state, out):
    stream = sl.streaming_pair_link_counts(sl.page_stream(spark, os.path.join(inbox, "*")))
    q = sl.start(stream, state, out)
    q.awaitTermination()
    return rows(sl.current(spark, out, ["sf", "uri"])), q


def batch_counts(pages):
    return rows(ct.pair_counts(ex.link_facts(pg.article_rows(pg.page_table(pages))), weight="links"))


def test_restarted_stream_equals_batch(spark):
    pages = spark.read.parquet(PAGES)
    even = pages.where(F.col("page_id") % 2 == 0)
    inbox = tempfile.mkdtemp(prefix="linkstats-inbox-")
    scratch = tempfile.mkdtemp(prefix="linkstats-sck-")
    folders = os.path.join(scratch, "state"), os.path.join(scratch, "out")
    even.write.parquet(os.path.join(inbox, "a"))
    first, q1 = run_once(spark, inbox, *folders)
    assert first == batch_counts(even)

    pages.where(F.col("page_id") % 2 == 1).write.parquet(os.path.join(inbox, "b"))
    second, q2 = run_once(spark, inbox, *folders)
    assert second == batch_counts(pages)
    # the restart read only the new files: its input is the odd half
    n_odd = pages.where(F.col("page_id") % 2 == 1).count()
    assert sum(p["numInputRows"] for p in q2.recentProgress) == n_odd


def test_compacted_changes_are_the_same_counts(spark):
    pages = spark.read.parquet(PAGES)
    inbox = tempfile.mkdtemp(prefix="linkstats-inbox-")
    scratch = tempfile.mkdtemp(prefix="linkstats-sck-")
    folders = os.path.join(scratch, "state"), os.path.join(scratch, "out")
    for k in range(5):
        pages.where(F.col("page_id") % 5 == k).write.parquet(os.path.join(inbox, f"arrival{k}"))
        got, _ = run_once(spark, inbox, *folders)
        if k == 1:  # two folders: none may go
            assert sl.compact(spark, folders[1], ["sf", "uri"]) == 0
        if k == 3:
            # a call that died after writing aside leaves a folder that nobody reads
            spark.range(3).selectExpr("'x' AS sf", "'y' AS uri", "id AS n").write.parquet(f"{folders[1]}/_compact-dead")
            assert rows(sl.current(spark, folders[1], ["sf", "uri"])) == got
            assert sl.compact(spark, folders[1], ["sf", "uri"]) == 2
            assert sorted(os.listdir(folders[1])) == ["epoch=2", "epoch=3"]
            assert rows(sl.current(spark, folders[1], ["sf", "uri"])) == got
    assert got == batch_counts(pages)  # the stream went on behind the compaction
    assert sl.compact(spark, folders[1], ["sf", "uri"]) == 1 and sl.compact(spark, folders[1], ["sf", "uri"]) == 0
    assert rows(sl.current(spark, folders[1], ["sf", "uri"])) == got


def test_registered_stream_reads_a_folder_of_parts(spark):
    pages = spark.read.parquet(PAGES)
    folder = os.path.join(tempfile.mkdtemp(prefix="linkstats-parts-"), "pages.parquet")
    pages.repartition(3).write.parquet(folder)
    assert rows(sl.stream_pair_link_counts(spark, folder)) == batch_counts(pages)


def test_uri_counts_stream_through_table(spark):
    pages = spark.read.parquet(PAGES)
    inbox = tempfile.mkdtemp(prefix="linkstats-inbox-")
    pages.write.parquet(os.path.join(inbox, "all"))
    stream = sl.streaming_uri_link_counts(sl.page_stream(spark, os.path.join(inbox, "*")))
    got = rows(sl.run_to_table(stream, "uri_counts_stream_test"))
    want = rows(ct.uri_counts(ex.link_facts(pg.article_rows(pg.page_table(pages))), weight="links"))
    assert got == want
