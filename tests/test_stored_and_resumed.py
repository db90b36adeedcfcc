"""Stored vocabulary, vectors in chunks, hot paragraphs, release and resumption of jobs."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from linkstats import session as sess
from linkstats.operators import context as cx
from linkstats.operators import spotting as sp
from linkstats.operators.vocabulary_store import UNKNOWN, VocabularyStore
from linkstats.plans import jobs
from linkstats.sources import articles as src


def counts(spark, **given):
    return spark.createDataFrame(list(given.items()) or [], "token string, count bigint")


def test_vocabulary_store_keeps_ids_over_versions_and_reopening(spark, tmp_path):
    path = str(tmp_path / "vocabulary")
    store = VocabularyStore(spark, path, buckets=3)
    assert rows(store.tokens_of(spark.createDataFrame([(1,)], "token_id bigint"))) == [(1, UNKNOWN, 0)]
    store.add(counts(spark, beta=2, delta=1))
    width = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "7")  # reopened with another width
        for r in spark.sql("SHOW TABLES LIKE 'vocabulary_*'").collect():
            spark.sql(f"DROP TABLE {r['tableName']}")         # as in a new session
        again = VocabularyStore(spark, path)
        assert again.buckets == 3
        again.add(counts(spark, alpha=5, beta=1, gamma=1).union(counts(spark, gamma=1)).union(spark.createDataFrame([(None, 4)], "token string, count bigint")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    last = VocabularyStore(spark, path)
    assert rows(last.entries()) == [("alpha", 3, 5), ("beta", 1, 3), ("delta", 2, 1), ("gamma", 4, 2)]
    assert (last.version, last.max_id, last.size, last.total) == (2, 4, 4, 11)
    ids = spark.createDataFrame([(1,), (4,), (9,), (1,), (None,)], "token_id bigint")
    got = sorted((r["token_id"] or -1, r["token"], r["vocab_count"]) for r in last.tokens_of(ids).collect())
    assert got == [(-1, UNKNOWN, 0), (1, "beta", 3), (1, "beta", 3), (4, "gamma", 2), (9, UNKNOWN, 0)]
    words = spark.createDataFrame([("gamma",), ("omega",)], "token string")
    assert rows(last.ids_of(words)) == [("gamma", 4, 2), ("omega", 0, 0)]
    last.keep_last()
    assert sorted(os.listdir(path)) == ["manifest", "v2"]
    assert rows(VocabularyStore(spark, path).entries("token_id"), "token_id") == [(1,), (2,), (3,), (4,)]


def test_unfinished_version_is_written_anew(spark, tmp_path):
    path = str(tmp_path / "v")
    store = VocabularyStore(spark, path, buckets=2)
    store.add(counts(spark, a=1))
    counts(spark, junk=1).select("token", F.lit(7).cast("long").alias("token_id"), "count").write.parquet(f"{path}/v2/token")  # a job that died
    VocabularyStore(spark, path).add(counts(spark, b=1))
    assert rows(VocabularyStore(spark, path).entries()) == [("a", 1, 1), ("b", 2, 1)]


def test_vector_chunks_join_to_the_vector(spark):
    data = [(u, f"s{i:03d}", 1 + i % 5) for u, n in (("a", 57), ("b", 10), ("c", 1)) for i in range(n)] + [("d", None, None)]
    table = spark.createDataFrame(data, "uri string, stem string, n long").repartition(5)
    want = dict(rows(cx.render_vectors(table)))
    for size in (1, 10, 1000):
        got = {}
        for uri, chunk, vector in rows(cx.vector_chunks(table, size), "uri", "chunk", "vector"):
            got.setdefault(uri, []).append(vector)
            assert len(got[uri]) == chunk + 1 and vector.count("(") <= size
        assert {u: ",".join(v) for u, v in got.items()} == want


def test_a_hot_paragraph_is_cut_into_blocks(spark):
    pairs = spark.createDataFrame([(f"U{i}", "hot") for i in range(300)] + [("U1", "cold"), ("V", "cold"), ("W", "none")], "uri string, para_key string")
    paragraphs = spark.createDataFrame([("hot", "red red blue"), ("cold", "red green")], "para_key string, para string")
    left, right = cx.blocked(pairs, cx.paragraph_token_counts(paragraphs), block=20)
    sizes = {(r["para_key"], r["_block"]): r["count"] for r in left.groupBy("para_key", "_block").count().collect()}
    assert len([k for k in sizes if k[0] == "hot"]) == 15 and max(sizes.values()) < 45
    assert right.count() == 2 * 15 + 2
    plain = rows(cx.token_counts(pairs, paragraphs))
    assert rows(cx.token_counts(pairs, paragraphs, block=20)) == plain and len(plain) == 300 * 2 + 3


def folders(spark):
    base = sess.ensure_checkpoint_dir(spark).removeprefix("file:") + "/tables"
    return set(os.listdir(base)) if os.path.isdir(base) else set()


def test_scopes_release_all_but_what_they_keep(spark):
    before = folders(spark)
    with sess.scratch_tables(spark):
        with sess.scratch_tables(spark) as inner:
            sess.materialize(spark.range(5), "a")
            kept = inner.keep(sess.materialize(spark.range(7), "b").where("id > 2"), "kept")
        assert len(folders(spark) - before) == 1 and kept.count() == 4
    assert folders(spark) == before


def test_a_failed_job_goes_on_behind_its_last_step(spark, fixtures_dir, tmp_path, monkeypatch):
    dump, steps = os.path.join(fixtures_dir, "mini.xml"), str(tmp_path / "steps")
    whole = str(tmp_path / "whole")
    jobs.run_stats(src.read_xml_articles(spark, dump), whole)
    with monkeypatch.context() as m:
        m.setattr(sp, "spot_surface_forms", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            jobs.run_stats(src.read_xml_articles(spark, dump), str(tmp_path / "out"), resume=steps, source=dump)
    key = os.listdir(steps)
    assert len(key) == 1 and sorted(os.listdir(f"{steps}/{key[0]}")) == ["articles", "link_facts", "redirects"]
    with monkeypatch.context() as m:  # the finished steps are not built again
        m.setattr(jobs.rd, "resolve", lambda *a: (_ for _ in ()).throw(RuntimeError("built again")))
        jobs.run_stats(src.read_xml_articles(spark, dump), str(tmp_path / "out"), resume=steps, source=dump)
    assert os.listdir(steps) == []
    for name in os.listdir(whole):
        assert rows(spark.read.text(f"{whole}/{name}")) == rows(spark.read.text(str(tmp_path / "out" / name)))
    a, b = (sess.Steps(spark, steps, k).path for k in ("x", "y"))
    assert a != b
