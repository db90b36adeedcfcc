"""A1-A8 with the quirks the reference's outputs depend on."""

from conftest import rows
from linkstats.functions import stem as st
from linkstats.operators import context as cx
from linkstats.operators import counts as ct
from linkstats.operators import quality as qa
from pyspark.sql import functions as F


def facts(spark, data):
    return spark.createDataFrame(data, "wid long, sf string, uri string")


def spots_df(spark, data):
    return spark.createDataFrame(data, "wid long, sf string, offset long")


def test_weights_k_times_n(spark):
    lf = facts(spark, [(1, "Paris", "Paris"), (1, "Paris", "Paris"), (1, "Lyon", "Lyon"), (2, "x", "")])
    sp = spots_df(spark, [(1, "Paris", 0), (1, "Paris", 10), (1, "Paris", 20), (2, "x", 0)])
    got = rows(ct.pair_counts(lf, sp))
    assert got == [("Lyon", "Lyon", 1), ("Paris", "Paris", 6)]          # k*n = 2*3, empty uri dropped
    assert rows(ct.pair_counts(lf, sp, weight="links")) == [("Lyon", "Lyon", 1), ("Paris", "Paris", 2)]
    resolved = spark.createDataFrame([("Paname", "Paris")], "title string, final string")
    assert rows(ct.uri_counts(lf, sp, resolved)) == [("Lyon", 1), ("Paris", 7)]
    j = rows(ct.link_spot_join(lf, sp), "sf", "links", "spots", "weight")
    assert ("Paris", 2, 3, 6) in j and ("Lyon", 1, 0, 1) in j


def test_total_sf_counts_quirks(spark):
    lf = facts(spark, [(1, "Berlin", "B")] * 5 + [(1, "BERLIN", "B"), (1, "berlin", "B"), (2, "Rare", "R")] * 1)
    sp = spots_df(spark, [(1, "Berlin", 0)] * 2 + [(1, "berlin", 3)])
    got = rows(ct.total_sf_counts(lf, sp))
    assert ("Berlin", 5, 2) in got                      # annotated 5, spotted 2
    assert ("Rare", 1, 1) in got                        # never spotted -> total 1
    assert ("BERLIN", 1, 1) in got
    assert got.count(("berlin", -1, 1)) == 2            # one phantom per differing case form
    assert ("berlin", 1, 1) in got                      # the real lower-case row coexists
    assert ("rare", -1, 1) in got
    dedup = rows(ct.total_sf_counts(lf, sp, dedupe_lowercase=True))
    assert ("berlin", -1, 1) not in dedup and ("rare", -1, 1) in dedup
    q4 = qa.annotated_total(ct.total_sf_counts(lf, sp), lf).first()
    assert q4["n_rows"] == 8 and q4["n_violations"] == 0


def test_s_stemmer(spark):
    words = ["queries", "aies", "goes", "cats", "bus", "glass", "trees", "ties", "s", "Dogs"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = dict(rows(df.select("w", st.s_stem(F.col("w")).alias("s"))))
    assert got == {"queries": "query", "aies": "aie", "goes": "goe", "cats": "cat", "bus": "bus",
                   "glass": "glass", "trees": "tree", "ties": "ty", "s": "", "Dogs": "dog"}


def test_context_vectors(spark):
    paragraphs = spark.createDataFrame(
        [("k1", "Cats and dogs. Cats!"), ("k2", "the and of"), ("k3", "Dogs bark")], "para_key string, para string")
    pairs = spark.createDataFrame([("X", "k1"), ("X", "k3"), ("Y", "k2"), ("Z", "k1")], "uri string, para_key string")
    stops = spark.createDataFrame([("the",), ("and",), ("of",)], "word string")
    got = dict(rows(cx.context_vectors(pairs, paragraphs, stops)))
    wiki = "http://en.wikipedia.org/wiki/"
    assert got[wiki + "X"] == "(cat,2),(dog,2),(bark,1)"    # count desc, then stem
    assert got[wiki + "Y"] == ""                        # only stop words: empty vector
    assert got[wiki + "Z"] == "(cat,2),(dog,1)"
    top1 = dict(rows(cx.context_vectors(pairs, paragraphs, stops, top_k=1)))
    assert top1[wiki + "X"] == "(cat,2)"


def test_identical_paragraphs_count_once(spark):
    from linkstats.operators import extract as ex
    from linkstats import schema as S
    arts = spark.createDataFrame([
        (1, "A", "ARTICLE", None, "t", [], [("Same text here", [("U",), ("U",)])]),
        (2, "B", "ARTICLE", None, "t", [], [("Same text here", [("U",)])]),
    ], S.ARTICLE)
    pairs, texts = ex.uri_paragraphs(arts)
    assert pairs.count() == 1 and texts.count() == 1
    got = dict(rows(cx.context_vectors(pairs, texts, None)))
    assert got["http://en.wikipedia.org/wiki/U"] == "(here,1),(same,1),(text,1)"
