"""P8 URI normalisation and X1 rewrite."""

from pyspark.sql import functions as F

from conftest import rows
from linkstats.functions import uris as ur
from linkstats.operators import rewrite as rw

RES = "http://en.kb.example.org/resource/"
WIKI = "http://en.wikipedia.org/wiki/"


def test_uri_normalisation(spark):
    ids = ["Caf%C3%A9", "a%2Fb", "50% off", "C++", "A  b_", WIKI + "Berlin", RES + "Paris",
           "http://kb.example.org/resource/Rome", "100%25 sure %zz"]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    got = dict(rows(df.select("id", ur.resource_uri(F.col("id")).alias("r"))))
    assert got["Caf%C3%A9"] == RES + "Café"
    assert got["a%2Fb"] == RES + "a/b"
    assert got["50% off"] == RES + "50%_off"             # stray '%': not decoded
    assert got["C++"] == RES + "C++"
    assert got["A  b_"] == RES + "A_b"
    assert got[WIKI + "Berlin"] == RES + "Berlin"
    assert got[RES + "Paris"] == RES + "Paris"
    assert got["http://kb.example.org/resource/Rome"] == RES + "Rome"
    assert got["100%25 sure %zz"] == RES + "100%25_sure_%zz"
    w = dict(rows(df.select("id", ur.wiki_url(F.col("id")).alias("w"))))
    assert w["Caf%C3%A9"] == WIKI + "Café"


def test_splice_and_rewrite(spark):
    texts = spark.createDataFrame([(1, "Berlin is in Germany."), (2, "no spots")], "wid long, text string")
    linked = spark.createDataFrame([(1, "Berlin", 0, "Berlin"), (1, "Germany", 13, "Deutschland")],
                                   "wid long, sf string, offset long, uri string")
    resolved = spark.createDataFrame([("deutschland", "Germany")], "title string, final string")
    got = dict(rows(rw.rewrite_text(texts, linked, resolved)))
    assert got[1] == f" {RES}Berlin  is in  {RES}Germany ."
    assert got[2] == "no spots"
