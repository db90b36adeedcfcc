"""Q1-Q5 checks and the build_stats options (weight, resolve_links, encode_uris, dedupe)."""

import os

from conftest import rows
from linkstats.operators import quality as qa
from linkstats.operators import redirects as rd
from linkstats.plans import jobs
from linkstats.sources import articles as src


def test_quality_checks(spark):
    sfs = spark.createDataFrame([("a",), ("",), (None,)], "sf string")
    assert tuple(qa.empty_surface_forms(sfs).first()) == ("empty_sf", 3, 2)
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "c")], "src string, dst string")
    assert tuple(qa.redirect_count(edges).first()) == ("redirect_count", 3, 1)
    acyclic = spark.createDataFrame([("a", "b"), ("b", "c")], "src string, dst string")
    assert tuple(qa.redirect_terminal(rd.resolve(acyclic), acyclic).first()) == ("redirect_terminal", 2, 0)
    texts = spark.createDataFrame([(1, "New York is big")], "wid long, text string")
    spots = spark.createDataFrame([(1, "New York", 0), (1, "big", 12), (1, "York", 0)],
                                  "wid long, sf string, offset long")
    assert tuple(qa.spot_offsets(spots, texts).first()) == ("spot_offsets", 3, 1)


def test_build_stats_options(spark, fixtures_dir):
    arts = src.read_xml_articles(spark, os.path.join(fixtures_dir, "mini.xml"))
    base = jobs.build_stats(arts)
    links = jobs.build_stats(arts, weight="links")
    # 'Spree' is linked twice on page 1 and spotted twice there: occurrences weigh 2 x 2
    assert ("Spree", "Spree (river)", 4) in rows(base["pair_counts"])
    assert ("Spree", "Spree (river)", 2) in rows(links["pair_counts"])
    enc = jobs.build_stats(arts, encode_uris=True)
    assert all(u.startswith("http://en.kb.example.org/resource/") for (u, _) in rows(enc["uri_counts"]))
    assert ("Spree", "http://en.kb.example.org/resource/Spree_(river)", 4) in rows(enc["pair_counts"])
    # links to the redirect title Deutschland would count for Germany once resolved
    res = jobs.build_stats(arts, resolve_links=True)
    assert dict(rows(res["uri_counts"]))["Germany"] >= dict(rows(base["uri_counts"]))["Germany"]
    ded = jobs.build_stats(arts, dedupe_lowercase=True)
    totals = rows(ded["total_sf_counts"])
    assert len([r for r in totals if r[1] == -1]) == len({r[0] for r in totals if r[1] == -1})
