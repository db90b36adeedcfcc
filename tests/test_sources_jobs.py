"""S1-S7 sources and sinks, P9 markup extraction, W1-W4 jobs, the driver contract."""

import os
import tempfile

from conftest import rows
from linkstats.operators import extract as ex
from linkstats.sources import pages as pg
from linkstats.operators import extract as ex
from linkstats.plans import jobs
from linkstats.sources import articles as src
from linkstats.sources import sinks
from linkstats.sources import stopwords as sw


def test_xml_to_articles(spark, fixtures_dir):
    a = src.read_xml_articles(spark, os.path.join(fixtures_dir, "mini.xml"))
    by_id = {r["wid"]: r for r in a.collect()}
    assert by_id[3]["type"] == "REDIRECT" and by_id[3]["redirect"] == "Germany"
    assert by_id[1]["type"] == "ARTICLE"
    text = by_id[1]["wikiText"]
    assert "[[" not in text and "{{" not in text and "'''" not in text
    for l in by_id[1]["links"]:
        assert text[l["start"]:l["end"]] == l["description"]
    assert {(l["description"], l["id"]) for l in by_id[1]["links"]} == {
        ("Germany", "Germany"), ("Spree", "Spree (river)"), ("museums", "museum")}
    paras = by_id[1]["paragraphsLink"]
    assert len(paras) == 2 and [x["id"] for x in paras[1]["links"]] == ["museum", "Spree (river)"]
    assert rows(ex.redirect_edges(a)) == [("BRD", "Deutschland"), ("Deutschland", "Germany")]


def test_json_corrupt_and_round_trip(spark, fixtures_dir):
    raw = src.read_json_articles(spark, os.path.join(fixtures_dir, "mini.jsonl")).cache()
    good, bad = src.split_corrupt(raw)
    assert good.count() == 3 and bad.count() == 1
    assert bad.first()["_corrupt_record"] == "Error Parsing Page Element"
    assert rows(ex.link_facts(good)) == [(1, "Germany", "Germany"), (2, "France", "France")]   # zero span dropped
    assert rows(ex.surface_forms(good)) == [("France",), ("Germany",)]                         # ...but kept here
    out = tempfile.mkdtemp(prefix="linkstats-json-")
    sinks.write_json_lines(good, os.path.join(out, "corpus"))
    back = src.read_json_articles(spark, os.path.join(out, "corpus"))
    assert rows(back.drop("_corrupt_record"), "wid", "wikiTitle", "type") == rows(good, "wid", "wikiTitle", "type")


def test_stats_from_xml_and_sinks(spark, fixtures_dir):
    stats = jobs.stats_from_xml(spark, os.path.join(fixtures_dir, "mini.xml"))
    assert set(stats) == set(jobs.STAT_TABLES)
    uris = dict(rows(stats["uri_counts"]))
    assert uris["Germany"] >= 3                      # links + the two redirect titles
    pairs = rows(stats["pair_counts"])
    assert ("Deutschland", "Germany", 1) in pairs and ("BRD", "Germany", 1) in pairs
    out = tempfile.mkdtemp(prefix="linkstats-out-")
    jobs.write_stats(stats, out)
    assert sorted(os.listdir(out)) == ["PairCounts", "TokenCounts", "TotalSfCounts", "UriCounts"]
    back = spark.read.option("sep", "\t").csv(os.path.join(out, "UriCounts"))
    assert back.count() == stats["uri_counts"].count()


def test_export_and_annotate(spark, fixtures_dir):
    out = tempfile.mkdtemp(prefix="linkstats-export-")
    jobs.export_corpus(spark, os.path.join(fixtures_dir, "mini.xml"), os.path.join(out, "json"))
    arts = src.read_json_articles(spark, os.path.join(out, "json"))
    annotated = dict(rows(jobs.annotate_corpus(arts)))
    assert "http://en.kb.example.org/resource/Germany" in annotated[1]
    assert "http://en.kb.example.org/resource/Spree_(river)" in annotated[1]


def test_stop_words_file(spark):
    d = tempfile.mkdtemp(prefix="linkstats-sw-")
    p = os.path.join(d, "stop.txt")
    with open(p, "w") as f:
        f.write(" the \nand\n\nthe\n")
    assert rows(sw.read_stop_words(spark, p)) == [("and",), ("the",)]


def test_driver_contract(spark):
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())
    df = E.entry(spark)
    assert set(df.columns) == {"sf", "uri", "n"}
    assert df.count() > 0


def test_markup_with_unclosed_brackets(spark):
    from linkstats.sources import wikitext as wt
    df = spark.createDataFrame([(1, "a [[b c and [[x|y]] end [[z]]")], "wid long, markup string")
    r = wt.parse_markup(df).first()
    assert r["plain"] == "a [[b c and y end z"
    assert [(l["description"], l["id"], r["plain"][l["start"]:l["end"]]) for l in r["links"]] == [
        ("y", "x", "y"), ("z", "z", "z")]


def test_link_spans_are_true_offsets(spark):
    """A link's span is where its text stands in the page text; only an empty anchor at the
    very beginning has the zero span."""
    html = ['<a href="/A">Alpha</a> and <p>then <a href="/B"> b &amp; c </a>x<a href="/C">C\n c</a></p>',
            '<a href="/Z"></a>text <a href="/E"> </a> more <a href="/F">f</a>', "no links", None]
    pages = spark.createDataFrame([(i, "http://h/", h) for i, h in enumerate(html)], "page_id long, url string, html string")
    pt = pg.page_table(pages, with_paragraphs=False)
    text = {r["wid"]: r["text"] for r in pt.collect()}
    got = [(r["wid"], r["uri"], r["start"], r["end"], text[r["wid"]][r["start"]:r["end"]])
           for r in pg.links(pt).orderBy("wid", "pos").collect()]
    assert [(w, u, t) for w, u, _, _, t in got] == [(0, "A", "Alpha"), (0, "B", "b & c"), (0, "C", "C c"),
                                                   (1, "Z", ""), (1, "E", ""), (1, "F", "f")]
    facts = ex.link_facts(pg.article_rows(pt)).select("uri").collect()
    assert sorted(r["uri"] for r in facts) == ["A", "B", "C", "E", "F"]


def test_nested_markup_and_silent_links(spark):
    from linkstats.sources import wikitext as wt
    markup = ["x{{a|{{b}} tail}}y", "[[File:x.jpg|thumb|A [[cap]]]]Berlin [[Category:Cities]]", "{{open [[l]] end", "a }} b ]] c", None,
              "{{t [[u }}v]] [[image : z]]w"]
    df = spark.createDataFrame(list(enumerate(markup)), "wid long, markup string")
    got = {r["wid"]: r for r in wt.parse_markup(df).collect()}
    assert [got[i]["plain"] for i in range(6)] == ["xy", "Berlin ", "{{open l end", "a }} b ]] c", "", "v]] w"]
    assert [[l["id"] for l in got[i]["links"]] for i in range(6)] == [[], [], ["l"], [], [], []]


def test_pages_without_ids_stay_apart(spark):
    from linkstats.sources import wikitext as wt
    df = spark.createDataFrame([(None, "T", "one [[a]]"), (None, "T", "two [[b]]")], "wid long, wikiTitle string, markup string")
    assert rows(wt.parse_markup(df), "plain") == [("one a",), ("two b",)]


def test_xml_namespaces_and_quarantine(spark):
    folder = tempfile.mkdtemp(prefix="linkstats-xml-")
    page = "<page><title>{}</title><ns>{}</ns><id>{}</id><revision><text>see [[A]]</text></revision></page>"
    with open(os.path.join(folder, "d.xml"), "w") as f:
        f.write("<mediawiki>" + "".join(page.format(*x) for x in [
            ("A", 0, 1), ("Talk:A", 1, 2), ("Bad", 0, "x1"), ("Bad", 0, "x2")]) + "</mediawiki>")
    good, bad = src.split_corrupt(src.read_xml_articles(spark, folder))
    assert rows(good, "wid", "type") == [(1, "ARTICLE"), (2, "OTHER")]
    assert len(bad.collect()) == 2 and all("Bad" in r["_corrupt_record"] for r in bad.collect())
    assert rows(ex.link_facts(good), "wid", "uri") == [(1, "A")]


def test_run_stats_leaves_only_its_output(spark, fixtures_dir):
    from linkstats import session as sess
    base = sess.ensure_checkpoint_dir(spark).removeprefix("file:") + "/tables"
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    out = tempfile.mkdtemp(prefix="linkstats-run-")
    jobs.run_stats(src.read_xml_articles(spark, os.path.join(fixtures_dir, "mini.xml")), out, algorithm="porter")
    assert sorted(os.listdir(out)) == ["PairCounts", "TokenCounts", "TotalSfCounts", "UriCounts"]
    assert set(os.listdir(base)) == before
