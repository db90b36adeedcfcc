"""P9, block grammar of wiki markup: a case for each construct, text and spans checked."""

import pytest

from linkstats.sources import wikiblocks as wb
from linkstats.sources import wikitext as wt

CASES = {
    "heading": ("== Head ==\ntext", "Head\n\ntext", []),
    "headings": ("a\n=== [[B|b]] ===\nc\n====== d ======", "a\n\nb\n\nc\n\nd\n", [("b", "B")]),
    "no heading": ("a = b\n= x\n==", "a = b\n= x\n==", []),
    "list": ("* one\n** two [[T]]\n# three\n:: four", "one\ntwo T\nthree\nfour", [("T", "T")]),
    "definition": ("; term : meaning\n;only", "term\nmeaning\nonly", []),
    "rule": ("a\n-----\nb\n---- c", "a\n\nb\n\nc", []),
    "external": ("see [http://x.org/a?b=1 a label], [https://y.org] and http://z.org", "see a label,  and http://z.org", []),
    "external with link": ("[//x.org see [[A|a]] now]", "see a now", [("a", "A")]),
    "item": ("* item [http://x.org/a label]", "item label", []),
    "table": ('{| class="t"\n|+ Cap\n|-\n! H1 !! H2\n|- style="x"\n| a || style="b" | [[B|b]]\n|}\nafter',
              "Cap\nH1\tH2\na\tb\n\nafter", [("b", "B")]),
    "table in table": ("{|\n| a\n{| class=x\n| b [[C]]\n|}\n| d\n|}\ne", "a\n\nb C\n\nd\n\ne", [("C", "C")]),
    "cell lines": ("{|\n| first\nmore ''text''\n* item\n|}", "first\nmore text\nitem\n", []),
    "bars in links": ("{|\n|[[A|a]]||[[B|b]]\n|}", "a\tb\n", [("a", "A"), ("b", "B")]),
    "no table": ("| a\n! b\n|}", "| a\n! b\n|}", []),
    "open table": ("{|\n| a\nb", "a\nb", []),
    "switches": ("__NOTOC__a __TOC__ __init__", "a  __init__", []),
    "references": ("a&nbsp;b &amp;amp; &#65;&#x42; &eacute; &unknown; &lt;b&gt; &#0;", "a b &amp; AB é &unknown; <b> &#0;", []),
    "references in links": ("x &amp; [[A &amp; B|a&#44; b]] y", "x & a, b y", [("a, b", "A & B")]),
    "references are no markup": ("&#91;&#91;a]] &#61;&#61;b==", "[[a]] ==b==", []),
    "literal": ("<nowiki>[[a]] ''b'' {{c}}</nowiki> d<nowiki/>e", "[[a]] ''b'' {{c}} de", []),
    "literal lines": ("<pre>\n* a\n== b ==\n</pre>", "\n* a\n== b ==\n", []),
    "elements": ("a<ref name=x>r [[R]]</ref>b<ref name=y />c<math>x^2</math>d<gallery>\nF.jpg|[[q]]\n</gallery>e", "abcde", []),
    "open element": ("a <math> b <math> [[C]]", "a  b  C", [("C", "C")]),
    "comments": ("a<!-- [[x]]\n== y == -->b<!-- open [[z]]", "ab", []),
    "tags": ("a<br/>b <span class='x'>c</span> 1 < 2 > 0 <small>d</small>", "a\nb c 1 < 2 > 0 d", []),
    "quotes": ("'''b''' ''i'' '''''x''''' don't", "b i x don't", []),
    "colon links": ("[[:Category:X]] [[ :File:a.jpg|f]]", "Category:X f", [("Category:X", "Category:X"), ("f", "File:a.jpg")]),
    "silent": ("[[Datei:a.jpg|mini|cap [[x]]]]a[[Kategorie:B]]", "a", []),
    "template": ("{{Infobox\n| a = [[X]]\n| b = {{n|1}}\n}}\nText", "\nText", []),
    "indent": (" pre text\n  more", "pre text\n more", []),
    "nothing": ("", "", []),
}


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in CASES.items()] + [("null", None)], "wid string, markup string")
    return {r["wid"]: r for r in wt.parse_markup(df).collect()}


@pytest.mark.parametrize("name", CASES)
def test_construct(parsed, name):
    _, text, links = CASES[name]
    r = parsed[name]
    assert r["plain"] == text
    assert [(x["description"], x["id"]) for x in r["links"]] == links
    assert all(r["plain"][x["start"]:x["end"]] == x["description"] for x in r["links"])


def test_paragraphs_of_blocks(parsed, spark):
    assert parsed["null"]["plain"] == "" and parsed["null"]["paragraphsLink"] == []
    paras = parsed["table in table"]["paragraphsLink"]
    assert [p["paraText"] for p in paras] == ["a", "b C", "d", "e"]
    assert [[x["id"] for x in p["links"]] for p in paras] == [[], ["C"], [], []]
    markup = "== A ==\none &amp; [[B &amp; C|b]]\n\n* [[D]]\n* [[E|e]]\n\n[[Category:Z]]"
    r = wt.parse_markup(spark.createDataFrame([(1, markup)], "wid long, markup string")).first()
    assert [(p["paraText"], [x["id"] for x in p["links"]]) for p in r["paragraphsLink"]] == [
        ("A", []), ("one & b", ["B & C"]), ("D\ne", ["D", "E"])]


def test_linear_in_what_is_never_closed():
    import re
    import time
    silent = re.compile("file:")

    def seconds(n):
        markup = "<math> {{ [[a| <!- <ref x {| \n| b [http://c " * n
        t = time.perf_counter()
        wb.lines_to_text(wb.drop_nested(wb.drop_elements(markup), silent))
        return time.perf_counter() - t
    assert seconds(20_000) < 25 * max(seconds(2_000), 0.004)


def test_very_long_page(spark):
    markup = "== H ==\n" + "* [[T|a]] &amp; [http://x.org b]\n" * 50_000 + "[http://x.org " + "w " * 200_000 + "]"
    r = wt.parse_markup(spark.createDataFrame([(1, markup)], "wid long, markup string")).first()
    assert len(r["links"]) == 50_000 and r["plain"].startswith("H\n\na & b\na & b\n")
    last = r["links"][-1]
    assert r["plain"][last["start"]:last["end"]] == "a"
