"""Adapters from the driver's web-page and part tables to the relations the jobs use.

Every definition here has a twin in the DuckDB oracle (``linkstats/plans/oracle.py``).

    page_table(wid, url, h1, text, links, paras)   one parse of the html, reused by all
    articles(wid, text, h1)            page text without markup
    links(wid, pos, uri, sf, start, end)
    redirects(src, dst)                a redirect graph derived from the link ids
    cyclic_redirects(src, dst)         a functional graph with tails and cycles (part)
    titles(uri, sf)                    page headings with at least one word
    paragraphs(para_key, para)         distinct paragraph texts
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkstats import schema as S
from linkstats.functions import text as tx

CYCLE_MODULUS = 1000
# Two noncharacters that Unicode keeps out of interchanged text mark where an
# anchor's text begins and ends while the offsets are computed.
OPEN, CLOSE = "\ufdd0", "\ufdd1"


def page_bodies(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").alias("wid"), "url", tx.drop_scripts(F.col("html")).alias("body"))


def _marked_text(body) -> F.Column:
    """The page text with every anchor's text between OPEN and CLOSE: the anchors are marked
    in the html, which then takes the same way as the text itself. Blanks inside the marks'
    edges belong to the blank run around the anchor, and an empty anchor has no blank after it."""
    marked = tx.markup_to_text(F.regexp_replace(body, tx.ANCHOR_PATTERN, f'<a href="/$1">{OPEN}$2{CLOSE}</a>'))
    marked = F.replace(F.replace(marked, F.lit(f"{OPEN} "), F.lit(OPEN)), F.lit(f" {CLOSE}"), F.lit(CLOSE))
    return F.replace(marked, F.lit(f"{OPEN}{CLOSE} "), F.lit(OPEN + CLOSE))


def _with_links(b: DataFrame) -> DataFrame:
    """Adds ``links`` with their true spans in the page text (code points) to rows with a
    ``body``; ``end - start`` is the length the anchor has there, after blank runs collapsed.
    The starts are one running sum over the lengths of a page's pieces."""
    b = b.withColumn("_uris", F.regexp_extract_all("body", tx.lit_re(tx.ANCHOR_PATTERN), 1))
    b = b.withColumn("_sfs", F.regexp_extract_all("body", tx.lit_re(tx.ANCHOR_PATTERN), 2))
    b = b.withColumn("_parts", F.split(_marked_text(F.col("body")), OPEN))
    b = b.withColumn("_before", F.transform("_parts", lambda p: F.length(F.replace(p, F.lit(CLOSE), F.lit("")))))
    b = b.withColumn("_at", tx.sums_before(F.col("_before")))
    inside = F.transform(F.slice("_parts", 2, F.size("_parts")), lambda p: F.length(F.substring_index(p, CLOSE, 1)))
    zipped = F.arrays_zip(F.col("_uris").alias("uris"), F.col("_sfs").alias("sfs"), inside.alias("inside"),
                          F.slice("_at", 2, F.size("_at")).alias("start"))
    b = b.withColumn("links", F.transform(zipped, lambda x: F.struct(
        tx.decode_entities(x["sfs"]).alias("description"), (x["start"] + x["inside"]).alias("end"),
        x["uris"].alias("id"), x["start"].alias("start"))))
    return b.withColumn("links", F.coalesce("links", F.array().cast(S.ARTICLE["links"].dataType)))


def _raw_paragraphs(body) -> F.Column:
    marked = F.regexp_replace(body, tx.P_OPEN_PATTERN, "</p><p>")
    return F.regexp_extract_all(marked, tx.lit_re(tx.PARAGRAPH_PATTERN), 1)


def _paragraph_array(body) -> F.Column:
    return F.filter(F.transform(_raw_paragraphs(body), tx.markup_to_text), lambda p: p != "")


def _paragraph_links(body) -> F.Column:
    """Paragraphs and lists with the ids of the links inside them, as the article schema
    holds its paragraphs."""
    def one(raw):
        ids = F.regexp_extract_all(raw, tx.lit_re(tx.ANCHOR_PATTERN), 1)
        return F.struct(tx.markup_to_text(raw).alias("paraText"), F.transform(ids, lambda x: F.struct(x.alias("id"))).alias("links"))

    blocks = F.concat(_raw_paragraphs(body), F.regexp_extract_all(body, tx.lit_re(tx.LIST_PATTERN), 1))
    paragraphs = F.filter(F.transform(blocks, one), lambda p: p["paraText"] != "")
    return paragraphs.cast(S.ARTICLE["paragraphsLink"].dataType)


def page_table(pages: DataFrame, with_paragraphs: bool = True, with_text: bool = True,
               with_paragraph_links: bool = False, with_links: bool | None = None) -> DataFrame:
    """Everything the jobs need from a page, from one pass over its html (narrow):
    (wid, url, h1[, text][, links array<description, end, id, start>][, paras array<string>]
    [, paragraphsLink]). Links come with the text unless ``with_links`` says otherwise."""
    b = page_bodies(pages)
    cols = [
        F.col("wid").cast("long").alias("wid"), "url",
        tx.markup_to_text(F.regexp_extract("body", tx.H1_PATTERN, 1)).alias("h1"),
    ]
    if with_text:
        cols.append(tx.markup_to_text(F.col("body")).alias("text"))
    if with_text if with_links is None else with_links:
        b = _with_links(b)
        cols.append("links")
    if with_paragraphs:
        cols.append(_paragraph_array(F.col("body")).alias("paras"))
    if with_paragraph_links:
        cols.append(_paragraph_links(F.col("body")).alias("paragraphsLink"))
    return b.select(*cols)


def articles(pt: DataFrame) -> DataFrame:
    """(wid, text, h1) from the page table."""
    return pt.select("wid", "text", "h1")


def links(pt: DataFrame) -> DataFrame:
    """One row per anchor ``<a href="/X">Y</a>``: uri = X, sf = Y (narrow, no shuffle)."""
    return (pt.select("wid", F.posexplode("links").alias("pos", "l"))
            .select("wid", F.col("pos").cast("long").alias("pos"),
                    F.col("l.id").alias("uri"), F.col("l.description").alias("sf"),
                    F.col("l.start").alias("start"), F.col("l.end").alias("end")))


def redirects(link_df: DataFrame) -> DataFrame:
    """Redirects from the distinct link ids: an id with non-word characters redirects to
    the id without them, any other id to its lower-case form; each target again to its
    lower-case form. Self-edges and empty targets are dropped."""
    u = link_df.select(F.col("uri")).distinct()
    first = u.select(
        F.col("uri").alias("src"),
        F.when(F.col("uri").rlike(tx.NON_WORD_CHAR), F.regexp_replace("uri", tx.NON_WORD_CHAR, ""))
        .otherwise(F.lower("uri")).alias("dst"))
    second = first.select(F.col("dst").alias("src"), F.lower("dst").alias("dst"))
    return (first.unionByName(second)
            .where((F.col("src") != F.col("dst")) & (F.col("dst") != ""))
            .distinct())


def cyclic_redirects(part: DataFrame) -> DataFrame:
    """src = p_partkey, dst = (p_partkey^2 + 1) mod 1000, over the whole table."""
    k = F.col("p_partkey").cast("long")
    return part.select(k.cast("string").alias("src"),
                       ((k * k + 1) % CYCLE_MODULUS).cast("string").alias("dst"))


def titles(pt: DataFrame) -> DataFrame:
    """Multi-word dictionary: whole page heading -> page url without query and fragment."""
    return (pt.select(tx.strip_url_query(F.col("url")).alias("uri"), F.col("h1").alias("sf"))
            .where(F.col("sf").rlike(tx.WORD_CHAR)))


def paragraphs(pt: DataFrame) -> DataFrame:
    """Distinct paragraph texts keyed by their SHA-256, so later shuffles move keys."""
    para = pt.select(F.explode("paras").alias("para"))
    return para.distinct().select(F.sha2("para", 256).alias("para_key"), "para")


# Characters of plain text that wiki markup would read as its own.
_MARKUP_CHARACTERS = "&<>[]{}|'="


def _as_plain(c) -> F.Column:
    for ch in _MARKUP_CHARACTERS:  # the ampersand first
        c = F.replace(c, F.lit(ch), F.lit(f"&#{ord(ch)};"))
    return c


def wiki_dump(pt: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows of an XML dump (ns, id, title, redirect, revision): every page as an article in
    wiki markup (heading, table, list of its links, reference and category), every redirect
    edge as a redirect page. An adapter: only gives input in the dump's schema."""
    def item(link):
        return F.concat(F.lit("* [["), _as_plain(link["id"]), F.lit("|"), _as_plain(link["description"]), F.lit("]] [http://x.org/a more]"))
    wid = F.col("wid").cast("string")
    markup = F.concat(
        F.lit("== Page "), wid, F.lit(" ==\n{| class=\"infobox\"\n|-\n! Page !! Heading\n|-\n| "), wid,
        F.lit(" || style=\"x\" | '''"), _as_plain(F.col("h1")), F.lit(".'''\n|}\n"),
        F.array_join(F.transform("links", item), "\n"), F.lit("\n<ref>{{cite|[[gone]]}}</ref>[[Category:All]]"))
    redirect = "struct<_title: string>"
    pages = pt.select(F.lit(0).cast("long").alias("ns"), F.col("wid").alias("id"), F.concat(F.lit("Page "), wid).alias("title"),
                      F.lit(None).cast(redirect).alias("redirect"), F.struct(markup.alias("text")).alias("revision"))
    moved = edges.select(F.lit(0).cast("long").alias("ns"), F.lit(None).cast("long").alias("id"), F.col("src").alias("title"),
                         F.struct(F.col("dst").alias("_title")).alias("redirect"), F.struct(F.lit("#REDIRECT").alias("text")).alias("revision"))
    return pages.unionByName(moved)


def article_rows(pt: DataFrame) -> DataFrame:
    """Every page as an ARTICLE row of the article schema (narrow; works on streams)."""
    none = F.lit(None).cast(S.ARTICLE["paragraphsLink"].dataType)
    return pt.select(
        "wid",
        F.col("h1").alias("wikiTitle"),
        F.lit(S.ARTICLE_TYPE).alias("type"),
        F.lit(None).cast("string").alias("redirect"),
        (F.col("text") if "text" in pt.columns else F.lit(None).cast("string")).alias("wikiText"),
        "links",
        (F.col("paragraphsLink") if "paragraphsLink" in pt.columns else none).alias("paragraphsLink"),
    )


def typed_pages(pt: DataFrame) -> DataFrame:
    """Pages in the article schema: every page as ARTICLE with its links, plus one
    REDIRECT row per derived redirect edge."""
    arts = article_rows(pt)
    reds = redirects(links(pt)).select(
        F.lit(None).cast("long").alias("wid"),
        F.col("src").alias("wikiTitle"),
        F.lit(S.REDIRECT_TYPE).alias("type"),
        F.col("dst").alias("redirect"),
        F.lit("").alias("wikiText"),
        F.lit(None).cast(S.ARTICLE["links"].dataType).alias("links"),
        F.lit(None).cast(S.ARTICLE["paragraphsLink"].dataType).alias("paragraphsLink"),
    )
    return arts.unionByName(reds)
