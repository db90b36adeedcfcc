"""Projections and extraction over the article table.

All of these are narrow (filters, projections, explodes) except the two distincts;
filters on ``type`` are plain column predicates, so they reach a Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkstats import schema as S



def is_article():
    return F.col("type") == S.ARTICLE_TYPE


def is_redirect():
    return F.col("type") == S.REDIRECT_TYPE


def article_pages(articles: DataFrame) -> DataFrame:
    """Pages of type ARTICLE."""
    return articles.where(is_article())


def redirect_edges(articles: DataFrame) -> DataFrame:
    """(src, dst) = (title, redirect target) of every REDIRECT page."""
    return articles.where(is_redirect()).select(F.col("wikiTitle").alias("src"), F.col("redirect").alias("dst"))


def article_text(articles: DataFrame) -> DataFrame:
    """(wid, text, links) of articles with non-empty text. Spans stay an array;
    the link's true ``end`` is carried."""
    return (articles.where(is_article() & (F.length("wikiText") > 0))
            .select("wid", F.col("wikiText").alias("text"), "links"))


def link_facts(articles: DataFrame) -> DataFrame:
    """(wid, sf, uri) per link of an article, zero spans (start = end = 0) dropped."""
    ex = articles.where(is_article()).select("wid", F.explode("links").alias("l"))
    return (ex.where(~((F.col("l.start") == 0) & (F.col("l.end") == 0)))
            .select("wid", F.col("l.description").alias("sf"), F.col("l.id").alias("uri")))


def page_links(articles: DataFrame) -> DataFrame:
    """All links of articles with their position, zero spans included:
    (wid, pos, sf, uri, start, end)."""
    return (articles.where(is_article()).select("wid", F.posexplode("links").alias("pos", "l"))
            .select("wid", F.col("pos").cast("long").alias("pos"), F.col("l.description").alias("sf"),
                    F.col("l.id").alias("uri"), F.col("l.start").alias("start"), F.col("l.end").alias("end")))


def surface_forms(articles: DataFrame) -> DataFrame:
    """P5: distinct anchor texts of articles (zero-span links included)."""
    return (articles.where(is_article()).select(F.explode("links.description").alias("sf"))
            .where(F.col("sf").isNotNull()).distinct())


def uri_paragraphs(articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct (uri, para_key) pairs from ``paragraphsLink``; the paragraph text is
    kept once per key in a separate relation so shuffles move 32-byte keys."""
    p = articles.select(F.explode("paragraphsLink").alias("p"))
    p = p.select(F.col("p.paraText").alias("para"), F.col("p.links.id").alias("ids"))
    keyed = p.select(F.sha2("para", 256).alias("para_key"), "para", "ids")
    pairs = keyed.select(F.explode("ids").alias("uri"), "para_key").where(F.col("uri").isNotNull()).distinct()
    texts = keyed.select("para_key", "para").distinct()
    return pairs, texts
