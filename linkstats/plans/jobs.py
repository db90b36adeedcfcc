"""End-to-end jobs over the article table.

    build_stats(articles)            -> {uri_counts, pair_counts, total_sf_counts, token_counts}
    run_stats(articles, out)         -> the same, written; intermediate tables are deleted
    stats_from_xml / stats_from_json -> the same over a dump or a JSON-lines corpus
    export_corpus                    -> XML dump to JSON lines
    annotate_corpus                  -> article text with spots replaced by entity URIs

Every output is a lazy DataFrame. The source is parsed once: the article table, and of what
several outputs share the link facts and spots, are written under the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkstats import session as sess
from linkstats.functions import uris as ur
from linkstats.operators import context as cx
from linkstats.operators import counts as ct
from linkstats.operators import extract as ex
from linkstats.operators import redirects as rd
from linkstats.operators import rewrite as rw
from linkstats.operators import spotting as sp
from linkstats.sources import articles as src
from linkstats.sources import sinks
from linkstats.sources import stopwords as sw

STAT_TABLES = ("uri_counts", "pair_counts", "total_sf_counts", "token_counts")


def build_stats(articles: DataFrame, stop_words: DataFrame | None = None, lang: str = "en",
                weight: str = "occurrences", resolve_links: bool = False,
                encode_uris: bool = False, dedupe_lowercase: bool = False,
                host: str = ur.DEFAULT_RESOURCE_HOST, top_k: int | None = None,
                algorithm: str = "s", steps: sess.Steps | None = None) -> dict[str, DataFrame]:
    """The four statistics tables from an article table (schema §1.2).

    Options: ``weight`` ("occurrences" = the reference's link x spot join rows, "links" =
    link count); ``resolve_links`` maps link ids through the redirects before counting;
    ``encode_uris`` outputs resource URIs instead of raw ids; ``dedupe_lowercase`` keeps
    one lower-case phantom per form; ``algorithm`` is the stemmer; ``steps`` names a folder
    of finished steps to go on from (else the steps are scratch tables of this run).
    """
    def step(name, build):
        return steps.table(name, build) if steps else sess.materialize(build(), name)

    given = articles
    articles = src.good_articles(step("articles", lambda: given))
    resolved = step("redirects", lambda: rd.resolve(ex.redirect_edges(articles)))

    def facts():
        lf = ex.link_facts(articles)
        return rd.resolve_targets(lf, resolved).select("wid", "sf", F.col("target").alias("uri")) if resolve_links else lf
    lf = step("link_facts", facts)
    texts = ex.article_text(articles).select("wid", "text")
    spots = step("spots", lambda: sp.spot_surface_forms(texts, ex.surface_forms(articles)))

    pairs = ct.pair_counts(lf, spots, resolved, weight)
    uris = ct.uri_counts_from_pairs(pairs)
    if encode_uris:
        # ids that encode alike are one uri: encode, then add up again
        pairs = (pairs.withColumn("uri", ur.resource_uri(F.col("uri"), lang, host))
                 .groupBy("sf", "uri").agg(F.sum("n").cast("long").alias("n")))
        uris = ct.uri_counts_from_pairs(pairs)
    totals = ct.total_sf_counts(lf, spots, dedupe_lowercase)

    pair_keys, paragraphs = ex.uri_paragraphs(articles)
    stops = stop_words if stop_words is not None else sw.default_stop_words(articles.sparkSession)
    vectors = cx.context_vectors(pair_keys, paragraphs, stops, algorithm=algorithm, lang=lang, top_k=top_k)
    return {"uri_counts": uris, "pair_counts": pairs.select("sf", "uri", "n"),
            "total_sf_counts": totals, "token_counts": vectors}


def write_stats(stats: dict[str, DataFrame], out: str, fmt: str = "tsv") -> None:
    """One folder per table under ``out`` (UriCounts, PairCounts, ...)."""
    names = {"uri_counts": "UriCounts", "pair_counts": "PairCounts",
             "total_sf_counts": "TotalSfCounts", "token_counts": "TokenCounts"}
    for key, df in stats.items():
        path = sinks.out_path(out, names.get(key, key))
        (sinks.write_tsv if fmt == "tsv" else sinks.write_parquet)(df, path)


def run_stats(articles: DataFrame, out: str, fmt: str = "tsv", resume: str | None = None, source: str = "", **options) -> None:
    """W1/W2 as a whole: the four tables under ``out`` and nothing else left behind.

    With ``resume``, a shared folder, a run that failed is taken up by the next one with the
    same ``source`` (the name and state of the input) and options behind its last written
    step; the steps are deleted when the outputs are written.
    """
    spark = articles.sparkSession
    stops = options.get("stop_words")
    known = {k: v for k, v in options.items() if k != "stop_words"}
    if stops is not None:  # the list's content, not its plan, tells jobs apart
        known["stop_words"] = stops.agg(F.sum(F.xxhash64("word").cast("decimal(38,0)"))).first()[0]
    steps = sess.Steps(spark, resume, repr((source, out, fmt, sorted(known.items())))) if resume else None
    with sess.scratch_tables(spark):
        stats = build_stats(articles, steps=steps, **options)
        if steps:
            stats = {name: steps.table(name, lambda df=df: df) for name, df in stats.items()}
        write_stats(stats, out, fmt)
    if steps:
        steps.forget()


def stats_from_xml(spark: SparkSession, dump: str, **options) -> dict[str, DataFrame]:
    """Statistics from an XML dump; pages that do not parse are left out."""
    return build_stats(src.read_xml_articles(spark, dump), **options)


def stats_from_json(spark: SparkSession, corpus: str, **options) -> dict[str, DataFrame]:
    """Statistics from JSON lines; corrupt lines are left out (``split_corrupt``)."""
    return build_stats(src.read_json_articles(spark, corpus), **options)


def export_corpus(spark: SparkSession, dump: str, out: str) -> None:
    """XML dump -> article JSON lines."""
    sinks.write_json_lines(src.good_articles(src.read_xml_articles(spark, dump)), out)


def annotate_corpus(articles: DataFrame, lang: str = "en", host: str = ur.DEFAULT_RESOURCE_HOST) -> DataFrame:
    """(wid, text) with every page-linked spot replaced by its entity URI.
    The source is parsed once."""
    articles = src.good_articles(sess.materialize(articles, "articles"))
    texts = ex.article_text(articles).select("wid", "text")
    linked = sp.spot_linked(texts, ex.page_links(articles))
    resolved = rd.resolve(ex.redirect_edges(articles))
    return rw.rewrite_text(texts, linked, resolved, lang, host)
