"""Registered queries over the driver's tables: name -> fn(spark, sf_dir) -> DataFrame.

Each query reads whole tables (pages, documents, part, events) and runs one of the
library's jobs; column names match the oracle SQL in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkstats.functions import uris as ur
from linkstats.operators import context as cx
from linkstats.operators import counts as ct
from linkstats.operators import extract as ex
from linkstats.operators import quality as qa
from linkstats.operators import redirects as rd
from linkstats.operators import rewrite as rw
from linkstats.operators import spotting as sp
from linkstats.operators import tokens as tk
from linkstats.operators.vocabulary_store import VocabularyStore
from linkstats.plans import jobs
from linkstats.sources import articles as src_articles
from linkstats.sources import pages as pg
from linkstats.sources import sinks
from linkstats.sources import stopwords as sw
from linkstats.streaming import link_counts as stream
from linkstats.session import materialize, scratch_path

CONTEXT_TOP_K = 10


class Tables:
    """Handles on the driver tables of one sf folder and the adapter relations.

    The page table (one html parse per page) is written once per instance and every
    page-derived relation reads it, as the reference persists its parsed corpus. The
    paragraphs (another copy of the text) are a separate table, built only by the jobs
    that read them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, with_text: bool = True):
        self.spark, self.with_text = spark, with_text
        self.sf_dir = sf_dir.rstrip("/")
        self._pt: DataFrame | None = None
        self._paras: DataFrame | None = None
        self._heads: DataFrame | None = None
        self._whole: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def pt(self) -> DataFrame:
        if self._pt is None:
            self._pt = materialize(pg.page_table(self.table("pages"), with_paragraphs=False, with_text=self.with_text,
                                                 with_links=True), "page_table")
        return self._pt

    @property
    def heads(self) -> DataFrame:
        """(wid, url, h1): the narrow parse the context jobs need beside the paragraphs."""
        if self._heads is None:
            self._heads = materialize(pg.page_table(self.table("pages"), with_paragraphs=False, with_text=False), "page_heads")
        return self._heads

    def whole_typed(self) -> DataFrame:
        """The article schema with ``paragraphsLink``, which the statistics job reads."""
        if self._whole is None:
            self._whole = materialize(pg.page_table(self.table("pages"), with_paragraphs=False,
                                                    with_paragraph_links=True), "page_table_whole")
        return pg.typed_pages(self._whole)

    def articles(self) -> DataFrame:
        return pg.articles(self.pt)

    def links(self) -> DataFrame:
        return pg.links(self.pt)

    def typed(self) -> DataFrame:
        return pg.typed_pages(self.pt)

    def titles(self) -> DataFrame:
        """From the page table when it exists, else from the narrow parse."""
        return pg.titles(self._pt if self._pt is not None else self.heads)

    def paragraphs(self) -> DataFrame:
        """Distinct paragraphs, written once: spotting and token counting both read them. The
        text of the pages is not written beside them: the headings have a parse of their own."""
        if self._paras is None:
            parsed = pg.page_table(self.table("pages"), with_paragraphs=True, with_text=False)
            self._paras = materialize(pg.paragraphs(parsed), "paragraphs")
        return self._paras

    def link_facts(self) -> DataFrame:
        return ex.link_facts(self.typed())

    def redirects(self) -> DataFrame:
        return ex.redirect_edges(self.typed())

    def resolved(self) -> DataFrame:
        return rd.resolve(self.redirects())

    def texts(self) -> DataFrame:
        """Article texts as the reference spots them: non-empty text only."""
        return self.articles().where(F.length("text") > 0).select("wid", "text")

    def documents(self) -> DataFrame:
        return self.table("documents").select(F.col("doc_id").alias("wid"), "text")

    def anchor_spots(self) -> DataFrame:
        """All spots of the anchor dictionary in article text: (wid, sf, offset)."""
        return sp.spot_surface_forms(self.texts(), self.links().select("sf"))

    def title_spots_in_paragraphs(self) -> DataFrame:
        d = sp.build_dictionary(self.titles().select("sf"))
        return sp.spot(self.paragraphs(), d, id_col="para_key", text_col="para")

    def uri_paragraphs(self) -> cx.KeyedParagraphs:
        titles = self.titles().select("uri", sp.entry_key(F.col("sf")).alias("key"))
        return cx.KeyedParagraphs(titles, self.title_spots_in_paragraphs().select("key", "para_key").distinct())


# Queries that read no page text: their page table is written without it.
LINK_ONLY = {"redirect_edges", "extract_links", "link_facts", "surface_forms", "sf_vocabulary", "vocab_stats", "vocab_reverse_lookup",
             "pair_link_counts", "uri_link_counts", "sf_annotated_counts", "resolve_redirects", "resolved_redirect_map",
             "resolve_link_targets", "uri_normalize", "tsv_uri_counts", "json_export_link_facts", "quarantined_rows", "xml_article_text",
             "xml_links", "xml_redirect_edges", "xml_job_pair_counts", "xml_export_link_facts", "dq_empty_sf", "dq_redirect_count",
             "dq_redirect_terminal"}


def _q(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Tables(spark, sf_dir, with_text=fn.__name__ not in LINK_ONLY))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# ---- scans, projections, extraction -------------------------------------------------

def article_filter(t: Tables) -> DataFrame:
    a = ex.article_pages(t.typed())
    return a.select("wid", F.col("wikiTitle").alias("title"),
                    F.length("wikiText").cast("long").alias("text_chars"),
                    F.size("links").cast("long").alias("n_links"))


def redirect_edges(t: Tables) -> DataFrame:
    return ex.redirect_edges(t.typed())


def article_text(t: Tables) -> DataFrame:
    a = ex.article_text(t.typed())
    return a.select("wid", F.length("text").cast("long").alias("text_chars"),
                    F.size("links").cast("long").alias("n_spans"))


def extract_links(t: Tables) -> DataFrame:
    return t.links()


def link_facts(t: Tables) -> DataFrame:
    return t.link_facts()


def surface_forms(t: Tables) -> DataFrame:
    return ex.surface_forms(t.typed())


def sf_vocabulary(t: Tables) -> DataFrame:
    return tk.vocabulary(ex.surface_forms(t.typed()))


def vocab_stats(t: Tables) -> DataFrame:
    return tk.vocabulary_stats(tk.vocabulary(ex.surface_forms(t.typed())))


def token_lookup(t: Tables) -> DataFrame:
    """Article words looked up in the anchor vocabulary (UNKNOWN = id 0), per page."""
    vocab = tk.vocabulary(ex.surface_forms(t.typed()))
    words = tk.tokenize_offsets(t.texts())
    looked = tk.lookup_tokens(words, vocab)
    return looked.groupBy("wid").agg(F.count(F.lit(1)).alias("n_tokens"),
                                     F.sum(F.when(F.col("token_id") == 0, 1).otherwise(0)).cast("long").alias("n_unknown"))


def vocab_reverse_lookup(t: Tables) -> DataFrame:
    """P11, id -> token: a stored vocabulary of the headings, reopened to add the anchors'
    tokens, asked for the ids of all parts (many of them unknown)."""
    path = scratch_path(t.spark, "vocabulary")
    for forms in (t.titles().select("sf").distinct(), ex.surface_forms(t.typed())):
        VocabularyStore(t.spark, path).add(tk.vocabulary(forms).select("token", "count"))
    ids = t.table("part").select(F.col("p_partkey").cast("long").alias("token_id"))
    return VocabularyStore(t.spark, path).tokens_of(ids)


def strip_markup(t: Tables) -> DataFrame:
    return t.articles()


def tokenize_offsets(t: Tables) -> DataFrame:
    return tk.tokenize_offsets(t.documents())


def tokenize_long_texts(t: Tables) -> DataFrame:
    """T1 with every document of more than 2,000 code points tokenised in chunks."""
    return tk.tokenize_offsets(t.documents(), long_text=2000)


# ---- spotting -----------------------------------------------------------------------

def spot_single(t: Tables) -> DataFrame:
    """Anchor dictionary (single words) spotted in every document."""
    return sp.spot_surface_forms(t.documents(), t.links().select("sf"))


def spot_multi(t: Tables) -> DataFrame:
    """Dictionary of whole headings spotted in every page text."""
    return sp.spot_surface_forms(t.texts(), t.titles().select("sf"))


def spot_long_texts(t: Tables) -> DataFrame:
    """Headings spotted in page texts that are tokenised in chunks of 500 code points."""
    return sp.spot(t.texts(), sp.build_dictionary(t.titles().select("sf")), long_text=500).select("wid", "sf", "offset")


def spot_with_links(t: Tables) -> DataFrame:
    """M1 with the pages' own link spans among the occurrences."""
    return sp.with_link_spans(t.anchor_spots(), t.links())


def spot_beside_links(t: Tables) -> DataFrame:
    """As spot_with_links, without the spots that overlap one of the page's links."""
    return sp.with_link_spans(t.anchor_spots(), t.links(), overlaps=False)


def spot_headings_apart(t: Tables) -> DataFrame:
    """M2's choice among the spots of all headings: leftmost, then longest, none overlapping."""
    return sp.leftmost_longest(sp.spot_surface_forms(t.texts(), t.titles().select("sf")))


def spot_linked(t: Tables) -> DataFrame:
    return sp.spot_linked(t.texts(), t.links())


# ---- joins and counts ---------------------------------------------------------------

def link_spot_join(t: Tables) -> DataFrame:
    return ct.link_spot_join(t.link_facts(), t.anchor_spots())


def pair_link_counts(t: Tables) -> DataFrame:
    return ct.pair_counts(t.link_facts(), weight="links")


def uri_link_counts(t: Tables) -> DataFrame:
    return ct.uri_counts(t.link_facts(), weight="links")


def pair_counts(t: Tables) -> DataFrame:
    return ct.pair_counts(t.link_facts(), t.anchor_spots(), t.resolved())


def uri_counts(t: Tables) -> DataFrame:
    return ct.uri_counts_from_pairs(ct.pair_counts(t.link_facts(), t.anchor_spots(), t.resolved()))


def sf_annotated_counts(t: Tables) -> DataFrame:
    return ct.sf_annotated_counts(t.link_facts())


def sf_spotted_counts(t: Tables) -> DataFrame:
    return ct.sf_spotted_counts(t.anchor_spots())


def total_sf_counts(t: Tables) -> DataFrame:
    return ct.total_sf_counts(t.link_facts(), t.anchor_spots())


def lowercase_phantoms(t: Tables) -> DataFrame:
    return ct.lowercase_phantoms(ct.annotated_with_totals(t.link_facts(), t.anchor_spots()))


# ---- redirects ----------------------------------------------------------------------

def resolve_redirects(t: Tables) -> DataFrame:
    return rd.resolve_final_first(t.redirects())


def resolved_redirect_map(t: Tables) -> DataFrame:
    return t.resolved()


def resolve_link_targets(t: Tables) -> DataFrame:
    return rd.resolve_targets(t.link_facts(), t.resolved()).select("wid", "sf", "uri", "target")


def resolve_redirects_cyclic(t: Tables) -> DataFrame:
    return rd.resolve_final_first(pg.cyclic_redirects(t.table("part")))


def resolve_redirects_doubling(t: Tables) -> DataFrame:
    """The cyclic graph resolved by pointer doubling (O(log walk) rounds)."""
    return rd.resolve(pg.cyclic_redirects(t.table("part"))).select("final", "title")


# ---- context vectors ----------------------------------------------------------------

def uri_paragraphs(t: Tables) -> DataFrame:
    return t.uri_paragraphs().pairs()


def stem_vocabulary(t: Tables) -> DataFrame:
    return cx.stem_vocabulary(t.paragraphs())


def stem_vocabulary_porter(t: Tables) -> DataFrame:
    """Porter (1980) stems of every distinct paragraph word."""
    return cx.stem_vocabulary(t.paragraphs(), algorithm="porter")


def stem_vocabulary_by_language(t: Tables) -> DataFrame:
    """Every distinct word of the documents, stemmed in its document's language."""
    return cx.stem_vocabulary_by_language(t.table("documents"))


def context_vectors_porter(t: Tables) -> DataFrame:
    return cx.context_vectors(t.uri_paragraphs(), t.paragraphs(), sw.default_stop_words(t.spark),
                              algorithm="porter")


def token_counts(t: Tables) -> DataFrame:
    return cx.token_counts(t.uri_paragraphs(), t.paragraphs(), sw.default_stop_words(t.spark))


def context_vectors(t: Tables) -> DataFrame:
    return cx.context_vectors(t.uri_paragraphs(), t.paragraphs(), sw.default_stop_words(t.spark))


def context_vector_chunks(t: Tables) -> DataFrame:
    """The context vectors in chunks of 25 entries."""
    return cx.context_vector_chunks(t.uri_paragraphs(), t.paragraphs(), sw.default_stop_words(t.spark), size=25)


def stop_list_file_vectors(t: Tables) -> DataFrame:
    """The context vectors with a stop list written as a text file and read back."""
    path = scratch_path(t.spark, "stop_words")
    words = sw.default_stop_words(t.spark)
    words.select(F.concat(F.lit(" "), "word", F.lit(" ")).alias("word")).union(words).write.text(path)
    return cx.context_vectors(t.uri_paragraphs(), t.paragraphs(), sw.read_stop_words(t.spark, path))


def context_vectors_topk(t: Tables) -> DataFrame:
    return cx.context_vectors(t.uri_paragraphs(), t.paragraphs(), sw.default_stop_words(t.spark),
                              top_k=CONTEXT_TOP_K)


# ---- rewrite, normalisation, corrupt records ---------------------------------------

def rewrite_text(t: Tables) -> DataFrame:
    return rw.rewrite_text(t.texts(), sp.spot_linked(t.texts(), t.links()), t.resolved())


def uri_normalize(t: Tables) -> DataFrame:
    ids = (t.table("pages").select(F.col("url").alias("id"))
           .unionByName(t.links().select(F.col("uri").alias("id"))).distinct())
    return ids.select("id", ur.resource_uri(F.col("id")).alias("resource_uri"),
                      ur.wiki_url(F.col("id")).alias("wiki_url"))


def quarantine_corrupt(t: Tables) -> DataFrame:
    ev = src_articles.json_status(t.table("events"), "props").withColumn("source", F.lit("events.props"))
    dc = src_articles.json_status(t.table("documents"), "text").withColumn("source", F.lit("documents.text"))
    return (ev.unionByName(dc).groupBy("source", "status")
            .agg(F.count(F.lit(1)).alias("n")))


# ---- end-to-end job ------------------------------------------------------------------

def stats_job_pair_counts(t: Tables) -> DataFrame:
    """W1 over the pages in the article schema: the job's pair counts table."""
    return jobs.build_stats(t.typed())["pair_counts"]


def stats_job_uri_counts(t: Tables) -> DataFrame:
    return jobs.build_stats(t.typed())["uri_counts"]


def stats_job_total_sf_counts(t: Tables) -> DataFrame:
    return jobs.build_stats(t.typed())["total_sf_counts"]


def stats_job_token_counts(t: Tables) -> DataFrame:
    """W1's token table: context vectors over the paragraphs that link to each uri."""
    return jobs.build_stats(t.whole_typed())["token_counts"]


def stats_job_token_counts_porter(t: Tables) -> DataFrame:
    return jobs.build_stats(t.whole_typed(), algorithm="porter")["token_counts"]


def article_uri_paragraphs(t: Tables) -> DataFrame:
    """P7 over ``paragraphsLink``."""
    return ex.uri_paragraphs(t.whole_typed())[0]


def annotate_job(t: Tables) -> DataFrame:
    """W4 over the pages in the article schema."""
    return jobs.annotate_corpus(t.typed())


def _exported(t: Tables) -> str:
    path = scratch_path(t.spark, "corpus_json")
    sinks.write_json_lines(t.typed(), path)
    return path


def quarantined_rows(t: Tables) -> DataFrame:
    """S3: the exported corpus with every line of the documents among its lines, split into
    good rows and quarantined lines; returns the latter with their numbers."""
    path = scratch_path(t.spark, "corpus_with_bad_lines")
    lines = t.table("documents").select(F.explode(F.split("text", "\n")).alias("value"))
    t.spark.read.text(_exported(t)).union(lines).write.text(path)
    good, bad = src_articles.split_corrupt(src_articles.read_json_articles(t.spark, path))
    return bad.groupBy(F.col("_corrupt_record").alias("line")).agg(F.count(F.lit(1)).alias("n"))


def _dump(t: Tables) -> str:
    """The pages as an XML dump of wiki markup, with a redirect page for each redirect."""
    path = scratch_path(t.spark, "dump_xml")
    pg.wiki_dump(t.pt, t.redirects()).write.format("xml").option("rootTag", "mediawiki").option("rowTag", "page").save(path)
    return path


def xml_article_text(t: Tables) -> DataFrame:
    """Text and number of links of the articles of the dump."""
    a = ex.article_pages(src_articles.read_xml_articles(t.spark, _dump(t)))
    return a.select("wid", F.col("wikiText").alias("text"), F.size("links").cast("long").alias("n_links"))


def xml_links(t: Tables) -> DataFrame:
    """The links of the dump's articles and the text that their spans cover."""
    a = src_articles.read_xml_articles(t.spark, _dump(t))
    links = ex.page_links(a).join(a.select("wid", "wikiText"), "wid")
    covered = F.substring("wikiText", F.col("start").cast("int") + 1, (F.col("end") - F.col("start")).cast("int"))
    return links.select("wid", "pos", "sf", "uri", covered.alias("covered"))


def xml_redirect_edges(t: Tables) -> DataFrame:
    """P2 over the dump."""
    return ex.redirect_edges(src_articles.read_xml_articles(t.spark, _dump(t)))


def xml_job_pair_counts(t: Tables) -> DataFrame:
    """W1 over the dump."""
    return jobs.stats_from_xml(t.spark, _dump(t))["pair_counts"]


def xml_export_link_facts(t: Tables) -> DataFrame:
    """The dump exported as JSON lines and read back."""
    path = scratch_path(t.spark, "corpus_json")
    jobs.export_corpus(t.spark, _dump(t), path)
    return ex.link_facts(src_articles.good_articles(src_articles.read_json_articles(t.spark, path)))


def annotated_corpus_table(t: Tables) -> DataFrame:
    """The annotated corpus written as Parquet and read back."""
    path = scratch_path(t.spark, "annotated")
    sinks.write_parquet(jobs.annotate_corpus(t.typed()), path)
    return t.spark.read.parquet(path)


def json_export_link_facts(t: Tables) -> DataFrame:
    """S4, then S2: link facts of the corpus exported as JSON lines and read back."""
    return ex.link_facts(src_articles.good_articles(src_articles.read_json_articles(t.spark, _exported(t))))


def json_job_pair_counts(t: Tables) -> DataFrame:
    """W2 over the exported corpus."""
    return jobs.stats_from_json(t.spark, _exported(t))["pair_counts"]


def tsv_uri_counts(t: Tables) -> DataFrame:
    """Uri link counts written as TSV and read back."""
    path = scratch_path(t.spark, "uri_counts_tsv")
    sinks.write_tsv(uri_link_counts(t), path)
    return t.spark.read.option("sep", "\t").schema("uri string, n bigint").csv(path)


# ---- streaming ----------------------------------------------------------------------

def stream_pair_link_counts(t: Tables) -> DataFrame:
    """pair_link_counts maintained incrementally by a Structured Streaming query."""
    return stream.stream_pair_link_counts(t.spark, f"{t.sf_dir}/pages.parquet")


# ---- data-quality checks ------------------------------------------------------------

def dq_empty_sf(t: Tables) -> DataFrame:
    return qa.empty_surface_forms(ex.surface_forms(t.typed()))


def dq_redirect_count(t: Tables) -> DataFrame:
    return qa.redirect_count(ex.redirect_edges(t.typed()))


def dq_redirect_terminal(t: Tables) -> DataFrame:
    edges = t.redirects()
    return qa.redirect_terminal(rd.resolve(edges), edges)


def dq_annotated_total(t: Tables) -> DataFrame:
    lf = t.link_facts()
    return qa.annotated_total(ct.total_sf_counts(lf, t.anchor_spots()), lf)


def dq_spot_offsets(t: Tables) -> DataFrame:
    texts = t.texts()
    spots = t.anchor_spots().unionByName(sp.spot_surface_forms(texts, t.titles().select("sf")))
    return qa.spot_offsets(spots, texts)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: _q(f) for f in [
    article_filter, redirect_edges, article_text, extract_links, link_facts, surface_forms,
    sf_vocabulary, vocab_stats, token_lookup, vocab_reverse_lookup, strip_markup, tokenize_offsets,
    tokenize_long_texts, spot_single, spot_multi, spot_linked, spot_long_texts, spot_with_links, spot_beside_links, spot_headings_apart,
    link_spot_join, pair_link_counts, uri_link_counts, pair_counts, uri_counts,
    sf_annotated_counts, sf_spotted_counts, total_sf_counts, lowercase_phantoms,
    resolve_redirects, resolved_redirect_map, resolve_link_targets, resolve_redirects_cyclic,
    resolve_redirects_doubling,
    uri_paragraphs, stem_vocabulary, stem_vocabulary_porter, stem_vocabulary_by_language, token_counts, context_vectors,
    context_vectors_topk, context_vector_chunks, stop_list_file_vectors, context_vectors_porter,
    rewrite_text, uri_normalize, quarantine_corrupt, stats_job_pair_counts,
    stats_job_uri_counts, stats_job_total_sf_counts, stats_job_token_counts,
    stats_job_token_counts_porter, article_uri_paragraphs, annotate_job, json_export_link_facts,
    json_job_pair_counts, tsv_uri_counts, quarantined_rows, xml_article_text, xml_links, xml_redirect_edges, xml_job_pair_counts,
    xml_export_link_facts, annotated_corpus_table, stream_pair_link_counts,
    dq_empty_sf, dq_redirect_count, dq_redirect_terminal, dq_annotated_total, dq_spot_offsets,
]}
