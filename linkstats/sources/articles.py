"""Article sources: XML dumps (S1), JSON lines (S2), corrupt-record handling (S3).

Both readers take an explicit schema (no inference pass over the corpus) and return the
article table of ``linkstats.schema.ARTICLE``. Corrupt input is kept aside, never
silently turned into null rows that later filters would drop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkstats import schema as S
from linkstats.session import materialize
from linkstats.sources import wikitext as wt

# Layout of one <page> element of a wiki dump (record tag "page").
XML_PAGE = T.StructType([
    T.StructField("ns", T.LongType()),
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("redirect", T.StructType([T.StructField("_title", T.StringType())])),
    T.StructField("revision", T.StructType([T.StructField("text", T.StringType())])),
    T.StructField("_corrupt_record", T.StringType()),
])


def read_xml_pages(spark: SparkSession, path: str) -> DataFrame:
    """One record per ``<page>``; Spark's XML source splits the file itself. A page that
    does not parse keeps its raw text in ``_corrupt_record``."""
    return (spark.read.format("xml").option("rowTag", "page").schema(XML_PAGE)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").load(path))


def xml_to_articles(pages: DataFrame) -> DataFrame:
    """Wiki pages -> article table and ``_corrupt_record``: the type from the redirect element
    and the namespace (0, or none given, holds the articles), wiki markup turned into plain
    text with link spans and paragraphs (P9)."""
    base = pages.select(
        F.col("id").alias("wid"), F.col("title").alias("wikiTitle"), "ns",
        F.col("redirect._title").alias("redirect"), F.col("revision.text").alias("markup"), "_corrupt_record")
    parsed = wt.parse_markup(base, "markup")
    kind = (F.when(F.col("redirect").isNotNull(), F.lit(S.REDIRECT_TYPE))
            .when(F.coalesce("ns", F.lit(0)) == 0, F.lit(S.ARTICLE_TYPE)).otherwise(F.lit(S.OTHER_TYPE)))
    return parsed.select("wid", "wikiTitle", kind.alias("type"), "redirect", F.col("plain").alias("wikiText"),
                         "links", "paragraphsLink", "_corrupt_record")


def read_xml_articles(spark: SparkSession, path: str) -> DataFrame:
    return xml_to_articles(read_xml_pages(spark, path))


def read_json_articles(spark: SparkSession, path: str) -> DataFrame:
    """S2 + S3: JSON lines with the fixed schema, PERMISSIVE; a line that does not parse
    keeps its raw text in ``_corrupt_record`` (all other columns null)."""
    return (spark.read.schema(S.ARTICLE_WITH_CORRUPT)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
            .json(path))


def good_articles(articles: DataFrame) -> DataFrame:
    """The rows that parsed, in the article schema."""
    if "_corrupt_record" not in articles.columns:
        return articles
    return articles.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def split_corrupt(articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows in the article schema, quarantined rows: wid, wikiTitle, _corrupt_record).
    Parsed and written once, so that both sides judge a row by all of its columns."""
    if "_corrupt_record" not in articles.columns:
        return articles, articles.sparkSession.createDataFrame([], "wid long, wikiTitle string, _corrupt_record string")
    articles = materialize(articles, "parsed")
    return good_articles(articles), articles.where(F.col("_corrupt_record").isNotNull()).select("wid", "wikiTitle", "_corrupt_record")


def json_status(df: DataFrame, col: str) -> DataFrame:
    """Per row: 'null', 'ok' (a JSON object) or 'corrupt' (anything else)."""
    c = F.col(col)
    return df.select(F.when(c.isNull(), F.lit("null"))
                     .when(F.json_object_keys(c).isNotNull(), F.lit("ok"))
                     .otherwise(F.lit("corrupt")).alias("status"))
