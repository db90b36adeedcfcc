"""Line dedup with range-partitioned line hashes; built from DataFrame functions only.

A line's key is the line with ``[\\x20\\x09-\\x0D]`` stripped at both ends and A-Z lower-cased.
Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents lose all
their lines except in the largest doc_id that holds them.

(hash, doc_id) rows are range-partitioned by hash *and* document and sorted within, so a key
that holds a third of all lines lies in many neighbouring partitions. Each partition streams
its run of a key down to one row per document; counts and last documents are then combined
per key from partial aggregates. Decisions travel as keep bitmaps: for a document with drops,
the 64-line words that drop something, with a set bit for every line that stays.

Defined results: a null or empty text is one empty line; rows that repeat a doc_id are one
document when counting, each row keeps its own bitmap, and equal rows get equal results; a
null doc_id is a document that sorts before all others; other columns are ignored, whatever
their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkstats.llm.common import SPACES, lower_ascii, same, shuffle_width, table, text_of
from linkstats.session import materialize

MIN_CHARS, MIN_DOCS = 20, 3


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))


def line_postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, at): for each key and document the (row, line) places, range-sorted."""
    line = F.btrim(F.col("line"), F.lit(SPACES))
    lines = (_rows(docs, id_col, text_col)
             .select("doc_id", "row", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
             .select("doc_id", "row", "pos", line.alias("line"))
             .where(F.length("line") >= min_chars)
             .select("doc_id", "row", "pos", lower_ascii(F.col("line")).alias("key"))
             .select("doc_id", "row", "pos", F.xxhash64("key").alias("h1"),
                     F.xxhash64(F.lit("second"), F.col("key")).alias("h2")))
    ranged = (lines.repartitionByRange(shuffle_width(docs.sparkSession), "h1", "h2", "doc_id")
              .sortWithinPartitions("h1", "h2", F.desc("doc_id"), "row", "pos"))
    return ranged.groupBy("h1", "h2", "doc_id").agg(F.collect_list(F.struct("row", "pos")).alias("at"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, row, words): for each row that loses lines its sparse keep bitmap, ``words``
    an array of (word, keep); lines 64 * word + i with bit i unset go. ``row`` is the
    xxhash64 of the text, which tells rows of one doc_id apart."""
    postings = materialize(line_postings(docs, id_col, text_col, min_chars), "line_postings")
    keys = (postings.groupBy("h1", "h2")
            .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id")).alias("last"))
            .where(F.col("n") >= min_docs).select("h1", "h2", F.col("last.doc_id").alias("keep_id")))
    keys = materialize(keys, "line_keys")
    dropped = (postings.join(keys.hint("merge"), ["h1", "h2"])  # shuffled on both sides: AQE splits a hot key
               .where(~same(F.col("doc_id"), F.col("keep_id")))
               .select("doc_id", F.explode("at").alias("a")).select("doc_id", "a.row", "a.pos"))
    words = (dropped.groupBy("doc_id", "row", F.expr("cast(pos div 64 as int)").alias("word"))
             .agg(F.expr("~bit_or(shiftleft(1L, pos % 64))").alias("keep")))
    return words.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list(F.struct("word", "keep"))).alias("words"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): the texts with the lines of the bitmaps taken out."""
    rows = _rows(docs, id_col, text_col)
    b = bitmaps.select(F.col("doc_id").alias("b_id"), F.col("row").alias("b_row"), "words")
    joined = rows.join(b, same(rows["doc_id"], b["b_id"]) & (rows["row"] == b["b_row"]), "left")
    # The map and the dense bitmap are bound by lambdas, so each is built once for a text.
    dense = F.expr("get(transform(array(map_from_entries(words)), m -> transform(sequence(0, (size(lines) - 1) div 64), "
                   "w -> coalesce(m[cast(w as int)], -1L))), 0)")
    out = joined.select("doc_id", "text", "words", F.split("text", "\n", -1).alias("lines"))
    out = out.withColumn("keep", F.when(F.col("words").isNotNull(), dense))
    kept = F.expr("get(transform(array(keep), k -> array_join(filter(lines, (x, i) -> "
                  "(shiftrightunsigned(k[cast(i div 64 as int)], cast(i % 64 as int)) & 1L) = 1L), '\n')), 0)")
    return out.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                      F.expr("coalesce(aggregate(words, 0L, (s, w) -> s + bit_count(~w.keep)), 0L)").alias("n_dropped"),
                      F.when(F.col("words").isNull(), F.col("text")).otherwise(kept).alias("kept"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return apply_bitmaps(docs, keep_bitmaps(docs)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
g AS (
  SELECT key, max(doc_id) AS keep_id FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (
  SELECT k.doc_id, k.pos, k.line, (g.key IS NOT NULL AND k.doc_id <> g.keep_id) AS dropped
  FROM k LEFT JOIN g ON k.key = g.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
