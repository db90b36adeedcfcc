"""Tokenising with offsets (T1), the surface-form vocabulary (P6) and its statistics.

Offsets are Unicode code points from 0, as Spark's ``length``/``substring`` count them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkstats.functions import text as tx
from linkstats.session import checked_broadcast, materialize


def _exploded(t: DataFrame, keep: list[str], look_words: int) -> DataFrame:
    """(keep, pos, piece, offset[, look]) of the words of ``ps``, an array of pieces whose
    first is a word where ``_w`` holds; ``_next`` holds the pieces behind the last one."""
    t = t.withColumn("at", tx.starts(F.col("ps")))
    ahead = 2 * look_words - 1
    # element k of the zip holds pieces k, k + 1, ...; pieces alternate word / separator
    shifted = [F.slice(F.concat("ps", "_next") if "_next" in t.columns else F.col("ps"), k + 1, F.size("ps")).alias(f"p{k}")
               for k in range(1, ahead)]
    t = t.select(*keep, "_w", F.posexplode(F.arrays_zip(F.col("ps").alias("ps"), F.col("at").alias("at"), *shifted)).alias("pos", "x"))
    t = t.where((F.col("pos") % 2 == 0) == F.col("_w"))
    look = [F.array(*[F.col("x.ps")] + [F.col(f"x.p{k}") for k in range(1, ahead)]).alias("look")] if look_words else []
    return t.select(*keep, F.col("pos").cast("long").alias("pos"), F.col("x.ps").alias("piece"), F.col("x.at").alias("offset"),
                    F.floor(F.col("pos") / 2).cast("long").alias("tpos"), *look)


def _chunked(t: DataFrame, keep: list[str], look_words: int, chunk_chars: int) -> DataFrame:
    """Words of long texts (keep, text): (keep, pos, piece, offset, tpos[, look]).

    A text is cut by one pattern at ends of pieces, and its chunks are spread over the tasks.
    What lies before a chunk (code points, pieces, words) is a sum over one row for each chunk
    of its text; the pieces behind its end, for entries that cross it, are the heads of the
    chunks that follow.
    """
    pattern = rf"(?s).{{{chunk_chars}}}(?:{tx.WORD_PATTERN}+|{tx.NON_WORD_CHAR}++)?|.+"
    chunks = t.withColumn("_row", F.monotonically_increasing_id())
    chunks = chunks.select("_row", *keep, F.posexplode(F.regexp_extract_all("text", F.lit(pattern), 0)).alias("chunk", "text"))
    # written, so that the sums and the words see the same chunks; a long text is many files' rows
    chunks = materialize(chunks.repartition("_row", "chunk"), "text_chunks")
    cut = [tx.starts_with_word(F.col("text")).alias("_w"), tx.pieces(F.col("text")).alias("ps")]
    n, heads = F.size("ps"), max(2 * look_words - 2, 0)
    sizes = chunks.select("_row", "chunk", F.length("text").alias("chars"), *cut)
    sizes = sizes.select("_row", "chunk", "chars", n.alias("n"), F.floor((n + F.col("_w").cast("int")) / 2).alias("words"),
                         F.slice("ps", 1, max(heads, 1)).alias("head"))
    w = Window.partitionBy("_row").orderBy("chunk")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    none = F.array().cast("array<string>")
    following = [F.coalesce(F.lead("head", k).over(w), none) for k in range(1, heads + 1)]
    sums = sizes.select("_row", "chunk", *[F.coalesce(F.sum(c).over(before), F.lit(0)).cast("long").alias(f"_{c}")
                                           for c in ("chars", "n", "words")],
                        (F.slice(F.concat(*following), 1, heads) if following else none).alias("_next"))
    # the chunks meet their sums as text: their pieces are many times as large
    counts = ["_chars", "_n", "_words"]
    rows = chunks.join(sums, ["_row", "chunk"]).select(*keep, *counts, "_next", *cut)
    out = _exploded(rows, [*keep, *counts], look_words)
    return out.select(*keep, (F.col("_n") + F.col("pos")).alias("pos"), "piece", (F.col("_chars") + F.col("offset")).alias("offset"),
                      (F.col("_words") + F.col("tpos")).alias("tpos"), *(["look"] if look_words else []))


def text_words(texts: DataFrame, id_col: str = "wid", text_col: str = "text", look_words: int = 0,
               keep: tuple[str, ...] = (), long_text: int | None = None) -> DataFrame:
    """One row per word of each text: (id, pos, piece, tpos, offset[, look][, keep columns]).

    Narrow: a text is cut and its offsets are summed inside its own row, so no text is
    shuffled. ``pos`` counts pieces (words and separators); ``look`` (when ``look_words`` > 0)
    holds the pieces from here that so many words cover, null where the text ends before.
    With ``long_text``, texts of more code points than that, whose arrays would not fit a
    task, are tokenised in chunks of that many over many tasks, with the same rows; it costs
    one more pass over the texts' lengths.
    """
    columns = ["id", *keep, "pos", "piece", "tpos", "offset", *(["look"] if look_words else [])]
    t = texts.select(F.col(id_col).alias("id"), *keep, F.col(text_col).alias("text"))
    short = t.where(F.length("text").between(1, long_text) if long_text else F.length("text") > 0)
    short = short.select("id", *keep, tx.starts_with_word(F.col("text")).alias("_w"), tx.pieces(F.col("text")).alias("ps"))
    out = _exploded(short, ["id", *keep], look_words).select(*columns)
    if not long_text:
        return out
    long = t.where(F.length("text") > long_text)
    return out.unionByName(_chunked(long, ["id", *keep], look_words, long_text).select(*columns))


def tokenize_offsets(texts: DataFrame, id_col: str = "wid", text_col: str = "text", long_text: int | None = None) -> DataFrame:
    """(wid, tpos, token, offset) for every word; tpos counts words from 0."""
    p = text_words(texts, id_col, text_col, long_text=long_text)
    return p.select(F.col("id").alias(id_col), "tpos", F.col("piece").alias("token"), "offset")


def sf_tokens(surface_forms: DataFrame, sf_col: str = "sf") -> DataFrame:
    """Unstemmed tokens of the surface forms, with repetition: (sf, token)."""
    return surface_forms.select(F.col(sf_col).alias("sf"), F.explode(tx.words(F.col(sf_col))).alias("token"))


def with_dense_ids(df: DataFrame, order_col: str | Column, id_col: str = "token_id") -> DataFrame:
    """Attach consecutive ids 1..n in ``order_col`` order without a single-partition window.

    Range-partition and sort, number the rows inside each partition, and write them once
    with their partition and number; the offsets come from that table, so rows and counts
    cannot disagree. The per-partition count table has one row per partition, so
    broadcasting it is bounded by the partition count, not by the data.
    """
    # monotonically_increasing_id = partition index << 33 | row number within partition
    ranged = (df.repartitionByRange(order_col).sortWithinPartitions(order_col)
              .withColumn("_part", F.spark_partition_id().cast("long"))
              .withColumn("_local", F.monotonically_increasing_id()))
    ranged = materialize(ranged.withColumn("_local", F.col("_local") - F.shiftleft(F.col("_part"), 33)), "dense_ids")
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_base"))
    out = ranged.join(F.broadcast(offsets), "_part")
    return out.select(*[c for c in df.columns],
                      (F.col("_base") + F.col("_local") + 1).cast("long").alias(id_col))


def vocabulary(surface_forms: DataFrame, sf_col: str = "sf") -> DataFrame:
    """Distinct unstemmed tokens of all surface forms with ids from 1 in token order,
    and how often each token occurs across the (distinct) surface forms:
    (token, token_id, count)."""
    counts = sf_tokens(surface_forms, sf_col).groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    return with_dense_ids(counts, "token").select("token", "token_id", "count")


def lookup_tokens(tokens: DataFrame, vocab: DataFrame, token_col: str = "token") -> DataFrame:
    """P11 lookup: each token gets (token_id, count) from the vocabulary, or the UNKNOWN
    entry (id 0, count 0) when absent."""
    v = vocab.select(F.col("token").alias("_vt"), "token_id", F.col("count").alias("vocab_count"))
    j = tokens.join(checked_broadcast(v), tokens[token_col] == v["_vt"], "left")
    return j.select(*tokens.columns,
                    F.coalesce("token_id", F.lit(0)).cast("long").alias("token_id"),
                    F.coalesce("vocab_count", F.lit(0)).cast("long").alias("vocab_count"))


def vocabulary_stats(vocab: DataFrame) -> DataFrame:
    """Vocabulary size, total token count and the largest id, in one row."""
    return vocab.agg(F.count(F.lit(1)).alias("vocab_size"),
                     F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("total_count"),
                     F.coalesce(F.max("token_id"), F.lit(0)).cast("long").alias("max_token_id"))
