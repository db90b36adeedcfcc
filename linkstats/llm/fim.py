"""Fill-in-middle transformation (operator 12) by one counted-quantifier match per row.

A text is cut into units (a word of A-Z letters, or one other character). ``regexp_count``
counts them, hashes of the id choose two cuts a <= b, and the row's own pattern
``(unit{a}+)(unit{b-a}+)(.*)`` captures prefix, middle and suffix in one match, whose
replacement writes them in the order of the form. Possessive counts never back-track, so a
match is one pass over the text, without recursion. Narrow and JVM-side throughout.

Defined cases: a null or empty text is plain and stays empty (``n`` 0); a null id hashes as
an empty one; equal rows give equal rows; other columns are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkstats.llm.common import table, text_of

# Fixed values of the format: the three marks, and the units of a text.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = "[A-Za-z]+|[^A-Za-z]"


def hash_groups(seed: int, doc_id: Column, n: int = 4) -> list[Column]:
    """The first ``n`` groups of 8 hexadecimal digits of sha256("seed:id"), as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)]


def pattern(prefix_units: Column, middle_units: Column) -> Column:
    """The pattern of one row: three groups that cover its whole text."""
    unit = f"(?:{UNIT})"
    return F.concat(F.lit(rf"(?s)\A({unit}{{"), prefix_units.cast("string"), F.lit(rf"}}+)({unit}{{"),
                    middle_units.cast("string"), F.lit(r"}+)(.*)\z"))


def fill_in_middle(docs: DataFrame, percent: int = 90, spm_percent: int = 20, seed: int = 1,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of ``docs``.

    ``percent`` of the rows are cut, ``spm_percent`` of these begin with the suffix. A text
    that holds one of the marks stays plain, so every output can be read back.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.select("doc_id", "text", F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"),
                       *[h.alias(f"h{i}") for i, h in enumerate(hash_groups(seed, F.col("doc_id")), 1)])
    cuts = [F.col(h) % (F.col("n") + 1) for h in ("h1", "h2")]
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.col("text").contains(mark)
    form = (F.when((F.col("text") == "") | marked | (F.col("h3") % 100 >= percent), "plain")
            .when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm"))
    rows = rows.select("doc_id", "text", "n", F.least(*cuts).alias("a"), F.greatest(*cuts).alias("b"), form.alias("form"))
    order = (F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
             .otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"))
    cut = F.regexp_replace(F.col("text"), pattern(F.col("a"), F.col("b") - F.col("a")), order)
    rows = rows.select("doc_id", "n", "form", F.when(F.col("form") == "plain", F.col("text")).otherwise(cut).alias("output"))
    prefix, middle, _ = _parts(F.col("output"), F.col("form"))
    return rows.select("doc_id", "n", "form", *[
        F.when(F.col("form") != "plain", F.length(c)).cast("long").alias(name)
        for c, name in ((prefix, "prefix_chars"), (middle, "middle_chars"))], "output")


def _parts(output: Column, form: Column) -> tuple[Column, Column, Column]:
    """(prefix, middle, suffix) read back. The parts hold no mark, and a mark cannot begin
    before and end inside another, so the first place of each mark is the written one."""
    p, s, m = (F.instr(output, mark) for mark in (PREFIX, SUFFIX, MIDDLE))
    psm = form == "psm"
    between = (lambda a, b: F.substring(output, a + 3, b - a - 3))
    middle = F.substring(output, m + 3, F.length(output))
    return (F.when(psm, between(p, s)).otherwise(between(p, m)), middle,
            F.when(psm, between(s, m)).otherwise(between(s, p)))


def restore(output: Column, form: Column) -> Column:
    """The exact text from an output and its form."""
    return F.when(form == "plain", output).otherwise(F.concat(*_parts(output, form)))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: 90 % are cut, 20 % of these begin with the suffix."""
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = """
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
units AS (
    SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u,
           CAST('0x' || substr(digest, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(digest, 9, 8) AS BIGINT) AS h2,
           CAST('0x' || substr(digest, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(digest, 25, 8) AS BIGINT) AS h4
    FROM hashed),
cuts AS (
    SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n,
           least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
                THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM units),
parts AS (
    SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
           array_to_string(u[b + 1:], '') AS suffix
    FROM cuts)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM parts
"""
