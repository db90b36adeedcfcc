"""Column expressions for text: markup removal and the token patterns.

Every pattern here is written so that Java regex (Spark) and RE2 (the DuckDB oracle)
read it the same way: no look-around, no back-references.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# A text is partitioned into maximal runs of letters/digits ("words") and maximal
# runs of anything else; the pieces alternate, so their lengths give offsets.
PIECE_PATTERN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"
WORD_PATTERN = r"[\p{L}\p{N}]+"
WORD_START = r"^[\p{L}\p{N}]"
WORD_CHAR = r"[\p{L}\p{N}]"
NON_WORD_CHAR = r"[^\p{L}\p{N}]"

SCRIPT_PATTERN = r"(?is)<script[^>]*>.*?</script>"
STYLE_PATTERN = r"(?is)<style[^>]*>.*?</style>"
TAG_PATTERN = r"<[^>]*>"
SPACE_RUN = r"[ \t\r\n]+"
H1_PATTERN = r"(?is)<h1[^>]*>(.*?)</h1>"
ANCHOR_PATTERN = r'<a href="/([^"]*)">([^<]*)</a>'
# An opening <p> becomes a paragraph break so unclosed paragraphs end at the next one.
P_OPEN_PATTERN = r"(?i)<p(\s[^>]*)?>"
PARAGRAPH_PATTERN = r"(?s)<p>(.*?)</p>"
LIST_PATTERN = r"(?is)<[uo]l[^>]*>(.*?)</[uo]l>"

# The character references decoded in page text, in decoding order
# (&amp; last so that "&amp;lt;" stays "&lt;").
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def lit_re(pattern: str) -> Column:
    return F.lit(pattern)


def decode_entities(c: Column) -> Column:
    for src, dst in ENTITIES:
        c = F.replace(c, F.lit(src), F.lit(dst))
    return c


def drop_scripts(html: Column) -> Column:
    """Remove <script> and <style> elements (separately: RE2 has no back-references)."""
    return F.regexp_replace(F.regexp_replace(html, SCRIPT_PATTERN, ""), STYLE_PATTERN, "")


def markup_to_text(fragment: Column) -> Column:
    """Tags become a space, character references are decoded, blank runs collapse."""
    no_tags = F.regexp_replace(fragment, TAG_PATTERN, " ")
    return F.trim(F.regexp_replace(decode_entities(no_tags), SPACE_RUN, " "))


def starts_with_word(text: Column) -> Column:
    """True when the first character is a letter or digit. Tests one character: an
    anchored ``rlike`` still scans the whole string with Java's ``find``."""
    return F.substring(text, 1, 1).rlike(WORD_CHAR)


def words(text: Column) -> Column:
    """Array of the word pieces of ``text`` in order."""
    return F.regexp_extract_all(text, lit_re(WORD_PATTERN), 0)


def pieces(text: Column) -> Column:
    """Array of all pieces (words and separators); their concatenation is ``text``."""
    return F.regexp_extract_all(text, lit_re(PIECE_PATTERN), 0)


# Numbers that one step of a running sum holds beside its input and result.
SUM_BLOCK = 1 << 18


def sums_in_rows(numbers: pa.Array) -> pa.Array:
    """For a column of arrays of 32-bit numbers the sums before each element. Beside the input
    there is one result as large and a block of rows: sums run over the rows' ends modulo
    2**32, which the difference to the row's own beginning takes out again."""
    bounds, first = np.asarray(numbers.offsets), numbers.offsets[0].as_py()
    values = np.asarray(numbers.values)[first:bounds[-1]]
    at = bounds - first
    out = np.empty(len(values), dtype=np.int32)
    np.cumsum(values, dtype=np.int32, out=out)
    out -= values
    heads = out[np.minimum(at[:-1], max(len(out) - 1, 0))] if len(out) else np.zeros(len(at) - 1, np.int32)
    a = 0
    while a < len(heads):
        b = max(a + 1, int(np.searchsorted(at, at[a] + SUM_BLOCK, side="right")) - 1)
        out[at[a]:at[b]] -= np.repeat(heads[a:b], np.diff(at[a:b + 1]))
        a = b
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(out))


def _starts_udf():
    def run(numbers: pa.Array) -> pa.Array:
        pa.default_memory_pool().release_unused()  # what the batch before has left
        return sums_in_rows(numbers)
    return F.arrow_udf(run, "array<int>")


def starts(parts: Column) -> Column:
    """Where each of the parts of a text begins: the running sum of the lengths before it.
    Spark's array functions keep no running state, so the sum is one vectorised pass over the
    lengths (not the texts) of an Arrow batch, linear in their number. ``parts`` is not null."""
    return sums_before(F.transform(parts, F.length))


def sums_before(numbers: Column) -> Column:
    """For every element of an array of numbers the sum of those before it (as ``starts``);
    the numbers and their sum are 32-bit, as lengths within one text are."""
    return _starts_udf()(numbers.cast("array<int>")).cast("array<bigint>")


def strip_url_query(url: Column) -> Column:
    return F.regexp_replace(url, r"[?#].*$", "")
