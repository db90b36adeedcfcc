"""Entity-annotated text (X1, T8): each page-linked spot is replaced by
``" " + resource URI of its resolved target + " "``.

Spots of a page (bounded by the page's own words) are gathered per page and sorted; the
text is then rebuilt in one pass over Arrow batches: each spot contributes the text between
the previous spot's end and its own start, then its replacement. (``substring`` walks from
the start of a UTF-8 text for each spot, which is quadratic in the page length.) Pages
without spots pass by unchanged.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkstats import session as sess
from linkstats.functions import uris as ur
from linkstats.operators import redirects as rd


def _splice_udf():
    def one(text, spans):
        if text is None or not spans:
            return text
        out, end = [], 0
        for s in spans:
            out += (text[end:s["offset"]], s["repl"] or "")
            end = s["end"]
        return "".join(out) + text[end:]

    def run(text: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([one(t, s) for t, s in zip(text.to_pylist(), spans.to_pylist())], pa.string())
    return F.arrow_udf(run, "string")


def splice(texts: DataFrame, replacements: DataFrame, id_col: str = "wid", text_col: str = "text") -> DataFrame:
    """Replace non-overlapping spans: replacements(id, offset, end, repl) -> (id, text)."""
    per_page = (replacements.groupBy(id_col)
                .agg(F.array_sort(F.collect_list(F.struct("offset", "end", "repl"))).alias("r")))
    j = texts.select(id_col, text_col).join(per_page, id_col, "left")
    return j.select(id_col, _splice_udf()(F.col(text_col), F.col("r")).alias(text_col))


def rewrite_text(texts: DataFrame, linked_spots: DataFrame, resolved: DataFrame, lang: str = "en",
                 host: str = ur.DEFAULT_RESOURCE_HOST, id_col: str = "wid") -> DataFrame:
    """(wid, text). ``linked_spots``: (wid, sf, offset, uri), non-overlapping;
    ``resolved``: (title, final) from the redirect resolver. The spots are read twice
    (distinct ids for the lookup, then the join back), so they are written once."""
    spots = sess.materialize(linked_spots, "linked_spots")
    targets = rd.resolve_targets(spots, resolved, "uri")
    repl = targets.select(
        id_col, "offset", (F.col("offset") + F.length("sf")).alias("end"),
        F.concat(F.lit(" "), ur.resource_uri(F.col("target"), lang, host), F.lit(" ")).alias("repl"))
    return splice(texts, repl, id_col)
