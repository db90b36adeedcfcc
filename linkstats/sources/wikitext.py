"""Link extraction from wiki markup (P9): markup -> plain text, link spans, paragraphs.

``[[target|anchor]]`` contributes ``anchor`` to the text and a link (anchor, target);
``[[target]]`` contributes ``target`` for both. Elements without text, templates, file and
category links and the marks of headings, lists, rules and tables go first (``wikiblocks``),
then tags, quotes, external links (their label stays) and behaviour switches. Character
references are decoded last, in the pieces of the finished text. All of it is narrow: a page
is parsed inside its own row, its link offsets are the running sum of the lengths of its
pieces, and pages without an id or with the same title stay apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkstats import schema as S
from linkstats.functions import text as tx
from linkstats.sources import wikiblocks as wb

LINK_PATTERN = r"\[\[[^\[\]]*\]\]"
PIECE_PATTERN = r"\[\[[^\[\]]*\]\]|[^\[]+|\["
# Protocols of external links, and behaviour switches.
PROTOCOLS = ("http", "https", "ftp", "ftps", "sftp", "mailto", "news", "irc", "ircs", "git", "svn", "tel", "geo")
SWITCHES = ("NOTOC", "FORCETOC", "TOC", "NOEDITSECTION", "NEWSECTIONLINK", "NONEWSECTIONLINK", "NOGALLERY", "HIDDENCAT",
            "EXPECTUNUSEDCATEGORY", "NOCONTENTCONVERT", "NOTITLECONVERT", "INDEX", "NOINDEX", "STATICREDIRECT", "DISAMBIG")
_ADDRESS = rf"(?:(?:{'|'.join(PROTOCOLS)}):|//)[^\s\[\]<>]++"
# (pattern, replacement); the repeated group is possessive, so a long label needs no recursion
INLINE = [
    (r"(?i)<br\s*/?>", "\n"),
    (r"</?[A-Za-z][^<>]*>", ""),
    (r"'{2,}", ""),
    (rf"(?i)\[{_ADDRESS}[ \t]+((?:[^\[\]\n]|\[\[[^\[\]]*\]\])*+)\]", "$1"),
    (rf"(?i)(?<!\[)\[{_ADDRESS}\](?!\])", ""),
    (rf"__(?:{'|'.join(SWITCHES)})__", ""),
]
# Namespaces whose links show no text of the article, in English (known to
# every wiki) and in the language of some other wikis.
SILENT_NAMESPACES = ("file", "image", "category", "datei", "bild", "kategorie", "fichier", "catégorie",
                     "archivo", "imagen", "categoría")
PARAGRAPH_BREAK = r"\n[ \t]*\n\s*"


def clean_markup(c, namespaces: tuple[str, ...] = SILENT_NAMESPACES):
    """Markup without what is not text; internal links and character references stay."""
    c = wb.block_text(c, namespaces)
    for pattern, replacement in INLINE:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def plain_of(c):
    """Markup without links: anchors (or targets) in place of ``[[...]]``."""
    c = F.regexp_replace(c, r"\[\[[^\[\]|]*\|([^\[\]]*)\]\]", "$1")
    return F.regexp_replace(c, r"\[\[\s*:?([^\[\]|]*)\]\]", "$1")


def _raw_paragraphs(clean):
    """(text with references, raw target of every link) of each paragraph."""
    def one(p):
        targets = F.transform(F.regexp_extract_all(p, F.lit(LINK_PATTERN), 0), lambda l: _piece(l)["target"])
        return F.struct(F.trim(plain_of(p)).alias("text"), targets.alias("targets"))

    return F.filter(F.transform(F.split(F.trim(clean), PARAGRAPH_BREAK), one), lambda s: s["text"] != "")


def _piece(p):
    """A piece of markup as (text, link target or null). Only the link alternative of
    PIECE_PATTERN yields a piece that starts with "[[" (an unclosed one splits into "[")."""
    inner = F.regexp_replace(F.substring(p, F.lit(3), F.length(p) - 4), r"^\s*:", "")
    piped = F.instr(inner, "|") > 0
    target = F.trim(F.when(piped, F.substring_index(inner, "|", 1)).otherwise(inner))
    anchor = F.when(piped, F.substring(inner, F.instr(inner, "|") + 1, F.length(inner))).otherwise(inner)
    is_link = p.startswith("[[")
    return F.struct(F.when(is_link, anchor).otherwise(p).alias("t"), F.when(is_link, target).alias("target"))


def parse_markup(df: DataFrame, markup_col: str = "markup") -> DataFrame:
    """Adds ``plain`` (text), ``links`` (array<description,end,id,start>) and
    ``paragraphsLink`` to every row of ``df``; other columns are kept, null markup is empty."""
    keep = [c for c in df.columns if c != markup_col]
    base = df.select(*keep, clean_markup(F.coalesce(F.col(markup_col), F.lit(""))).alias("_clean"))
    base = base.withColumn("_parts", F.transform(F.regexp_extract_all("_clean", F.lit(PIECE_PATTERN), 0), _piece))
    base = base.withColumn("_raw", _raw_paragraphs(F.col("_clean")))
    base = base.withColumn("_texts", wb.decode_references(F.col("_parts.t")))
    base = base.withColumn("_targets", wb.decode_references(F.col("_parts.target")))
    base = base.withColumn("_para_texts", wb.decode_references(F.col("_raw.text")))
    base = base.withColumn("_para_targets", wb.decode_references(F.flatten("_raw.targets")))
    base = base.withColumn("_at", tx.starts(F.col("_texts")))

    def link(x, i):
        start = F.get("_at", i)
        return F.struct(x["_texts"].alias("description"), (start + F.length(x["_texts"])).alias("end"),
                        x["_targets"].alias("id"), start.alias("start"))

    links = F.filter(F.transform(F.arrays_zip("_texts", "_targets"), link), lambda x: x["id"].isNotNull())
    # a paragraph's targets follow those of the paragraphs before it
    counts = F.transform("_raw.targets", lambda t: F.size(t))
    base = base.withColumn("_n", counts).withColumn("_first", tx.sums_before(F.col("_n")))

    def paragraph(text, i):
        ids = F.slice("_para_targets", (F.get("_first", i) + 1).cast("int"), F.get("_n", i))
        return F.struct(text.alias("paraText"), F.transform(ids, lambda x: F.struct(x.alias("id"))).alias("links"))

    return base.select(
        *keep, F.array_join("_texts", "").alias("plain"),
        links.cast(S.ARTICLE["links"].dataType).alias("links"),
        F.transform("_para_texts", paragraph).cast(S.ARTICLE["paragraphsLink"].dataType).alias("paragraphsLink"))
