"""Entity identifier normalisation (P8) as a column expression.

Our definition of the encoder: strip the known prefixes, percent-decode when the id
holds at least one %hh escape and no stray '%', turn blanks into '_', collapse and
trim '_', then prepend the target prefix. The resource namespace host is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats. {lang} is the corpus language; {host} the resource namespace host.
WIKI_URL_PREFIX = "http://{lang}.wikipedia.org/wiki/"
RESOURCE_PREFIX = "http://{lang}.{host}/resource/"
RESOURCE_PREFIX_NO_LANG = "http://{host}/resource/"
DEFAULT_RESOURCE_HOST = "kb.example.org"

HEX_ESCAPE = r"%[0-9A-Fa-f]{2}"
STRAY_PERCENT = r"%([^0-9A-Fa-f]|[0-9A-Fa-f][^0-9A-Fa-f]|[0-9A-Fa-f]?$)"


def prefixes(lang: str = "en", host: str = DEFAULT_RESOURCE_HOST) -> dict[str, str]:
    return {
        "wiki": WIKI_URL_PREFIX.format(lang=lang),
        "resource": RESOURCE_PREFIX.format(lang=lang, host=host),
        "resource_no_lang": RESOURCE_PREFIX_NO_LANG.format(host=host),
    }


def bare_id(c: Column, lang: str = "en", host: str = DEFAULT_RESOURCE_HOST) -> Column:
    """The id without any known prefix, percent-decoded, blanks as single '_'."""
    p = prefixes(lang, host)
    for key in ("wiki", "resource", "resource_no_lang"):
        c = F.replace(c, F.lit(p[key]), F.lit(""))
    # url_decode is form decoding ('+' means blank): protect '+' first.
    decoded = F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    c = F.when(c.rlike(HEX_ESCAPE) & ~c.rlike(STRAY_PERCENT), F.coalesce(decoded, c)).otherwise(c)
    c = F.regexp_replace(c, r"[ _]+", "_")
    return F.regexp_replace(c, r"^_+|_+$", "")


def resource_uri(c: Column, lang: str = "en", host: str = DEFAULT_RESOURCE_HOST) -> Column:
    return F.concat(F.lit(prefixes(lang, host)["resource"]), bare_id(c, lang, host))


def wiki_url(c: Column, lang: str = "en", host: str = DEFAULT_RESOURCE_HOST) -> Column:
    return F.concat(F.lit(prefixes(lang, host)["wiki"]), bare_id(c, lang, host))
