"""Main text of pages, with the boilerplate of a host found by its repeated token runs.

Each page is cut into blocks in page order. Blocks in elements that are boilerplate by their
tag, class or id go. Of the others, inside ``article`` or ``main`` or not, the host's token
streams are searched for long substrings that distinct pages share, by a sparse suffix array:
the suffixes that start at anchors (the least of every ``WINDOW - GRAM + 1`` neighbouring
``GRAM``-token hashes, so equal runs of ``WINDOW`` tokens have equal anchors), each cut behind
the next anchor. Suffixes of one host with equal beginnings are one range of the array; a
range is repeated if at least ``MIN_PAGES`` distinct pages and at least ``SHARE`` of the host's
distinct pages lie in it. Neighbouring ranges overlap, so they chain up to the maximal
repeats, and a block that repeated ranges cover from end to end is boilerplate; unique runs
stay. All spans of such a block are repeated, so its least one is: the least spans of all
blocks are counted first, and of the others only those that stand in a block whose least span
is repeated, wherever they stand. A page with blocks left or removed inside ``article`` or ``main`` gives those left
there, any other page what is left of its blocks.

Pages are distinct if the ``KIND`` least fingerprints of their word pairs differ: equal pages
count as one, and so do most that differ in a few words; the page that stands for them is
chosen by a hash of its row. Ranges are counted with partial aggregates over one page of each
kind, so a host with a third of all pages is spread over the cluster, and no host's pages meet
in one task.

Defined results: a null html is empty and gives an empty text; a null url is the empty host;
repeated rows give repeated results and count as one page; other columns are ignored,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import html as htmllib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkstats.llm.common import map_arrow, table
from linkstats.llm import wordhash as wh
from linkstats.session import checked_broadcast, materialize, scratch_tables

WINDOW, GRAM = 8, 4
MIN_PAGES, SHARE, KIND = 3, 0.5, 4
# Element names of HTML.
SKIPPED = frozenset("head nav header footer aside form script style noscript template iframe object embed svg math canvas "
                    "select option button textarea label fieldset dialog menu audio video map title".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
CONTENT = frozenset(["article", "main"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rb rp rt s samp small "
                   "span strike strong sub sup time tt u var wbr img".split())
# Words of class, id and role that name boilerplate, and those that name content.
BOILERPLATE = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
                        "cookie cookies copyright disclaimer disqus footer form header menu modal nav navbar navigation newsletter "
                        "notice notices pagination popup promo promotion related replies reply share sharing sidebar sidenav "
                        "skip social sponsor sponsored subscribe subscription toolbar tracking widget widgets complementary "
                        "contentinfo search alert".split())
CONTENT_WORDS = frozenset("article content entry main post story text body".split())

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[>=]")
_BLANK = re.compile(r"\s*")
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/\"'>]+)", re.S)


def _boilerplate_attributes(name: str, attributes: str) -> bool:
    words, content = set(), False
    for key, a, b, c, bare in _ATTRIBUTE.findall(attributes):
        key, value = (key or bare).lower(), (a or b or c).lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if key in ("class", "id", "role", "aria-label", "itemprop"):
            for item in value.split():
                parts = [x for x in re.split(r"[^a-z0-9]+", item) if x]
                if parts:
                    words.update((parts[0], parts[-1]))
                    content |= parts[-1] in CONTENT_WORDS
    if name in CONTENT:
        return bool(words & {"comment", "comments", "reply", "replies", "ad", "ads", "advert", "sponsored", "promo", "related"})
    return name not in ("html", "body") and bool(words & BOILERPLATE) and not content


def _tokens(html: str):
    """(text, None, None, None, end) and ("", closing, name, attributes, end) in page order.

    A quote holds an attribute value only right behind ``=`` and if it is closed somewhere;
    a tag that never ends is text, and so is everything that looks like a tag behind it. Last
    places of quotes and ``>`` are looked up once, so the scan is linear. ``send(pos)`` goes on
    at another place."""
    pos, size = 0, len(html)
    last = {c: html.rfind(c) for c in "\"'>"}
    while pos < size:
        at = html.find("<", pos)
        at = size if at < 0 else at
        if at > pos:
            yield html[pos:at], None, None, None, at
        pos = at
        if pos >= size:
            return
        if html.startswith("<!--", pos):
            close = html.find("-->", pos + 4)
            pos = size if close < 0 else close + 3
            continue
        name = _NAME.match(html, pos + 1)
        end = -1
        if name:
            at = name.end()
            while at <= last[">"]:
                stop = _STOP.search(html, at)
                if stop is None:
                    break
                if stop[0] == ">":
                    end = stop.start()
                    break
                at = _BLANK.match(html, stop.end()).end()
                quote = html[at:at + 1]
                if quote in ("\"", "'") and quote and at < last[quote]:
                    at = html.find(quote, at + 1) + 1
            if end < 0:
                yield html[pos:], None, None, None, size
                return
            there = yield "", name[1], name[2].lower(), html[name.end():end], end + 1
            pos = there or end + 1
            if there:
                yield None
        elif html[pos + 1:pos + 2] in ("!", "?", "/") and html[pos + 1:pos + 2] and pos < last[">"]:
            pos = html.find(">", pos) + 1
        else:
            yield "<", None, None, None, pos + 1
            pos += 1


def page_blocks(html: str) -> list[tuple[str, bool, bool]]:
    """(text, in content, in boilerplate) of every non-empty block, in page order."""
    out, buffer = [], []
    skip, depth, content = "", 0, []  # the boilerplate element that is open, its nesting; open content elements

    def flush():
        text = " ".join(htmllib.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            out.append((text, bool(content), bool(skip)))

    tokens = _tokens(html)
    for text, slash, name, attributes, pos in tokens:
        if name is None:
            buffer.append(text)
            continue
        closing = bool(slash)
        if name not in INLINE:
            flush()
        if closing:
            if skip == name:
                depth -= 1
                if not depth:
                    flush()
                    skip = ""
            elif skip in ("p", "li", "dt", "dd") and name not in INLINE:
                skip = ""  # the end of its parent ends it
            if not skip and content and name == content[-1]:
                content.pop()
            continue
        if skip in ("p", "li", "dt", "dd") and name not in INLINE and (skip == "p" or name == skip):
            skip = ""
        single = name in VOID or attributes.rstrip().endswith("/") and name in ("svg", "path", "iframe", "script")
        if name in RAW and not single:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, pos)
            after = html.find(">", close.start()) if close else -1
            tokens.send(len(html) if after < 0 else after + 1)
            continue
        if single:
            continue
        if skip:
            depth += name == skip
        elif name in SKIPPED or _boilerplate_attributes(name, attributes):
            flush()
            skip, depth = name, 1
        elif name in CONTENT:
            content.append(name)
    flush()
    return out


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, word offsets by text)."""
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    return wh.words_of(data, np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64))


def _sums(words: np.ndarray) -> np.ndarray:
    values = words * wh.powers("base", wh._BASE, len(words))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])


def spans(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, end) of the beginnings of the anchored suffixes of texts laid end to
    end: from each anchor over the gram at the next one, from the text's first word over the
    first anchor, from the last anchor to the text's end; a short text is one span. They
    overlap and cover every word."""
    n = len(words)
    text_of = np.repeat(np.arange(len(at) - 1), np.diff(at))
    until = np.repeat(at[1:], np.diff(at))
    starts = np.flatnonzero(np.arange(n) + WINDOW <= until)  # of WINDOW words in one text
    anchor = np.zeros(0, dtype=np.int64)
    if len(starts):
        s = _sums(words)
        gram = np.full(n + WINDOW, ~np.uint64(0))
        whole = np.arange(n - GRAM + 1)
        gram[:len(whole)] = wh.span_hashes(s, whole, whole + GRAM)
        k = WINDOW - GRAM + 1
        anchor = np.unique(starts + np.argmin(np.stack([gram[starts + i] for i in range(k)]), axis=0))
    held = np.flatnonzero(np.diff(at) > 0)
    first = np.concatenate([at[held], anchor])
    order = np.argsort(first, kind="stable")  # a text's first word before an anchor on it
    first = first[order]
    head = (order < len(held))
    text = text_of[first]
    following = np.append(first[1:], n)
    last = np.append(text[1:] != text[:-1], True)
    end = np.where(last, until[first], following + GRAM)
    # the span from a text's first word is needed only where it says more than the first anchor's
    keep = ~(head & ~last & (following == first))
    return text[keep], first[keep], end[keep]


def span_marks(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, fingerprint) of every span of the texts."""
    words, at = _words(texts)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    text, first, end = spans(words, at)
    return text, wh.span_hashes(_sums(words), first, end)


PARSED = "page_id long, url string, row long, host long, blocks array<string>, content array<boolean>, kind long, least array<long>"
_PARSED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("row", pa.int64()), ("host", pa.int64()), ("blocks", pa.list_(pa.string())),
                     ("content", pa.list_(pa.bool_())), ("kind", pa.int64()), ("least", pa.list_(pa.int64()))])


def _of_host(marks: np.ndarray, host: int) -> np.ndarray:
    return wh.mix(marks ^ np.uint64(host % (1 << 64))).view(np.int64)


def _kind(texts: list[str]) -> int:
    """A fingerprint of the least hashes of the word pairs inside the texts."""
    words, at = _words(texts)
    pair = wh.mix(words[:-1] * wh._BYTE[7] + words[1:])
    inside = np.ones(len(pair), dtype=bool)
    inside[at[1:-1][(at[1:-1] > 0) & (at[1:-1] <= len(pair))] - 1] = False
    least = np.unique(pair[inside])[:KIND] if inside.any() else words[:KIND]
    return _signed(",".join(map(str, least.tolist())))


def _signed(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def least_marks(texts: list[str], host: int) -> np.ndarray:
    """The least span of every text."""
    text, marks = span_marks(texts)
    return np.minimum.reduceat(_of_host(marks, host), np.searchsorted(text, np.arange(len(texts)))) if len(text) else marks.view(np.int64)


def _spans_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, mark) of the spans of the blocks of (row, host, blocks, chosen): of those whose
    least span is among ``chosen``, of all where that is null; each once for a page."""
    for batch in batches:
        rows, found = [], []
        for row, host, blocks, chosen in zip(*(c.to_pylist() for c in batch.columns)):
            text, marks = span_marks(blocks)
            marks = _of_host(marks, host)
            if chosen is not None and len(marks):
                marks = marks[np.isin(least_marks(blocks, host), np.array(chosen, dtype=np.int64))[text]]
            marks = np.unique(marks)
            rows.append(np.full(len(marks), row, dtype=np.int64))
            found.append(marks)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(rows)), pa.array(np.concatenate(found), pa.int64())], names=["row", "mark"])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            rows = []
            for page_id, url, row, html in zip(*(c.to_pylist() for c in batch.slice(start, 256).columns)):
                host = _signed(re.sub(r"(?s)^.*?://([^/?#]*).*$", r"\1", url).lower() if "://" in (url or "") else "")
                blocks = [(t, content) for t, content, skip in page_blocks(html or "") if not skip]
                texts = [t for t, _ in blocks]
                rows.append((page_id, url, row, host, texts, [c for _, c in blocks], _kind(texts), least_marks(texts, host).tolist()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PARSED)], schema=_PARSED)


def unique_blocks(blocks: list[str], content: list[bool], host: int, repeated: list[int]) -> str:
    """The content blocks, or on a page without such all blocks, that repeated spans do not cover."""
    covered = np.zeros(len(blocks), dtype=bool)
    if repeated:
        text, marks = span_marks(blocks)
        unique = ~np.isin(_of_host(marks, host), np.array(repeated, dtype=np.int64))
        covered[text] = True
        covered[text[unique]] = False
    inner = any(content)
    return " ".join(t for t, c, gone in zip(blocks, content, covered) if not gone and (c or not inner))


_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(page_id, url, unique_blocks(blocks, content, host, marks or []))
                for page_id, url, host, blocks, content, marks in zip(*(c.to_pylist() for c in batch.columns))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _TEXTS)], schema=_TEXTS)


def _repeated(spans: DataFrame, one: DataFrame) -> DataFrame:
    """(mark): the ranges that enough distinct pages of their host share; ``spans`` are (row,
    mark), ``one`` (row, equal, need) the page that stands for each kind, how many equal rows
    it has (they count as one) and how many pages its host asks for."""
    counted = (spans.join(checked_broadcast(one), "row").groupBy("mark")
               .agg(F.round(F.sum(1 / F.col("equal"))).alias("n"), F.min("need").alias("need")))
    return counted.where(F.col("n") >= F.col("need")).select("mark")


def _found(parsed: DataFrame) -> DataFrame:
    """(row, marks): the repeated spans in the blocks that may go."""
    rows = parsed.groupBy("host", "kind", "row").agg(F.count(F.lit(1)).alias("equal"))
    kinds = rows.groupBy("host", "kind").agg(F.min(F.struct("row", "equal")).alias("r")).select("host", "r.row", "r.equal")
    kinds = materialize(kinds, "html_kinds")
    sizes = kinds.groupBy("host").agg(F.greatest(F.lit(MIN_PAGES), SHARE * F.count(F.lit(1))).alias("need"), F.count(F.lit(1)).alias("pages"))
    one = kinds.join(sizes.where(F.col("pages") >= MIN_PAGES).select("host", "need"), "host").select("row", "equal", "need")
    one = materialize(one, "html_one")
    least = parsed.select("row", F.explode(F.array_distinct("least")).alias("mark"))
    chosen = materialize(_repeated(least, one), "html_least")
    touched = (least.join(checked_broadcast(chosen), "mark", "left_semi").groupBy("row").agg(F.collect_set("mark").alias("chosen")))
    touched = materialize(touched, "html_touched")
    blocks = parsed.join(checked_broadcast(touched), "row").select("row", "host", "blocks", "chosen")
    spans = materialize(map_arrow(blocks, _spans_of, "row long, mark long"), "html_spans")
    marks = materialize(spans.select("mark").distinct(), "html_candidates")
    hosts = blocks.select("host").distinct()
    everywhere = map_arrow(parsed.join(checked_broadcast(hosts), "host", "left_semi").select(
        "row", "host", "blocks", F.lit(None).cast("array<bigint>").alias("chosen")), _spans_of, "row long, mark long")
    everywhere = everywhere.join(checked_broadcast(marks), "mark", "left_semi")
    repeated = materialize(_repeated(everywhere, one), "html_repeated")
    return (spans.join(checked_broadcast(repeated), "mark", "left_semi").distinct()
            .groupBy("row").agg(F.collect_set("mark").alias("marks")))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) for every page."""
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    rows = rows.select("page_id", "url", F.xxhash64("page_id", "url", "html").alias("row"), "html")
    parsed = materialize(map_arrow(rows, _parse, PARSED), "html_parsed")
    with scratch_tables(pages.sparkSession) as scope:
        found = scope.keep(_found(parsed), "html_found")
    joined = parsed.drop("least").join(checked_broadcast(found), "row", "left")
    return map_arrow(joined.select("page_id", "url", "host", "blocks", "content", "marks"), _assemble,
                     "page_id long, url string, text string")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
