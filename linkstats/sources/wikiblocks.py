"""Block grammar of wiki markup: what nests or spans lines, in one linear pass over a page.

Patterns cannot follow brackets that nest without bound or tables within tables, so this
part of P9 is a scanner over Arrow batches: elements without article text, templates and
silent links go first, then an automaton over lines whose state is the number of open tables
takes headings, lists, rules and tables apart. Internal links ``[[...]]`` stay as they are,
so that their offsets can be counted afterwards in the finished text.

Whatever is never closed stays in the text. Every character is looked at a fixed number of
times: a search for an end tag that failed is not made again.
"""

from __future__ import annotations

import re
from html.entities import html5

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements whose content is no text of the article, and those whose content is
# text but no markup.
DROPPED_ELEMENTS = ("ref", "math", "chem", "gallery", "timeline", "score", "source", "syntaxhighlight", "templatedata",
                    "imagemap", "hiero", "graph", "mapframe", "maplink", "style", "script")
LITERAL_ELEMENTS = ("nowiki", "pre")
# Characters that begin or end markup, written as references inside literal elements.
MARKUP_CHARACTERS = "[]{}|'=*#:;!_<>-~"

_OPEN = re.compile(r"<!--|<(%s)\b[^<>]*>" % "|".join(DROPPED_ELEMENTS + LITERAL_ELEMENTS), re.IGNORECASE)
_BRACKET = re.compile(r"(\{\{|\}\}|\[\[|\]\])")
_HEADING = re.compile(r"(={1,6})(.+)\1\s*$")
_LIST_ITEM = re.compile(r"([*#:;]+)\s*")
_CELL_BREAK = re.compile(r"\[\[[^\[\]]*\]\]|\|\||!!")
_CELL_ATTRIBUTES = re.compile(r"(?:[^|\[\]]|\[(?!\[)|\](?!\]))*\|")
_REFERENCE = re.compile(r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{0,31});")
_AS_REFERENCES = {ord(c): f"&#{ord(c)};" for c in MARKUP_CHARACTERS}


def drop_elements(markup: str) -> str:
    """Without comments and elements that hold no article text; literal elements lose their
    tags, and their content keeps its characters as references."""
    out, at, never_closed = [], 0, set()
    low = None
    while True:
        m = _OPEN.search(markup, at)
        if m is None:
            out.append(markup[at:])
            return "".join(out)
        name = (m[1] or "").lower()
        if not name:  # a comment; one that is not closed takes the rest
            end = markup.find("-->", m.end())
            out.append(markup[at:m.start()])
            at = len(markup) if end < 0 else end + 3
            continue
        if m[0].endswith("/>"):
            out.append(markup[at:m.start()])
            at = m.end()
            continue
        if low is None:
            low = markup.lower() if len(markup.lower()) == len(markup) else markup
        end = -1 if name in never_closed else low.find(f"</{name}", m.end())
        close = -1 if end < 0 else markup.find(">", end)
        if close < 0:
            never_closed.add(name)
            out.append(markup[at:m.end()])
            at = m.end()
            continue
        out.append(markup[at:m.start()])
        if name in LITERAL_ELEMENTS:
            out.append(markup[m.end():end].translate(_AS_REFERENCES))
        at = close + 1


def drop_nested(markup: str, silent: re.Pattern) -> str:
    """Without templates and silent links. Each closing pair takes the innermost open one."""
    out, open_at, templates = [], [], 0
    for part in _BRACKET.split(markup):
        if part in ("{{", "[["):
            open_at.append((part, len(out)))
            templates += part == "{{"
        elif part == "}}" and templates:
            while open_at[-1][0] != "{{":
                open_at.pop()
            del out[open_at.pop()[1]:]
            templates -= 1
            continue
        elif part == "]]" and open_at and open_at[-1][0] == "[[":
            at = open_at.pop()[1]
            if silent.match(out[at + 1]):
                del out[at:]
                continue
        out.append(part)
    return "".join(out)


def _cells(line: str) -> str:
    """The cells of one table line, without their attributes, a tab between them. A link's
    own bars part nothing; ``!!`` parts header cells only."""
    header, cells, at = line[0] == "!", [], 1
    for m in _CELL_BREAK.finditer(line, 1):
        if m[0] == "||" or (m[0] == "!!" and header):
            cells.append(line[at:m.start()])
            at = m.end()
    cells.append(line[at:])
    return "\t".join(_cell(c) for c in cells)


def _cell(cell: str) -> str:
    m = _CELL_ATTRIBUTES.match(cell)
    return (cell[m.end():] if m else cell).strip()


def lines_to_text(markup: str) -> str:
    """Headings, list items, rules and tables as plain lines. A heading and a table stand
    apart from what is around them by an empty line; a table row is a line."""
    out: list[str] = []
    tables = 0

    def gap():
        if out and out[-1].strip():
            out.append("")

    for line in markup.split("\n"):
        s = line.strip()
        head = s[:1]
        if s.lstrip(":").lstrip().startswith("{|"):
            tables += 1
            gap()
        elif tables and head == "|" and s.startswith("|}"):
            tables -= 1
            gap()
            if s[2:].strip():
                out.append(s[2:].strip())
        elif tables and head == "|" and s.startswith("|-"):
            continue
        elif tables and head == "|" and s.startswith("|+"):
            out.append(_cell(s[2:]))
        elif tables and head in ("|", "!"):
            out.append(_cells(s))
        elif head == "=" and (m := _HEADING.match(s)) and m[2].strip():
            gap()
            out += [m[2].strip(), ""]
        elif head == "-" and s.startswith("----"):
            gap()
            if s.strip("-").strip():
                out.append(s.lstrip("-").strip())
        elif head and head in "*#:;" and (m := _LIST_ITEM.match(s)):
            item = s[m.end():]
            term, colon, meaning = item.partition(" : ") if m[1].endswith(";") else (item, "", "")
            out += [term, meaning] if colon else [item]
        else:
            out.append(line[1:] if line.startswith(" ") and s else line)
    return "\n".join(out)


def _reference(m: re.Match) -> str:
    name = m[1]
    if name[0] != "#":
        return html5.get(f"{name};", m[0])
    code = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
    return chr(code) if 0 < code < 0xD800 or 0xDFFF < code < 0x110000 else m[0]


# Values of a column that are Python objects at a time.
SLICE = 1 << 10


def _mapped(column: pa.Array, function) -> pa.Array:
    """``function`` of every string that is not null, a slice after the other."""
    parts = [pa.array([None if v is None else function(v) for v in column.slice(i, SLICE).to_pylist()], pa.string())
             for i in range(0, len(column), SLICE)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def block_text(markup: Column, namespaces: tuple[str, ...]) -> Column:
    """Markup without comments, templates, silent links and block marks; null stays null."""
    silent = re.compile(r"\s*(?:%s)\s*:" % "|".join(map(re.escape, namespaces)), re.IGNORECASE)

    def run(column: pa.Array) -> pa.Array:
        return _mapped(column, lambda m: lines_to_text(drop_nested(drop_elements(m), silent)))
    return F.arrow_udf(run, "string")(markup)


def decoded(values: pa.Array) -> pa.Array:
    """The strings with their references decoded; only those with one become Python objects."""
    values = values.cast(pa.string())
    hit = pc.fill_null(pc.match_substring(values, "&"), False)
    if not pc.any(hit).as_py():
        return values
    return pc.replace_with_mask(values, hit, _mapped(values.filter(hit), lambda v: _REFERENCE.sub(_reference, v)))


def decode_references(parts: Column) -> Column:
    """Character references (named, decimal, hexadecimal) decoded once in an array of
    strings; unknown ones stay. Done on the pieces of a finished text, so that no decoded
    character is read as markup."""
    def run(column: pa.Array) -> pa.Array:
        bounds = pa.array([0, *(int(x) for x in _until(column))], pa.int32())
        return pa.ListArray.from_arrays(bounds, decoded(column.flatten()))
    return F.arrow_udf(run, "array<string>")(parts)


def _until(column: pa.ListArray):
    total = 0
    for n in column.value_lengths().to_pylist():
        total += n or 0
        yield total
