"""DuckDB SQL of the stemmers, for the oracle of the queries that stem.

Porter's algorithm is written out here in SQL of its own. The Snowball languages are the
steps of ``functions/snowball.py`` as nested queries; what checks those steps are the
published vocabularies in the tests.
"""

from __future__ import annotations

from linkstats.functions import snowball as sb

DUCKDB = sb.Dialect(group="\\", last=", 'g'")

# Suffix rules of the published algorithm of 1980, longest match first by length.
STEP2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al",
         "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
         "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble"}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = {s: "" for s in ("al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize").split()}


def _kinds(word: str) -> str:
    """C or V for every letter, from left to right: y is a vowel after a consonant."""
    return (f"list_reduce(list_prepend('', string_split({word}, '')), lambda done, c: done || CASE WHEN c IN ('a','e','i','o','u') "
            f"OR (c = 'y' AND right(done, 1) = 'C') THEN 'V' ELSE 'C' END)")


def _m(kinds: str) -> str:
    return f"((length({kinds}) - length(replace({kinds}, 'VC', ''))) // 2)"


def _chain(source: str, steps: list[dict[str, str]]) -> str:
    """Nested queries: every step sets columns of the query below it."""
    sql = source
    for i, step in enumerate(steps):
        new = [f"{e} AS {c}" for c, e in step.items()]
        sql = f"SELECT * REPLACE ({', '.join(new)}) FROM ({sql}) AS q{i}"
    return sql


def porter(tokens: str) -> str:
    """(token, stem) for a query with a column ``token`` of lower-cased words."""
    kinds = {"k": _kinds("w")}
    short = "left(w, length(w) - {0})".format
    cvc = "(right(k, 3) = 'CVC' AND right(w, 1) NOT IN ('w', 'x', 'y'))"
    double = "(length(w) > 1 AND right(w, 1) = right(left(w, length(w) - 1), 1) AND right(k, 1) = 'C')"

    def rules(table: dict[str, str], above: int) -> list[dict[str, str]]:
        new = "CASE s " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table.items()) + " END"
        stem = "left(k, length(w) - length(s))"
        fits = f"{_m(stem)} > {above} AND NOT (s = 'ion' AND right(left(w, length(w) - 3), 1) NOT IN ('s', 't'))"
        return [kinds, {"s": sb.longest(list(table), word="w")}, {"w": f"CASE WHEN s IS NOT NULL AND {fits} THEN left(w, length(w) - length(s)) || {new} ELSE w END"}]

    steps = [
        {"w": f"CASE WHEN right(w, 4) = 'sses' OR right(w, 3) = 'ies' THEN {short(2)} WHEN right(w, 2) = 'ss' THEN w "
              f"WHEN right(w, 1) = 's' THEN {short(1)} ELSE w END"}, kinds,
        {"s": f"CASE WHEN right(w, 3) = 'eed' THEN CASE WHEN {_m('left(k, length(w) - 3)')} > 0 THEN 'd' END "
              f"WHEN right(w, 2) = 'ed' AND contains(left(k, length(w) - 2), 'V') THEN 'ed' "
              f"WHEN right(w, 3) = 'ing' AND contains(left(k, length(w) - 3), 'V') THEN 'ing' END"},
        {"w": "CASE WHEN s IS NULL THEN w ELSE left(w, length(w) - length(s)) END"}, kinds,
        {"w": f"CASE WHEN s IS NULL OR s = 'd' THEN w WHEN right(w, 2) IN ('at', 'bl', 'iz') THEN w || 'e' "
              f"WHEN {double} AND right(w, 1) NOT IN ('l', 's', 'z') THEN {short(1)} WHEN {_m('k')} = 1 AND {cvc} THEN w || 'e' ELSE w END"}, kinds,
        {"w": f"CASE WHEN right(w, 1) = 'y' AND contains(left(k, length(w) - 1), 'V') THEN {short(1)} || 'i' ELSE w END"},
        *rules(STEP2, 0), *rules(STEP3, 0), *rules(STEP4, 1), kinds,
        {"s": short(1), "k": "left(k, length(w) - 1)"},
        {"w": f"CASE WHEN right(w, 1) = 'e' AND ({_m('k')} > 1 OR ({_m('k')} = 1 AND NOT {cvc.replace('right(w, 1)', 'right(s, 1)')})) THEN s ELSE w END"}, kinds,
        {"w": f"CASE WHEN {_m('k')} > 1 AND {double} AND right(w, 1) = 'l' THEN {short(1)} ELSE w END"},
    ]
    start = f"SELECT token, token AS w, '' AS k, CAST(NULL AS VARCHAR) AS s FROM ({tokens})"
    return f"SELECT token, CASE WHEN length(token) <= 2 THEN token ELSE w END AS stem FROM ({_chain(start, steps)})"


def snowball(language: str, tokens: str) -> str:
    """(token, stem) by the steps of one language."""
    sql, have = f"SELECT token, token AS _w FROM ({tokens})", ["token", "_w"]
    for i, step in enumerate(sb.program(language, DUCKDB)):
        kept = [c for c in have if c not in step]
        have = kept + list(step)
        sql = f"SELECT {', '.join(kept + [f'{e} AS {c}' for c, e in step.items()])} FROM ({sql}) AS q{i}"
    return f"SELECT token, _w AS stem FROM ({sql})"
