"""Stemming (T2) as column expressions.

The default is the S-stemmer (Harman, 1991), three ordered suffix rules that need no
dictionary and run inside whole-stage codegen. Tokens are lower-cased first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkstats.functions.snowball import PROGRAMS, snowball_stem

def s_stem(token: Column) -> Column:
    """S-stemmer on a lower-cased token.

    1. "-ies" -> "-y", unless the word ends in "eies" or "aies";
    2. else "-es" -> "-e", unless it ends in "aes", "ees" or "oes";
    3. else drop a final "s", unless it ends in "us" or "ss".
    """
    t = F.lower(token)
    rule1 = t.endswith("ies") & ~t.endswith("eies") & ~t.endswith("aies")
    rule2 = t.endswith("es") & ~t.endswith("aes") & ~t.endswith("ees") & ~t.endswith("oes")
    rule3 = t.endswith("s") & ~t.endswith("us") & ~t.endswith("ss")
    n = F.length(t)
    drop_last = t.substr(F.lit(1), n - 1)
    return (F.when(rule1, F.concat(t.substr(F.lit(1), n - 3), F.lit("y")))
            .when(rule2, drop_last)
            .when(rule3, drop_last)
            .otherwise(t))


STEMMERS = {"s": s_stem}
TABLE_STEMMERS = ("porter", *PROGRAMS)
# The stemmer of a language, by the codes of the corpus; other languages keep their words.
BY_LANGUAGE = {"en": "porter", "de": "german", "fr": "french", "es": "spanish"}


def stem(token: Column, algorithm: str = "s") -> Column:
    """Column-expression stemmers (cheap enough to run on every word)."""
    try:
        return STEMMERS[algorithm](token)
    except KeyError:
        raise ValueError(f"stemmer {algorithm!r} is not a column expression; known: {sorted(STEMMERS)}; "
                         f"table stemmers: {TABLE_STEMMERS}") from None


# ---- Porter (1980) ------------------------------------------------------------------
# Each step refers to its input many times, so the stemmer is a chain of projections over
# named columns (never one nested expression), applied to distinct tokens only.

# The suffix rules of the Porter (1980) algorithm, steps 2, 3 and 4.
PORTER_STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
                ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
                ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
                ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
                ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble")]
PORTER_STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
                ("ful", ""), ("ness", "")]
PORTER_STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
                "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]


def _cv(w: Column) -> Column:
    """'V' or 'C' per character: a, e, i, o, u are vowels, and y after a consonant."""
    s = F.regexp_replace(w, "[aeiou]", "V")
    plain = F.regexp_replace(s, "[^V]", "C")
    s = F.regexp_replace(s, "[^Vy]", "C")
    s = F.regexp_replace(s, "Cy", "CV")  # the first y of a run after a consonant
    # What is left of a run stands at the beginning or after a vowel: C, V, C, ... by position.
    s = F.replace(F.replace(s, F.lit("yy"), F.lit("CV")), F.lit("y"), F.lit("C"))
    return F.when(w.contains("y"), s).otherwise(plain)


def _measure(cv: Column, n) -> Column:
    """m of the first n characters: the number of vowel -> consonant changes ('VC' pairs)."""
    p = F.substring(cv, 1, n)
    return ((F.length(p) - F.length(F.replace(p, F.lit("VC"), F.lit("")))) / 2).cast("int")


def _has_vowel(cv: Column, n) -> Column:
    return F.substring(cv, 1, n).contains("V")


def _double_consonant(w: Column, cv: Column, n) -> Column:
    return ((n >= 2) & (F.substring(w, n, 1) == F.substring(w, n - 1, 1))
            & (F.substring(cv, n, 1) == F.lit("C")))


def _cvc(w: Column, cv: Column, n) -> Column:
    return ((n >= 3) & (F.substring(cv, n - 2, 3) == F.lit("CVC"))
            & ~F.substring(w, n, 1).isin("w", "x", "y"))


def _head(w: Column, n) -> Column:
    return F.substring(w, 1, n)


def _cv_literal(text: str) -> str:
    """Consonant/vowel pattern of a replacement literal (none of them contains a 'y')."""
    assert "y" not in text
    return "".join("V" if ch in "aeiou" else "C" for ch in text)


def _set(frame, w, cv):
    """Next state of the chain: the word and its consonant/vowel pattern. The pattern of a
    prefix is the prefix of the pattern, so it is cut and extended, never recomputed."""
    return frame.select(*[c for c in frame.columns if c not in ("_w", "_cv")], w.alias("_w"), cv.alias("_cv"))


def _cut(cv, n):
    return F.substring(cv, 1, n)


def _step1a(frame):
    w, cv = F.col("_w"), F.col("_cv")
    n = F.length(w)
    k = (F.when(w.endswith("sses") | w.endswith("ies"), F.lit(2)).when(w.endswith("ss"), F.lit(0))
         .when(w.endswith("s"), F.lit(1)).otherwise(F.lit(0)))
    return _set(frame.withColumn("_k", k), _head(w, n - F.col("_k")), _cut(cv, n - F.col("_k"))).drop("_k")


def _step1b(frame):
    w, cv = F.col("_w"), F.col("_cv")
    n = F.length(w)
    ed = w.endswith("ed") & ~w.endswith("eed") & _has_vowel(cv, n - 2)
    ing = w.endswith("ing") & _has_vowel(cv, n - 3)
    k = (F.when(w.endswith("eed"), F.when(_measure(cv, n - 3) > 0, F.lit(1)).otherwise(F.lit(0)))
         .when(ed, F.lit(2)).when(ing, F.lit(3)).otherwise(F.lit(0)))
    frame = frame.withColumn("_tidy", ed | ing).withColumn("_k", k)
    frame = _set(frame, _head(w, n - F.col("_k")), _cut(cv, n - F.col("_k"))).drop("_k")
    w, cv = F.col("_w"), F.col("_cv")
    n = F.length(w)
    add_e = (w.endswith("at") | w.endswith("bl") | w.endswith("iz")
             | ((_measure(cv, n) == 1) & _cvc(w, cv, n)
                & ~(_double_consonant(w, cv, n) & ~(w.endswith("l") | w.endswith("s") | w.endswith("z")))))
    drop_last = (~(w.endswith("at") | w.endswith("bl") | w.endswith("iz"))
                 & _double_consonant(w, cv, n) & ~(w.endswith("l") | w.endswith("s") | w.endswith("z")))
    tidy = F.col("_tidy")
    new_w = (F.when(tidy & add_e, F.concat(w, F.lit("e"))).when(tidy & drop_last, _head(w, n - 1)).otherwise(w))
    new_cv = (F.when(tidy & add_e, F.concat(cv, F.lit("V"))).when(tidy & drop_last, _cut(cv, n - 1)).otherwise(cv))
    return _set(frame, new_w, new_cv).drop("_tidy")


def _step1c(frame):
    w, cv = F.col("_w"), F.col("_cv")
    n = F.length(w)
    hit = w.endswith("y") & _has_vowel(cv, n - 1)
    return _set(frame, F.when(hit, F.concat(_head(w, n - 1), F.lit("i"))).otherwise(w),
                F.when(hit, F.concat(_cut(cv, n - 1), F.lit("V"))).otherwise(cv))


def _rule_step(frame, rules, min_m: int):
    """Steps 2-4: the longest matching suffix is chosen first (a CASE over literals),
    then replaced when m(stem) > min_m; 'ion' also needs the stem to end in s or t."""
    w = F.col("_w")
    pick = None
    for suffix, repl in sorted(rules, key=lambda r: -len(r[0])):
        v = F.struct(F.lit(len(suffix)).alias("k"), F.lit(repl).alias("r"), F.lit(_cv_literal(repl)).alias("rcv"))
        pick = F.when(w.endswith(suffix), v) if pick is None else pick.when(w.endswith(suffix), v)
    frame = frame.withColumn("_sfx", pick)
    w, cv = F.col("_w"), F.col("_cv")
    stem_len = F.length(w) - F.col("_sfx.k")
    ok = F.col("_sfx").isNotNull() & (_measure(cv, stem_len) > min_m)
    ok = ok & ~(w.endswith("ion") & (F.col("_sfx.k") == 3) & ~F.substring(w, stem_len, 1).isin("s", "t"))
    frame = frame.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    return _set(frame,
                F.when(F.col("_ok"), F.concat(_head(w, stem_len), F.col("_sfx.r"))).otherwise(w),
                F.when(F.col("_ok"), F.concat(_cut(cv, stem_len), F.col("_sfx.rcv"))).otherwise(cv)).drop("_sfx", "_ok")


def _step5(frame):
    w, cv = F.col("_w"), F.col("_cv")
    n = F.length(w)
    m = _measure(cv, n - 1)
    hit = w.endswith("e") & ((m > 1) | ((m == 1) & ~_cvc(w, cv, n - 1)))
    frame = _set(frame, F.when(hit, _head(w, n - 1)).otherwise(w), F.when(hit, _cut(cv, n - 1)).otherwise(cv))
    w, cv = F.col("_w"), F.col("_cv")
    n = F.length(w)
    hit = (_measure(cv, n) > 1) & _double_consonant(w, cv, n) & w.endswith("l")
    return _set(frame, F.when(hit, _head(w, n - 1)).otherwise(w), F.when(hit, _cut(cv, n - 1)).otherwise(cv))


def porter_stem(df, token_col: str = "token", out_col: str = "stem"):
    """Porter (1980) stems of lower-cased ``token_col`` as a new column ``out_col``.
    Words of one or two letters are kept as they are."""
    keep = [c for c in df.columns if c != out_col]
    cur = df.select(*keep, F.lower(F.col(token_col)).alias("_w"))
    cur = cur.withColumn("_cv", _cv(F.col("_w"))).withColumn("_short", F.length(F.col("_w")) <= 2)
    cur = _step1a(cur)
    cur = _step1b(cur)
    cur = _step1c(cur)
    cur = _rule_step(cur, PORTER_STEP2, 0)
    cur = _rule_step(cur, PORTER_STEP3, 0)
    cur = _rule_step(cur, [(x, "") for x in PORTER_STEP4], 1)
    cur = _step5(cur)
    return cur.select(*keep, F.when(F.col("_short"), F.lower(F.col(token_col))).otherwise(F.col("_w")).alias(out_col))


def stem_table(df, token_col: str = "token", out_col: str = "stem", algorithm: str = "s", spread: bool = True):
    """``df`` with a stem column, for any algorithm (column or projection-chain stemmer).
    The chains are CPU work on a usually small distinct-token table, so the table is
    hash-spread by token over the default parallelism first, unless its rows are to stay
    where they are, in their order (``spread=False``)."""
    if algorithm in TABLE_STEMMERS:
        if spread:
            df = df.repartition(df.sparkSession.sparkContext.defaultParallelism, token_col)
        return porter_stem(df, token_col, out_col) if algorithm == "porter" else snowball_stem(df, algorithm, token_col, out_col)
    return df.withColumn(out_col, stem(F.col(token_col), algorithm))
