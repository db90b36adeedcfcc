"""German, French and Spanish stemmers (T2) by the published Snowball algorithms.

A stemmer is a chain of projections over a table of distinct words: the regions R1, R2 and
RV are found once as numbers of letters before them, then every step looks up the longest of
its suffixes (a CASE over the word's last letters) and cuts or replaces it where it lies in
its region. All steps are column expressions; the chain runs once for each distinct word.

The expressions are written in SQL that Spark and other engines read alike, apart from the
functions of :class:`Dialect`; ``program`` gives the steps of one language.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Step = dict[str, str]  # column -> expression over the columns before the step

# Vowels and suffixes of the published algorithms, in their order.
VOWELS = {"german": "aeiouyäöü", "french": "aeiouyâàëéêèïîôûù", "spanish": "aeiouáéíóúü"}

GERMAN_1 = "em ern er e en es s".split()
GERMAN_2 = "en er est st".split()
GERMAN_3 = "end ung ig ik isch lich heit keit".split()
GERMAN_BEFORE_S, GERMAN_BEFORE_ST = "bdfghklmnrt", "bdfghklmnt"

FRENCH_PLAIN = "ance iqUe isme able iste eux ances iqUes ismes ables istes".split()
FRENCH_ATION = "atrice ateur ation atrices ateurs ations".split()
FRENCH_LOG, FRENCH_U, FRENCH_ENT = "logie logies".split(), "usion ution usions utions".split(), "ence ences".split()
FRENCH_EMENT, FRENCH_ITE, FRENCH_IF = "ement ements".split(), "ité ités".split(), "if ive ifs ives".split()
FRENCH_EUSE, FRENCH_ISSEMENT, FRENCH_MENT = "euse euses".split(), "issement issements".split(), "ment ments".split()
FRENCH_I_VERB = ("îmes ît îtes i ie ies ir ira irai iraIent irais irait iras irent irez iriez irions irons iront is issaIent "
                 "issais issait issant issante issantes issants isse issent isses issez issiez issions issons it").split()
FRENCH_E_VERB = "é ée ées és èrent er era erai eraIent erais erait eras erez eriez erions erons eront ez iez".split()
FRENCH_A_VERB = ("âmes ât âtes a ai aIent ais ait ant ante antes ants as asse assent asses assiez assions").split()
FRENCH_REST = "ion ier ière Ier Ière e ë".split()

SPANISH_PRONOUN = "me se sela selo selas selos la le lo las les los nos".split()
SPANISH_ACCENTED = {"iéndo": "iendo", "ándo": "ando", "ár": "ar", "ér": "er", "ír": "ir"}
SPANISH_BARE = "ando iendo ar er ir".split()
SPANISH_PLAIN = ("anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas amiento amientos "
                 "imiento imientos").split()
SPANISH_ADOR = "adora ador ación adoras adores aciones ante antes ancia ancias".split()
SPANISH_LOG, SPANISH_U, SPANISH_ENTE = "logía logías".split(), "ución uciones".split(), "encia encias".split()
SPANISH_IDAD, SPANISH_IVA = "idad idades".split(), "iva ivo ivas ivos".split()
SPANISH_Y_VERB = "ya ye yan yen yeron yendo yo yó yas yes yais yamos".split()
SPANISH_GU_VERB = "en es éis emos".split()
SPANISH_VERB = ("arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos "
                "eremos erá eré irían irías irán irás iríais iría iréis iríamos iremos irá iré aba ada ida ía ara iera ad ed "
                "id ase iese aste iste an aban ían aran ieran asen iesen aron ieron ado ido ando iendo ió ar er ir as abas "
                "adas idas ías aras ieras ases ieses ís áis abais íais arais ierais aseis ieseis asteis isteis ados idos "
                "amos ábamos íamos imos áramos iéramos iésemos ásemos").split()
SPANISH_REST = "os a o á í ó e é".split()


@dataclass(frozen=True)
class Dialect:
    """How an engine writes a replacement of all matches."""
    group: str = "$"
    last: str = ""

    def replace(self, value: str, pattern: str, replacement: str) -> str:
        return f"regexp_replace({value}, '{pattern}', '{replacement.replace('$', self.group)}'{self.last})"


SPARK = Dialect()


def among(suffixes: list[str]) -> str:
    return "(" + ", ".join(f"'{s}'" for s in suffixes) + ")"


def longest(suffixes: list[str], region: str | None = None, word: str = "_w") -> str:
    """The longest of the suffixes that the word ends with (from ``region`` on), else null."""
    out = []
    for n in sorted({len(s) for s in suffixes}, reverse=True):
        inside = f" AND length({word}) - {n} >= {region}" if region else ""
        out.append(f"WHEN right({word}, {n}) IN {among([s for s in suffixes if len(s) == n])}{inside} THEN right({word}, {n})")
    return f"CASE {' '.join(out)} END"


def ends(suffix: str, region: str | None = None, word: str = "_w") -> str:
    inside = f" AND length({word}) - {len(suffix)} >= {region}" if region else ""
    return f"(right({word}, {len(suffix)}) = '{suffix}'{inside})"


def cut(n: int | str, word: str = "_w") -> str:
    return f"left({word}, length({word}) - {n})"


def _case(*branches: tuple[str, str], other: str = "_w") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in branches) + f" ELSE {other} END"


def _suffix(suffixes: list[str], region: str | None = None) -> list[Step]:
    """_s: the longest suffix, _b: the word without it (null without one)."""
    return [{"_s": longest(suffixes, region)}, {"_b": "left(_w, length(_w) - length(_s))"}]


def _regions(v: str) -> list[Step]:
    """_n, and the ends of R1's and R2's prefixes (0 where there is none)."""
    one = f"[^{v}]*[{v}]+[^{v}]"
    return [{"_n": "length(_w)", "_1": f"length(regexp_extract(_w, '^{one}', 0))",
             "_2": f"length(regexp_extract(_w, '^{one}{one}', 0))"}]


def german(d: Dialect) -> list[Step]:
    v = VOWELS["german"]
    after = "right(_b, 1)"
    return [
        {"_w": "replace(_w, 'ß', 'ss')"},
        {"_w": d.replace("_w", f"([{v}])([uy])([{v}])", "$1~$2$3")},
        {"_w": "replace(replace(_w, '~u', 'U'), '~y', 'Y')"},
        *_regions(v),
        {"_p1": "CASE WHEN _n < 3 OR _1 = 0 THEN _n WHEN _1 < 3 THEN 3 ELSE _1 END",
         "_p2": "CASE WHEN _n < 3 OR _2 = 0 THEN _n ELSE _2 END"},
        *_suffix(GERMAN_1),
        {"_w": _case(("_s IS NULL OR length(_b) < _p1", "_w"),
                     ("_s = 's'", _case((f"{after} IN {among(list(GERMAN_BEFORE_S))}", "_b"))),
                     (f"_s IN ('e', 'en', 'es') AND {ends('niss', word='_b')}", cut(1, "_b")), other="_b")},
        *_suffix(GERMAN_2),
        {"_w": _case(("_s IS NULL OR length(_b) < _p1", "_w"),
                     ("_s = 'st'", _case((f"{after} IN {among(list(GERMAN_BEFORE_ST))} AND length(_b) >= 4", "_b"))), other="_b")},
        *_suffix(GERMAN_3),
        {"_k": f"CASE WHEN length(_b) >= _p2 AND NOT (_s IN ('ig', 'ik', 'isch') AND {after} = 'e') THEN _s END"},
        {"_w": _case(("_k IS NOT NULL", "_b"))},
        {"_w": _case((f"_k IN ('end', 'ung') AND {ends('ig', '_p2')} AND right({cut(2)}, 1) <> 'e'", cut(2)),
                     (f"_k IN ('lich', 'heit') AND ({ends('er', '_p1')} OR {ends('en', '_p1')})", cut(2)),
                     (f"_k = 'keit' AND {ends('lich')}", _case((ends("lich", "_p2"), cut(4)))),
                     (f"_k = 'keit' AND {ends('ig', '_p2')}", cut(2)))},
        {"_w": "translate(_w, 'UYäöü', 'uyaou')"},
    ]


def french(d: Dialect) -> list[Step]:
    v = VOWELS["french"]
    vowel, r2, r1 = among(list(v)), "length(_b) >= _p2", "length(_b) >= _p1"
    all_1 = (FRENCH_PLAIN + FRENCH_ATION + FRENCH_LOG + FRENCH_U + FRENCH_ENT + FRENCH_EMENT + FRENCH_ITE + FRENCH_IF + ["eaux", "aux"]
             + FRENCH_EUSE + FRENCH_ISSEMENT + ["amment", "emment"] + FRENCH_MENT)
    or_iqu = lambda word: _case((f"length({word}) - 2 >= _p2", cut(2, word)), other=f"concat({cut(2, word)}, 'iqU')")
    return [
        {"_w": d.replace("_w", f"([{v}])([ui])([{v}])|([{v}])(y)|(y)([{v}])|(q)(u)", "$1$4$8~$2$5$6$9$3$7")},
        {"_w": "replace(replace(replace(_w, '~u', 'U'), '~i', 'I'), '~y', 'Y')"},
        *_regions(v),
        {"_p1": "CASE WHEN _1 = 0 THEN _n ELSE _1 END", "_p2": "CASE WHEN _2 = 0 THEN _n ELSE _2 END",
         "_v": f"length(regexp_extract(_w, '^.[^{v}]*[{v}]', 0))",
         "_two": f"length(regexp_extract(_w, '^[{v}][{v}].', 0))"},
        {"_pv": "CASE WHEN _two > 0 OR left(_w, 3) IN ('par', 'col', 'tap') THEN 3 WHEN _v > 0 THEN _v ELSE _n END"},
        # standard suffixes; _k says which rule held, 'again' that verb suffixes are tried all the same
        *_suffix(all_1),
        {"_k": f"""CASE WHEN _s IN {among(FRENCH_PLAIN)} AND {r2} THEN 'plain' WHEN _s IN {among(FRENCH_ATION)} AND {r2} THEN 'ation'
                   WHEN _s IN {among(FRENCH_LOG)} AND {r2} THEN 'log' WHEN _s IN {among(FRENCH_U)} AND {r2} THEN 'u'
                   WHEN _s IN {among(FRENCH_ENT)} AND {r2} THEN 'ent'
                   WHEN _s IN {among(FRENCH_EMENT)} AND length(_b) >= _pv THEN 'ement'
                   WHEN _s IN {among(FRENCH_ITE)} AND {r2} THEN 'ite' WHEN _s IN {among(FRENCH_IF)} AND {r2} THEN 'if'
                   WHEN _s = 'eaux' THEN 'eau' WHEN _s = 'aux' AND {r1} THEN 'al'
                   WHEN _s IN {among(FRENCH_EUSE)} AND {r2} THEN 'plain' WHEN _s IN {among(FRENCH_EUSE)} AND {r1} THEN 'eux'
                   WHEN _s IN {among(FRENCH_ISSEMENT)} AND {r1} AND _b <> '' AND right(_b, 1) NOT IN {vowel} THEN 'plain'
                   WHEN _s IN ('amment', 'emment') AND length(_b) >= _pv THEN 'again'
                   WHEN _s IN {among(FRENCH_MENT)} AND right(_b, 1) IN {vowel} AND length(_b) - 1 >= _pv THEN 'again' END"""},
        {"_w": _case(("_k IS NULL", "_w"), ("_k IN ('log', 'u', 'ent', 'eau', 'al', 'eux')", "concat(_b, _k)"),
                     ("_s = 'amment'", "concat(_b, 'ant')"), ("_s = 'emment'", "concat(_b, 'ent')"), other="_b")},
        {"_t": f"""CASE WHEN _k = 'ation' AND {ends('ic')} THEN 'ic' WHEN _k = 'ement' THEN {longest(['iv', 'eus', 'abl', 'iqU', 'ièr', 'Ièr'])}
                   WHEN _k = 'ite' THEN {longest(['abil', 'ic', 'iv'])} WHEN _k = 'if' AND {ends('at', '_p2')} THEN 'at' END"""},
        {"_w": _case(("_t = 'ic'", or_iqu("_w")),
                     ("_t IN ('iv', 'at') AND length(_w) - 2 >= _p2", cut(2)),
                     ("_t = 'eus' AND length(_w) - 3 >= _p2", cut(3)),
                     ("_t = 'eus' AND length(_w) - 3 >= _p1", f"concat({cut(3)}, 'eux')"),
                     ("_t IN ('abl', 'iqU') AND length(_w) - 3 >= _p2", cut(3)),
                     ("_t IN ('ièr', 'Ièr') AND length(_w) - 3 >= _pv", f"concat({cut(3)}, 'i')"),
                     ("_t = 'abil' AND length(_w) - 4 >= _p2", cut(4)), ("_t = 'abil'", f"concat({cut(4)}, 'abl')")),
         "_t": "CASE WHEN _k = 'ement' AND _t = 'iv' AND length(_w) - 2 >= _p2 THEN 'at' WHEN _t = 'at' THEN 'ic' END"},
        {"_w": _case((f"_t = 'at' AND {ends('at', '_p2')}", cut(2)), (f"_t = 'ic' AND {ends('ic')}", or_iqu("_w")))},
        {"_done": "_k IS NOT NULL AND _k <> 'again'"},
        *_suffix(FRENCH_I_VERB, "_pv"),
        {"_hit": f"NOT _done AND _s IS NOT NULL AND length(_b) - 1 >= _pv AND right(_b, 1) NOT IN {vowel}"},
        {"_w": _case(("_hit", "_b")), "_done": "_done OR coalesce(_hit, false)"},
        *_suffix(["ions"] + FRENCH_E_VERB + FRENCH_A_VERB, "_pv"),
        {"_hit": f"NOT _done AND _s IS NOT NULL AND (_s <> 'ions' OR {r2})"},
        {"_w": _case((f"_hit AND _s IN {among(FRENCH_A_VERB)} AND {ends('e', '_pv', '_b')}", cut(1, "_b")), ("_hit", "_b")),
         "_done": "_done OR coalesce(_hit, false)"},
        {"_w": _case(("_done AND right(_w, 1) = 'Y'", f"concat({cut(1)}, 'i')"), ("_done AND right(_w, 1) = 'ç'", f"concat({cut(1)}, 'c')"),
                     ("NOT _done AND length(_w) > 1 AND right(_w, 1) = 's' AND right(left(_w, length(_w) - 1), 1) NOT IN "
                      "('a', 'i', 'o', 'u', 'è', 's')", cut(1)))},
        *_suffix(FRENCH_REST, "_pv"),
        {"_w": _case(("_done OR _s IS NULL", "_w"),
                     ("_s = 'ion'", _case((f"{r2} AND length(_b) - 1 >= _pv AND right(_b, 1) IN ('s', 't')", "_b"))),
                     ("_s = 'e'", "_b"), ("_s = 'ë'", _case((ends("gu", "_pv", "_b"), "_b"))), other="concat(_b, 'i')")},
        {"_w": _case(("right(_w, 3) IN ('enn', 'onn', 'ett', 'ell') OR right(_w, 4) = 'eill'", cut(1)))},
        {"_w": d.replace("_w", f"[éè]([^{v}]+)$", "e$1")},
        {"_w": "translate(_w, 'IUY', 'iuy')"},
    ]


def spanish(d: Dialect) -> list[Step]:
    v = VOWELS["spanish"]
    r1, r2, rv = "length(_b) >= _p1", "length(_b) >= _p2", "length(_b) >= _pv"
    before = list(SPANISH_ACCENTED) + SPANISH_BARE + ["yendo"]
    accented = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in SPANISH_ACCENTED.items())
    all_1 = (SPANISH_PLAIN + SPANISH_ADOR + SPANISH_LOG + SPANISH_U + SPANISH_ENTE + ["amente", "mente"] + SPANISH_IDAD + SPANISH_IVA)
    return [
        *_regions(v),
        {"_p1": "CASE WHEN _1 = 0 THEN _n ELSE _1 END", "_p2": "CASE WHEN _2 = 0 THEN _n ELSE _2 END",
         "_v": f"length(regexp_extract(_w, '^([{v}][^{v}]+[{v}]|[{v}][{v}]+[^{v}]|[^{v}][^{v}]+[{v}]|[^{v}][{v}].)', 0))"},
        {"_pv": "CASE WHEN _v = 0 THEN _n ELSE _v END"},
        # a pronoun goes where a verb form lies before it, whose accent goes with it
        *_suffix(SPANISH_PRONOUN),
        {"_t": longest(before, word="_b")},
        {"_w": _case(("_s IS NULL OR _t IS NULL OR length(_b) - length(_t) < _pv", "_w"),
                     (f"_t IN {among(list(SPANISH_ACCENTED))}", f"concat({cut('length(_t)', '_b')}, CASE _t {accented} END)"),
                     (f"_t IN {among(SPANISH_BARE)}", "_b"), (ends("uyendo", word="_b"), "_b"))},
        *_suffix(all_1),
        {"_k": f"""CASE WHEN _s IN {among(SPANISH_PLAIN)} AND {r2} THEN 'plain' WHEN _s IN {among(SPANISH_ADOR)} AND {r2} THEN 'ador'
                   WHEN _s IN {among(SPANISH_LOG)} AND {r2} THEN 'log' WHEN _s IN {among(SPANISH_U)} AND {r2} THEN 'u'
                   WHEN _s IN {among(SPANISH_ENTE)} AND {r2} THEN 'ente' WHEN _s = 'amente' AND {r1} THEN 'amente'
                   WHEN _s = 'mente' AND {r2} THEN 'mente' WHEN _s IN {among(SPANISH_IDAD)} AND {r2} THEN 'idad'
                   WHEN _s IN {among(SPANISH_IVA)} AND {r2} THEN 'iva' END"""},
        {"_w": _case(("_k IN ('log', 'u', 'ente')", "concat(_b, _k)"), ("_k IS NOT NULL", "_b"))},
        {"_t": f"""CASE _k WHEN 'ador' THEN {longest(['ic'], '_p2')}
                   WHEN 'amente' THEN CASE WHEN {ends('iv')} OR {ends('os')} OR {ends('ic')} OR {ends('ad')} THEN {longest(['iv', 'os', 'ic', 'ad'], '_p2')} END
                   WHEN 'mente' THEN CASE WHEN {longest(['ante', 'able', 'ible'], '_p2')} IS NOT NULL THEN right(_w, 4) END
                   WHEN 'idad' THEN CASE WHEN {ends('abil')} THEN {longest(['abil'], '_p2')} ELSE {longest(['ic', 'iv'], '_p2')} END
                   WHEN 'iva' THEN {longest(['at'], '_p2')} END"""},
        {"_w": _case(("_t IS NOT NULL", cut("length(_t)")))},
        {"_w": _case((f"_k = 'amente' AND _t = 'iv' AND {ends('at', '_p2')}", cut(2))), "_done": "_k IS NOT NULL"},
        *_suffix(SPANISH_Y_VERB, "_pv"),
        {"_hit": f"NOT _done AND _s IS NOT NULL AND {ends('u', word='_b')}"},
        {"_w": _case(("_hit", "_b")), "_done": "_done OR coalesce(_hit, false)"},
        *_suffix(SPANISH_GU_VERB + SPANISH_VERB, "_pv"),
        {"_w": _case(("_done OR _s IS NULL", "_w"), (f"_s IN {among(SPANISH_GU_VERB)} AND {ends('gu', word='_b')}", cut(1, "_b")), other="_b")},
        *_suffix(SPANISH_REST),
        {"_w": _case((f"_s IS NULL OR NOT ({rv})", "_w"),
                     (f"_s IN ('e', 'é') AND {ends('gu', word='_b')} AND length(_b) - 1 >= _pv", cut(1, "_b")), other="_b")},
        {"_w": "translate(_w, 'áéíóú', 'aeiou')"},
    ]


PROGRAMS = {"german": german, "french": french, "spanish": spanish}


def program(language: str, dialect: Dialect = SPARK) -> list[Step]:
    return PROGRAMS[language](dialect)


def snowball_stem(df: DataFrame, language: str, token_col: str = "token", out_col: str = "stem") -> DataFrame:
    """``df`` with the stems of its lower-cased tokens in ``out_col``; a null token has none.
    Columns of ``df`` must not begin with an underscore."""
    keep = [c for c in df.columns if c != out_col]
    frame = df.select(*keep, F.lower(F.col(token_col)).alias("_w"))
    for step in program(language):
        kept = [c for c in frame.columns if c not in step]
        frame = frame.select(*kept, *[F.expr(e).alias(c) for c, e in step.items()])
    return frame.select(*keep, F.col("_w").alias(out_col))
