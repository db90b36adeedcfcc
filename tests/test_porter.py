"""Porter (1980) stemmer as Spark column projections, checked on the paper's examples."""

from pyspark.sql import functions as F

from linkstats.functions.stem import _cv, porter_stem
from linkstats.operators import context as cx

# Examples worked through in the published description of the algorithm (step by step).
EXAMPLES = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor",
    "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
    "rational": "ration", "valenci": "valenc", "hesitanci": "hesit", "digitizer": "digit",
    "conformabli": "conform", "radicalli": "radic", "differentli": "differ", "vileli": "vile",
    "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic", "operator": "oper",
    "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous",
    "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic",
    "formative": "form", "formalize": "formal", "electriciti": "electr", "electrical": "electr",
    "hopeful": "hope", "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer",
    "airliner": "airlin", "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens",
    "irritant": "irrit", "replacement": "replac", "adjustment": "adjust", "dependent": "depend",
    "adoption": "adopt", "homologou": "homolog", "communism": "commun", "activate": "activ",
    "angulariti": "angular", "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    "generalizations": "gener", "oscillators": "oscil", "playing": "plai", "renamed": "renam",
    "a": "a", "be": "be", "syzygy": "syzygi", "boy": "boi",
}


def test_runs_of_y(spark):
    """Consonant or vowel by position in a run of any length, against the rule itself."""
    words = ["y" * n for n in range(1, 12)] + [a + "y" * n + b for n in range(1, 12) for a in "xa" for b in ("", "s", "o")] + ["syzygy"]

    def rule(w):
        out = ""
        for ch in w:
            out += "V" if ch in "aeiou" or (ch == "y" and out[-1:] == "C") else "C"
        return out

    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r["w"]: r["cv"] for r in df.select("w", _cv(F.col("w")).alias("cv")).collect()}
    assert got == {w: rule(w) for w in words}


def test_porter_examples(spark):
    df = spark.createDataFrame([(w,) for w in EXAMPLES], "token string")
    got = {r["token"]: r["stem"] for r in porter_stem(df).collect()}
    assert {w: got[w] for w in EXAMPLES if got[w] != EXAMPLES[w]} == {}


def test_porter_vectors(spark):
    paragraphs = spark.createDataFrame([("k1", "Playing players played; the generalizations")],
                                       "para_key string, para string")
    pairs = spark.createDataFrame([("X", "k1")], "uri string, para_key string")
    stops = spark.createDataFrame([("the",)], "word string")
    got = dict((r["uri"], r["vector"]) for r in cx.context_vectors(pairs, paragraphs, stops, algorithm="porter").collect())
    assert got["http://en.wikipedia.org/wiki/X"] == "(plai,2),(gener,1),(player,1)"
