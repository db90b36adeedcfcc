"""T1 tokenising, P6 vocabulary ids, M1/M2 spotting against brute force."""

import regex
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from conftest import rows
from linkstats.operators import spotting as sp
from linkstats.operators import tokens as tk

WORD = regex.compile(r"[\p{L}\p{N}]+")


def brute_tokens(text):
    return [(m.group(), m.start()) for m in WORD.finditer(text)]


def brute_spots(text, entries):
    """All (sf, offset) where an entry's words occur in a row (separators free)."""
    toks = [(m.group(), m.start(), m.end()) for m in WORD.finditer(text)]
    keys = {tuple(WORD.findall(e)) for e in entries if WORD.findall(e)}
    out = set()
    for i in range(len(toks)):
        for key in keys:
            n = len(key)
            if tuple(t[0] for t in toks[i:i + n]) == key:
                out.add((text[toks[i][1]:toks[i + n - 1][2]], toks[i][1]))
    return out


def test_offsets_are_code_points(spark):
    texts = ["Café <b>crème</b>, naïve 😀 déjà-vu 42", "  leading blanks", "", "x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "wid long, text string")
    got = rows(tk.tokenize_offsets(df), "wid", "tpos", "token", "offset")
    want = sorted((i, k, tok, off) for i, t in enumerate(texts) for k, (tok, off) in enumerate(brute_tokens(t)))
    assert got == want
    # the astral character counts as one position (Python indexes code points too)
    assert dict((r[2], r[3]) for r in got if r[0] == 0)["déjà"] == texts[0].index("déjà")
    for wid, _, tok, off in got:
        assert texts[wid][off:off + len(tok)] == tok


def test_vocabulary_ids_dense_across_partitions(spark):
    sfs = spark.createDataFrame([(f"w{i:03d} x{i % 7}",) for i in range(200)], "sf string").repartition(5)
    v = tk.vocabulary(sfs)
    got = rows(v, "token", "token_id", "count")
    tokens = sorted({f"w{i:03d}" for i in range(200)} | {f"x{i}" for i in range(7)})
    assert [g[0] for g in got] == tokens
    assert sorted(g[1] for g in got) == list(range(1, len(tokens) + 1))
    by_token = {g[0]: g for g in got}
    assert [by_token[t][1] for t in tokens] == list(range(1, len(tokens) + 1))
    assert by_token["x0"][2] == len([i for i in range(200) if i % 7 == 0])
    stats = tk.vocabulary_stats(v).first()
    assert stats["vocab_size"] == len(tokens) and stats["max_token_id"] == len(tokens)


def test_lookup_unknown_is_zero(spark):
    vocab = tk.vocabulary(spark.createDataFrame([("alpha beta",)], "sf string"))
    toks = spark.createDataFrame([("alpha",), ("gamma",)], "token string")
    got = dict(rows(tk.lookup_tokens(toks, vocab), "token", "token_id"))
    assert got["gamma"] == 0 and got["alpha"] == 1


def test_multi_token_spots_cover_text(spark):
    texts = ["New York, new york and New-York; New  York City", "York New York"]
    entries = ["New York", "New York City", "York", "city"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "wid long, text string")
    d = sp.build_dictionary(spark.createDataFrame([(e,) for e in entries], "sf string"))
    assert d.max_n == 3
    got = rows(sp.spot(df, d).select("wid", "sf", "offset"))
    want = sorted((i, sf, off) for i, t in enumerate(texts) for sf, off in brute_spots(t, entries))
    assert got == want
    for wid, sf, off in got:
        assert texts[wid][off:off + len(sf)] == sf


words = st.sampled_from(["a", "b", "ab", "Ä", "1"])
seps = st.sampled_from([" ", ", ", "-", "  "])


@st.composite
def text_and_dict(draw):
    ws = draw(st.lists(words, min_size=0, max_size=12))
    ss = draw(st.lists(seps, min_size=len(ws), max_size=len(ws)))
    text = "".join(w + s for w, s in zip(ws, ss))
    entries = draw(st.lists(st.lists(words, min_size=1, max_size=3).map(" ".join), min_size=1, max_size=4))
    return text, entries


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(text_and_dict())
def test_spot_matches_brute_force(spark, case):
    text, entries = case
    df = spark.createDataFrame([(0, text)], "wid long, text string")
    got = set((r["sf"], r["offset"]) for r in sp.spot_surface_forms(
        df, spark.createDataFrame([(e,) for e in entries], "sf string")).collect())
    assert got == brute_spots(text, entries)
    d = sp.build_dictionary(spark.createDataFrame([(e,) for e in entries], "sf string"))
    chunked = set((r["sf"], r["offset"]) for r in sp.spot(df, d, chunk_words=1).collect())
    assert chunked == brute_spots(text, entries)


def test_entries_with_a_hot_beginning(spark):
    """Entries that begin alike cost each place one key, and are still told apart."""
    texts = [(0, "the " * 300), (1, "the the the the the end. the the the the the the end")]
    entries = ["the the the the the e%d" % i for i in range(500)] + ["the the the the the end", "the end"]
    df = spark.createDataFrame(texts, "wid long, text string")
    got = rows(sp.spot_surface_forms(df, spark.createDataFrame([(e,) for e in entries], "sf string")), "wid", "sf", "offset")
    assert got == sorted((i, sf, off) for i, t in texts for sf, off in brute_spots(t, entries))


def test_leftmost_longest(spark):
    spots = spark.createDataFrame(
        [(1, "a b", 0), (1, "a b c", 0), (1, "b c", 2), (1, "c", 4), (1, "d", 6), (1, "d e", 6), (1, "e f", 8)],
        "wid long, sf string, offset long")
    got = rows(sp.leftmost_longest(spots), "wid", "sf", "offset")
    assert got == [(1, "a b c", 0), (1, "d e", 6)]


def test_spot_linked_last_link_wins(spark):
    texts = spark.createDataFrame([(1, "Paris is in France. Paris again.")], "wid long, text string")
    links = spark.createDataFrame(
        [(1, 0, "Paris", "Paris_A"), (1, 1, "Paris", "Paris_B"), (1, 2, "France", "France")],
        "wid long, pos long, sf string, uri string")
    got = rows(sp.spot_linked(texts, links), "wid", "sf", "offset", "uri")
    assert got == [(1, "France", 12, "France"), (1, "Paris", 0, "Paris_B"), (1, "Paris", 20, "Paris_B")]


def test_long_entries_by_chunks(spark):
    texts = ["a b c d e f g h", "a b c d x f g h a b c", "a-b c, d e!f g h."]
    entries = ["a b c d e f g h", "a b c d e", "b c d", "c d e f g", "a b c d x f g h a b c", "f g h"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "wid long, text string")
    d = sp.build_dictionary(spark.createDataFrame([(e,) for e in entries], "sf string"))
    want = sorted((i, sf, off) for i, t in enumerate(texts) for sf, off in brute_spots(t, entries))
    for chunk in (2, 3, 4, 20):
        got = rows(sp.spot(df, d, chunk_words=chunk).select("wid", "sf", "offset"))
        assert got == want, chunk


# ---- long texts, repeated ids, link spans, long clusters ----

def test_long_texts_in_chunks_equal_whole_texts(spark):
    import random
    r = random.Random(2)
    texts = ["".join(r.choice(["a", "b", "ab", "Ä", "\U0001f600", " ", ", ", "-", "\n"]) for _ in range(r.randint(0, 90))) for _ in range(12)]
    texts += ["w" * 70, "." * 70, "", " a", texts[0]]
    df = spark.createDataFrame([(i % 9, t) for i, t in enumerate(texts)] + [(None, "a b a b"), (3, None)], "wid long, text string")
    want = rows(tk.text_words(df, look_words=3).select("id", "pos", "piece", "tpos", "offset", F.col("look").cast("string").alias("look")).na.fill(-1, ["id"]))
    d = sp.build_dictionary(spark.createDataFrame([(e,) for e in ["a", "a b", "b a b", "a b ab a b"]], "sf string"))
    spots = rows(sp.spot(df, d).na.fill(-1, ["wid"]))
    assert len(spots) > 20
    for chunk in (1, 7, 20):
        got = tk.text_words(df, look_words=3, long_text=chunk).select("id", "pos", "piece", "tpos", "offset", F.col("look").cast("string").alias("look"))
        assert rows(got.na.fill(-1, ["id"])) == want, chunk
        assert rows(sp.spot(df, d, long_text=chunk).na.fill(-1, ["wid"])) == spots, chunk


def test_repeated_ids_and_rows_are_texts_of_their_own(spark):
    df = spark.createDataFrame([(1, "x a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f")],
                               "wid long, text string")
    for entries in (["a b c d e f"], ["a b"], ["a b c d e f", "a", "c d"]):
        d = sp.build_dictionary(spark.createDataFrame([(e,) for e in entries], "sf string"))
        got = sorted((-1 if x["wid"] is None else x["wid"], x["sf"], x["offset"]) for x in sp.spot(df, d).collect())
        want = sorted((-1 if x["wid"] is None else x["wid"], *s) for x in df.collect() for s in brute_spots(x["text"], entries))
        assert got == want, entries


def brute_leftmost(spots):
    """Left to right: the longest spot at each start that begins at or after the last end."""
    out, last = [], -1
    for off in sorted({o for _, o in spots}):
        if off >= last:
            sf = max((s for s, o in spots if o == off), key=len)
            out.append((sf, off))
            last = off + len(sf)
    return out


def test_leftmost_longest_equals_brute_force(spark):
    import random
    r = random.Random(9)
    pages = {i: {("x" * r.randint(1, r.choice([2, 9, 30])), r.randint(0, 60)) for _ in range(r.randint(1, 40))} for i in range(25)}
    df = spark.createDataFrame([(None if i == 3 else i, sf, o) for i, p in pages.items() for sf, o in p], "wid long, sf string, offset long")
    want = sorted((-1 if i == 3 else i, sf, o) for i, p in pages.items() for sf, o in brute_leftmost(p))
    for stretch, cluster in ((1 << 14, 10_000), (4, 10_000), (1 << 14, 1), (7, 3)):
        got = rows(sp.leftmost_longest(df, stretch=stretch, cluster=cluster).na.fill(-1, ["wid"]), "wid", "sf", "offset")
        assert got == want, (stretch, cluster)


def test_one_long_page_is_split(spark):
    """A chain of overlapping spots over a whole page: one cluster, chosen by jumping."""
    n = 30_000
    df = spark.range(n).select(F.lit(1).cast("long").alias("wid"), F.lit("abc").alias("sf"), (F.col("id") * 2).alias("offset"))
    got = sp.leftmost_longest(df, stretch=1000)
    assert got.count() == n // 2 and got.where("offset % 4 <> 0").isEmpty()


def test_spot_linked_long_anchor_and_overlaps(spark):
    text = "New York City, New York and " + "w " * 50
    texts = spark.createDataFrame([(1, text), (2, "New York City")], "wid long, text string")
    links = spark.createDataFrame([(1, 0, "New York", "NY"), (1, 1, "York City", "YC"), (1, 2, ("w " * 50).strip(), "W"), (2, 0, "New York City", "NYC"),
                                   (2, 1, "-x-", "X")], "wid long, pos long, sf string, uri string")
    got = rows(sp.spot_linked(texts, links), "wid", "sf", "offset", "uri")
    assert got == sorted([(1, "New York", 0, "NY"), (1, "New York", 15, "NY"), (1, ("w " * 50).strip(), 28, "W"), (2, "New York City", 0, "NYC")])


def test_spots_with_link_spans(spark):
    spots = spark.createDataFrame([(1, "a b", 0), (1, "b", 2), (1, "c", 10), (1, "long one", 300), (2, "a b", 0)], "wid long, sf string, offset long")
    links = spark.createDataFrame([(1, "a b", 0, 3), (1, "zero", 0, 0), (1, None, 4, 6), (1, "x" * 600, 200, 800), (3, "q", 5, 6), (1, "a b", 0, 3)],
                                  "wid long, sf string, start long, end long")
    got = rows(sp.with_link_spans(spots, links))
    assert got == sorted([(1, "a b", 0, "both"), (1, "b", 2, "text"), (1, "c", 10, "text"), (1, "long one", 300, "text"), (2, "a b", 0, "text"),
                          (1, "x" * 600, 200, "link"), (3, "q", 5, "link")])
    for stretch in (1, 16, 256):
        alone = rows(sp.with_link_spans(spots, links, overlaps=False, stretch=stretch))
        assert alone == [r for r in got if r[1] not in ("b", "long one")]
