"""Work and memory that must not grow faster than the input (findings of round 3)."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from conftest import rows
from linkstats.functions import text as tx
from linkstats.llm import common
from linkstats.llm import decontaminate as dc
from linkstats.llm import suffix_dedup as sd
from linkstats.operators import context as cx
from linkstats.operators import tokens as tk
from linkstats.session import child_names, ensure_checkpoint_dir
from linkstats.sources import wikiblocks as wb


def keyed(spark):
    """Uris that share keys, have several, the same ones in another order, or none that occurs;
    paragraphs that hold several keys, or stop words only."""
    keys = [(f"U{i}", "a") for i in range(30)] + [("V", "a"), ("V", "b"), ("W", "b"), ("W", "a"), ("V", "a"), ("X", "c"),
            ("Y", "nowhere"), (None, "a"), (None, "c"), ("Z", "stop"), ("T", "b"), ("T", "nowhere")]
    places = [("a", f"p{i}") for i in range(6)] + [("b", "p0"), ("b", "p1"), ("b", "q"), ("c", "p0"), ("c", "q"), ("stop", "s")]
    paragraphs = [(f"p{i}", f"Cats and dogs {i} relational cats") for i in range(6)] + [("q", "bark Dogs"), ("s", "the and"), ("r", "unlinked")]
    return (cx.KeyedParagraphs(spark.createDataFrame(keys, "uri string, key string"), spark.createDataFrame(places, "key string, para_key string")),
            spark.createDataFrame(paragraphs, "para_key string, para string"), spark.createDataFrame([("the",), ("and",)], "word string"))


@pytest.mark.parametrize("algorithm", ["s", "porter"])
def test_groups_of_uris_give_the_results_of_their_pairs(spark, algorithm):
    by_key, paragraphs, stops = keyed(spark)
    flat = by_key.keys.join(by_key.places, "key").select("uri", "para_key").distinct()

    def same(got, want):
        a, b = ([tuple(r) for r in df.select(*want.columns).collect()] for df in (got, want))
        assert sorted(a, key=repr) == sorted(b, key=repr) and b

    same(by_key.pairs(), flat)
    same(by_key.pairs(block=7), flat)
    args = (paragraphs, stops, algorithm)
    want = cx.token_counts(flat, *args)
    for block in (cx.BLOCK, 2):
        same(cx.token_counts(by_key, *args, block=block), want)
    if algorithm == "s":
        same(cx.token_counts(by_key, *args, encode=False), cx.token_counts(flat, *args, encode=False))
        same(cx.context_vector_chunks(by_key, *args, size=2), cx.context_vector_chunks(flat, *args, size=2))
        same(cx.context_vectors(by_key, *args, top_k=1), cx.context_vectors(flat, *args, top_k=1))
    vectors = cx.context_vectors(by_key, *args)
    same(vectors, cx.context_vectors(flat, *args))
    assert {r["uri"]: r["vector"] for r in vectors.collect()}["http://en.wikipedia.org/wiki/Z"] == ""


def test_uris_with_one_key_are_counted_once(spark):
    keys = spark.createDataFrame([(f"U{i}", "k") for i in range(200)], "uri string, key string")
    places = spark.createDataFrame([("k", f"p{i}") for i in range(100)], "key string, para_key string")
    paragraphs = spark.createDataFrame([(f"p{i}", "red green") for i in range(100)], "para_key string, para string")
    counts, uris = cx._counted(cx.KeyedParagraphs(keys, places), paragraphs, None, "s", "en", True)
    assert sorted(r["n"] or 0 for r in counts.collect()) == [0, 100, 100]  # with the marker row, not for each uri
    assert uris.count() == 200 and uris.select("group").distinct().count() == 1


def test_counts_leave_a_task_packed_in_a_row_for_each_owner(spark, monkeypatch):
    monkeypatch.setattr(cx, "PART", 40)
    keys = spark.createDataFrame([(f"U{i}", f"k{i % 3}") for i in range(9)], "uri string, key string")
    places = spark.createDataFrame([(f"k{k}", f"p{i}") for k in range(3) for i in range(30 + 30 * k)], "key string, para_key string")
    paragraphs = spark.createDataFrame([(f"p{i}", f"red green words{i} number{i % 7}") for i in range(100)], "para_key string, para string")
    packed, _, uris = cx._summed(cx.KeyedParagraphs(keys, places), paragraphs, None, "porter", "en", True)
    # one row for an owner, or one for each part of one with many paragraphs
    assert sorted(r["parts"] for r in packed.collect()) == [1, 2, 2, 3, 3, 3]
    flat = keys.join(places, "key").select("uri", "para_key")
    counts = cx.token_counts(cx.KeyedParagraphs(keys, places), paragraphs, None, "porter")
    text = {f"p{i}": ["red", "green", f"words{i}", f"number{i % 7}"] for i in range(100)}
    want = {}
    for uri, para in rows(flat):
        for w in text[para]:
            k = "http://en.wikipedia.org/wiki/" + uri, w
            want[k] = want.get(k, 0) + 1
    assert {(r["uri"], r["stem"]): r["n"] for r in counts.collect()} == want
    vectors = {r["uri"]: r["vector"] for r in cx.context_vectors(cx.KeyedParagraphs(keys, places), paragraphs, None, top_k=2).collect()}
    assert vectors["http://en.wikipedia.org/wiki/U2"] == "(green,90),(red,90)"


def test_products_are_given_out_in_blocks(monkeypatch):
    monkeypatch.setattr(cx, "WORDS", 7)
    monkeypatch.setattr(cx, "PRODUCT", 3)
    monkeypatch.setattr(cx, "ENTRIES", 4)
    owners = [[("a", 1, 1), (None, 2, 1)], [("b", 1, 2)], [("a", -1, 1)], [("c", 1, 1)], None]
    words = [["x", "y", "x"], ["y", "z", "w"] * 3, ["x"], None, ["x"]]
    kind = pa.list_(pa.struct([("owner", pa.string()), ("w", pa.int64()), ("parts", pa.int32())]))
    rows_in = pa.RecordBatch.from_arrays([pa.array([o and [dict(zip(("owner", "w", "parts"), x)) for x in o] for o in owners], kind),
                                          pa.array(words, pa.list_(pa.string()))], names=["owners", "words"])
    blocks = [b.rename_columns(["stem", "body"]) for b in cx._word_blocks(iter([rows_in]))]
    assert len(blocks) > 1
    got, seen = {}, set()
    for b in cx._multiplied(iter([b.slice(i, 1) for b in blocks for i in range(b.num_rows)])):
        for r in b.to_pylist():
            seen.add((r["owner"], r["parts"]))
            for e in filter(None, r["packed"].split(" ")):
                stem, n = e.split(",")
                got[r["owner"], stem] = got.get((r["owner"], stem), 0) + int(n)
    assert got == {("a", "x"): 1, ("a", "y"): 1, (None, "x"): 4, (None, "y"): 2, ("b", "y"): 3, ("b", "z"): 3, ("b", "w"): 3}
    assert seen == {("a", 1), (None, 1), ("b", 2), ("c", 1)}


def test_large_vectors_are_joined_from_pieces_of_their_text(spark, monkeypatch):
    monkeypatch.setattr(cx, "CHUNK", 3)
    monkeypatch.setattr(cx, "PART", 2)
    text = {"p0": "red red blue", "p1": "green red", "p2": "a b c d e f g h", "p3": "", "p4": "blue"}
    pairs = spark.createDataFrame([("U", p) for p in text] + [(None, p) for p in text] + [("V", "p4"), ("W", "p3")] + [("X", "p3")] * 2, "uri string, para_key string")
    paragraphs = spark.createDataFrame(list(text.items()), "para_key string, para string")
    vectors = cx.context_vectors(pairs, paragraphs)
    counts = spark.createDataFrame([("U", "a", 1)], "uri string, stem string, n long")
    plan = cx.render_vectors(counts)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(" not in plan  # no task holds an object for each entry of a vector
    all_of_them = "(red,3),(blue,2)," + ",".join(f"({x},1)" for x in ["a", "b", "c", "d", "e", "f", "g", "green", "h"])
    wiki = "http://en.wikipedia.org/wiki/"
    want = {wiki + "U": all_of_them, None: all_of_them, wiki + "V": "(blue,1)", wiki + "W": "", wiki + "X": ""}
    got = [(r["uri"], r["vector"]) for r in vectors.collect()]
    assert dict(got) == want and len(got) == len(want)
    top = {r["uri"]: r["vector"] for r in cx.context_vectors(pairs, paragraphs, top_k=4).collect()}
    assert top[wiki + "U"] == top[None] == "(red,3),(blue,2),(a,1),(b,1)"


def test_a_task_holds_the_text_of_one_large_vector(monkeypatch):
    monkeypatch.setattr(cx, "TEXT", 1 << 16)
    piece, n, owners = "x" * 1000, 4_000, 3
    chunks = (pa.RecordBatch.from_arrays([pa.array([f"U{i}"] * 100), pa.array([piece] * 100)], names=["uri", "vector"])
              for i in range(owners) for _ in range(n // 100))
    lengths = {}
    tracemalloc.start()
    for batch in cx._joined(chunks):
        for i in range(batch.num_rows):
            lengths[batch.column("uri")[i].as_py()] = pc.binary_length(batch.column("vector"))[i].as_py()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert lengths == {f"U{i}": n * 1001 - 1 for i in range(owners)}
    assert peak < 3.5 * n * 1001  # not all of them
    mixed = pa.RecordBatch.from_arrays([pa.array(["a", "a", None, None, "b"]), pa.array(["x", "y", None, "z", None])], names=["uri", "vector"])
    assert [r for b in cx._joined(iter([mixed])) for r in map(tuple, zip(*b.to_pydict().values()))] == [("a", "x,y"), (None, "z"), ("b", "")]


def test_sums_are_packed_in_batches(monkeypatch):
    monkeypatch.setattr(cx, "PACK", 4)
    sums = cx._Sums()
    codes = [(sums.number(o, p) << 32) + sums.stems.setdefault(f"s{k}", len(sums.stems)) for o, p in (("a", 2), ("b", 1), ("c", 1)) for k in range(5)]
    sums.number("bare", 1)
    sums.add(np.array(codes * 2, np.int64), np.ones(30, np.int64))
    batches = list(sums.rows())
    assert len(batches) > 2
    got = {}
    for r in (r for b in batches for r in b.to_pylist()):
        for e in filter(None, r["packed"].split(" ")):
            got.setdefault(r["owner"], {})[e.split(",")[0]] = int(e.split(",")[1])
        got.setdefault(r["owner"], {})
    assert got == {**{o: {f"s{k}": 2 for k in range(5)} for o in "abc"}, "bare": {}}


def test_running_sums_hold_one_result_and_a_block(monkeypatch):
    monkeypatch.setattr(tx, "SUM_BLOCK", 1 << 12)
    data = [[1, 2, 3], [], [4], [5, 6], []]
    assert tx.sums_in_rows(pa.array(data, pa.list_(pa.int32())).slice(1)).to_pylist() == [[], [0], [0, 5], []]
    n = 1 << 20
    lengths = pa.ListArray.from_arrays(pa.array(np.arange(0, n + 1, 64), pa.int32()), pa.array(np.full(n, 7, np.int32)))
    tracemalloc.start()
    out = tx.sums_in_rows(lengths)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out[5].as_py() == [7 * i for i in range(64)]
    assert peak < 1.5 * 4 * n  # the result, of 32 bits as the input


def test_only_strings_with_references_become_objects():
    values = pa.array(["plain text"] * 200_000 + ["a &amp; b", None, "&#65;"])
    tracemalloc.start()
    out = wb.decoded(values)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out[-3:].to_pylist() == ["a & b", None, "A"] and out[0].as_py() == "plain text"
    assert peak < 1_000_000


def test_chunks_meet_their_sums_as_text_and_no_word_is_joined(spark):
    texts = spark.createDataFrame([(1, "one two, three four five six seven"), (1, "short"), (None, "again one two, three four")], "wid long, text string")
    cut = tk.text_words(texts.withColumn("k", F.lit("x")), look_words=2, keep=("k",), long_text=8)
    whole = tk.text_words(texts.withColumn("k", F.lit("x")), look_words=2, keep=("k",))
    assert sorted(map(repr, cut.collect())) == sorted(map(repr, whole.collect()))
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    below = plan[plan.index("Join "):]
    assert "Generate" not in below


def test_decontamination_holds_a_block_of_the_batch():
    item = " ".join(f"w{i}" for i in range(30))
    words = np.concatenate([w for _, _, w, _ in dc.wh.plain_word_blocks(pa.array([item]))])
    seeds = dc.Seeds([(1, words)])
    column = pa.array([f"text {i} " + "some words of it " * 50 for i in range(8000)] + [item])
    bits = seeds.filter()
    tracemalloc.start()
    found = dc._hits(seeds, column, bits)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == {8000: {0: 30}}
    assert peak < 60_000_000


def test_a_task_gives_memory_back_at_its_end(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "_give_back", lambda: calls.append(1))
    assert list(common.releasing(lambda batches: (b for b in batches))(iter([1, 2]))) == [1, 2] and calls == [1]


def test_only_paragraphs_with_owners_are_shuffled(spark, monkeypatch):
    given, blocked = [], cx.blocked

    def counted(pairs, paragraphs, *a, **k):
        given.append(paragraphs.count())
        return blocked(pairs, paragraphs, *a, **k)
    monkeypatch.setattr(cx, "blocked", counted)
    paragraphs = spark.createDataFrame([(f"p{i}", f"red cars {i}") for i in range(50)] + [(None, "blue")], "para_key string, para string")
    pairs = spark.createDataFrame([("u", "p1"), ("u", "p2"), ("v", "p2"), ("w", "gone"), ("x", None)], "uri string, para_key string")
    want = {("u", "red", 2), ("u", "car", 2), ("v", "red", 1), ("v", "car", 1)}
    for limit, least in (("", 2), ("0", 51)):  # hashes too many to broadcast: the same counts of all paragraphs
        if limit:
            spark.conf.set("linkstats.broadcast.maxBytes", limit)
        try:
            got = cx.token_counts(pairs, paragraphs, encode=False).collect()
        finally:
            spark.conf.unset("linkstats.broadcast.maxBytes")
        assert {(r["uri"], r["stem"], r["n"]) for r in got if r["stem"].isalpha()} == want
        assert given[0] in (least, least + 1)  # and one without a key
        given.clear()


def test_suffix_dedup_drops_the_tables_of_a_step_before_the_next(spark, monkeypatch):
    r = random.Random(8)
    noise = lambda: "".join(r.choice("abcdefgh ") for _ in range(300))
    shared = noise()
    docs = spark.createDataFrame([(i, noise() + shared[i:i + 240] + noise()) for i in range(20)], "doc_id long, text string")
    folder, seen, plain = f"{ensure_checkpoint_dir(spark)}/tables", {}, sd.map_arrow

    def kinds():
        return [name.rpartition("-")[0] for name in child_names(spark, folder) if name not in before]

    def watched(df, function, schema):
        seen.setdefault(function.__qualname__.split(".")[0], []).append(kinds())
        return plain(df, function, schema)
    spark.range(1).write.mode("overwrite").parquet(f"{folder}/other-0")
    before = set(child_names(spark, folder))
    monkeypatch.setattr(sd, "map_arrow", watched)
    got = sd.repeated_spans(docs)
    assert got.count() == 20
    assert [sorted(k) for k in seen["_stretches"]] == [["suffix_marks", "suffix_open"], ["suffix_marks", "suffix_marks", "suffix_open", "suffix_open"]]
    assert sorted(seen["_merge"][0]) == ["suffix_marks"] * 3 + ["suffix_open"] * 2
    assert kinds() == ["suffix_spans"]


@pytest.mark.parametrize("batches", [2, 3])
def test_a_class_of_several_batches_is_one_class(spark, batches):
    index = sd.SuffixIndex(spark, buckets=3)
    for i in range(batches):
        index.add(spark.createDataFrame([(c, c * 7, 100 * i + c, 0) for c in range(i, 40)], sd.ROWS))
    got = [(r["core"], r["run"], r["n"], r["rid"] % 100, r["pos"]) for r in index.classes().collect()]
    assert sorted(got) == [(c, c * 7, min(c + 1, batches), c, 0) for c in range(40)]
    index.close()
