"""Operators 11 to 13 against brute force, on edge cases and on the small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkstats.llm import fim, periodic_runs, sharding

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, shard string, slot boolean, row long, `key` long, form string, n string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def texts():
    """Runs of all kinds, nested and side by side, odd, empty and very long texts, the marks."""
    r = random.Random(13)
    out = [None, "", " \t\n", "one", "a a a a a", "a a a a a a", "a  b\na b\ta b a b", "x a b a b a b a y", "é é é é é é é",
           "a" + "<P>" + "b", "1 2 3 \U0001f600 café", "a" * 50, "a a a a a a b a a a a a a b a a a a a a b a a a a a a b"]
    for _ in range(60):
        words = [r.choice("abc") for _ in range(r.randint(0, 60))]
        for _ in range(r.randint(0, 3)):
            root = [r.choice("abcde") for _ in range(r.randint(1, 12))]
            at = r.randint(0, len(words))
            words[at:at] = (root * 9)[:len(root) * r.randint(3, 6) + r.randint(0, len(root))]
        out.append(" ".join(words))
    fib = ["a", "ab"]
    while len(fib) < 15:
        fib.append(fib[-1] + fib[-2])
    out += [" ".join(fib[-1]), " ".join("ab" * 700), " ".join("abcab" * 300)]
    return out + out[10:20]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None if i == 5 else i // 2 if i > 60 else i, t, "s", True, 1, 2, "f", "n") for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- 11: sharding ----

def test_shards_are_exact_whole_and_repeatable(spark, docs, tmp_path):
    path = str(tmp_path / "docs")
    docs.write.parquet(path)
    given = Counter(tuple(r) for r in docs.collect())
    for n_shards, blocks in ((8, 3), (5, 1), (1, None), (300, 2)):
        out = sharding.shuffle_into_shards(spark.read.parquet(path), n_shards, blocks=blocks)
        got = out.collect()
        assert Counter(tuple(r["row"]) for r in got) == given
        sizes = Counter(r["shard"] for r in got)
        total = sum(given.values())
        assert all(sizes[s] in (total // n_shards, -(-total // n_shards)) for s in range(n_shards))
        for s in range(n_shards):
            assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
        again = sharding.shuffle_into_shards(spark.read.parquet(path), n_shards, blocks=blocks).collect()
        assert sorted(map(repr, again)) == sorted(map(repr, got))
    moved = sharding.shuffle_into_shards(docs, 8)  # not a plain scan: written first
    assert Counter(tuple(r["row"]) for r in moved.collect()) == given


def test_shards_of_other_splits_are_the_same(spark, docs, tmp_path):
    path = str(tmp_path / "docs")
    docs.coalesce(1).write.option("parquet.block.size", 4096).parquet(path)
    one = sorted(map(repr, sharding.shuffle_into_shards(spark.read.parquet(path), 8, blocks=2).collect()))
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        many = sorted(map(repr, sharding.shuffle_into_shards(spark.read.parquet(path), 8, blocks=2).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    assert one == many


def test_shards_of_nothing(spark, empty, tmp_path):
    assert sharding.shuffle_into_shards(empty, 8).count() == 0
    empty.write.parquet(str(tmp_path / "none"))
    assert sharding.shuffle_into_shards(spark.read.parquet(str(tmp_path / "none")), 8).count() == 0


def test_matrix_margins_and_law():
    rows, columns = np.array([3, 0, 5, 2, 7]), np.array([4, 4, 3, 3, 3])
    cells = np.zeros((5, 5))
    for seed in range(4000):
        m = sharding.Matrix(rows, columns, seed)
        a = np.array([m.row(i) for i in range(5)])
        assert (a.sum(axis=1) == rows).all() and (a.sum(axis=0) == columns).all()
        cells += a
        if seed < 50:
            to = np.concatenate([m.destinations(i)[0] for i in range(5)])
            assert (np.bincount(to, minlength=5) == columns).all()
    assert abs(cells / 4000 - np.outer(rows, columns) / 17).max() < 0.06


def test_every_order_is_equally_likely():
    seen = Counter()
    for seed in range(6000):  # 4 rows in 2 pieces, 2 columns: 24 orders
        m = sharding.Matrix(np.array([1, 3]), np.array([2, 2]), seed)
        rows = [(int(c), int(k), p, i) for p in range(2) for i, (c, k) in enumerate(zip(*m.destinations(p)))]
        seen[tuple((p, i) for _, _, p, i in sorted(rows))] += 1
    assert len(seen) == 24
    assert sum((n - 250) ** 2 / 250 for n in seen.values()) < 60  # chi square, 23 degrees: 1e-5


def test_large_populations_follow_the_law():
    rng = np.random.default_rng(1)
    good, bad, n = 3_000, 7_000, 500
    mine = np.array([sharding._by_inversion(rng, good, bad, n) for _ in range(4000)])
    theirs = rng.hypergeometric(good, bad, n, 4000)
    assert abs(mine.mean() - theirs.mean()) < 1 and abs(mine.std() / theirs.std() - 1) < 0.06
    big = np.array([sharding._by_inversion(rng, 4 * 10 ** 9, 6 * 10 ** 9, 10 ** 6) for _ in range(2000)])
    assert abs(big.mean() - 4e5) < 60 and abs(big.std() / 489.9 - 1) < 0.08
    assert [sharding._by_inversion(rng, *x) for x in ((0, 5, 3), (5, 0, 3), (2, 2, 4))] == [0, 3, 2]
    take = sharding.multivariate(rng, np.array([2 * 10 ** 9, 3, 10 ** 9]), 10 ** 9)
    assert take.sum() == 10 ** 9 and (take <= [2 * 10 ** 9, 3, 10 ** 9]).all()


def test_op11_digests(spark):
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = sharding.op11_shard(spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(given)
    for r in got:
        raw = given[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


# ---- 12: fill in the middle ----

def brute_fim(doc_id, text, percent=90):
    text = text or ""
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if text == "" or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return (doc_id, n, "plain", None, None, text)
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_fim_equals_brute_force(spark, docs):
    got = fim.fill_in_middle(docs).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    want = Counter(brute_fim(r.doc_id, r.text) for r in docs.collect())
    assert Counter(tuple(r)[:6] for r in got) == want
    by_id = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = Counter(r.doc_id for r in got)
    assert all(r.back == by_id[r.doc_id] for r in got if ids[r.doc_id] == 1)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fim_marks_at_cuts_odd_characters_and_long_texts(spark):
    r = random.Random(3)
    rows = [(i, "".join(r.choice(["<", "P", "S", "M", ">", "\n", "\U0001f600", "$1", "\\", "é", " "]) for _ in range(r.randint(1, 25))))
            for i in range(400)]
    rows += [(1000, "ab cd " * 200_000), (1001, "x" * 500_000), (1002, "\n" * 300_000), (1003, "\U0001f600" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x for x in fim.fill_in_middle(df, percent=100).withColumn(
        "back", fim.restore(F.col("output"), F.col("form"))).collect()}
    for doc_id, text in rows:
        assert tuple(got[doc_id])[:6] == brute_fim(doc_id, text, 100)
        assert got[doc_id].back == text


def test_fim_of_nothing(empty):
    assert fim.fill_in_middle(empty).count() == 0


def test_op12_digests(spark):
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in fim.op12_fill_in_middle(spark, SMALL).collect():
        want = brute_fim(r.doc_id, given[r.doc_id])
        assert tuple(r) == (*want[:5], sha(want[5]), sha(given[r.doc_id]))


# ---- 13: periodic runs ----

def brute_runs(words):
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def brute_collapse(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def brute_best(runs):
    return max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2])) if runs else None


def test_runs_equal_brute_force(docs):
    got = periodic_runs.periodic_runs(docs).withColumn("best", periodic_runs.best_run(F.col("starts"), F.col("lengths"), F.col("periods")))
    rows = Counter((r.doc_id, r.n_words, tuple(zip(r.starts, r.lengths, r.periods)), r.collapsed, tuple(r.best)) for r in got.collect())
    want = Counter()
    for r in docs.collect():
        words = WORD.findall(r.text or "")
        runs = brute_runs(words)
        want[r.doc_id, len(words), tuple(runs), brute_collapse(words, runs), brute_best(runs) or (None,) * 3] += 1
    assert rows == want
    assert sum(len(k[2]) * v for k, v in want.items()) > 60


def test_runs_of_random_words():
    r = np.random.default_rng(4)
    for trial in range(300):
        docs = [list(r.integers(0, r.integers(1, 4), r.integers(0, 50))) for _ in range(r.integers(1, 6))]
        if trial % 2:
            root = list(r.integers(0, 3, r.integers(1, 9)))
            docs[0] = docs[0][:r.integers(0, 9)] + root * int(r.integers(1, 8)) + root[:r.integers(0, 3)] + docs[0][:5]
        ids = np.array([w for d in docs for w in d], dtype=np.int64)
        doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        got = sorted(zip(*(x.tolist() for x in periodic_runs.all_runs(ids, doc))))
        want, at = [], 0
        for d in docs:
            want += [(s + at, n, q) for s, n, q in brute_runs(d)]
            at += len(d)
        assert got == sorted(want)


def test_grammar_derives_its_words():
    r = np.random.default_rng(5)
    for _ in range(50):
        ids, doc = r.integers(0, 3, 200), np.sort(r.integers(0, 6, 200))
        g = periodic_runs.Grammar(ids, doc)

        def derive(x):
            i = x - g.n_words
            return [x] if i < 0 else derive(g.left[i]) + derive(g.right[i])
        assert [w for x in g.roots for w in derive(x)] == ids.tolist()
        assert len(g.roots) == len(set(doc))
        for i in range(len(g.lo)):
            assert derive(g.n_words + i) == ids[g.lo[i]:g.hi[i]].tolist()
            assert derive(g.left[i]) == ids[g.lo[i]:g.mid[i]].tolist()
    g = periodic_runs.Grammar(np.tile(np.arange(8), 64), np.zeros(512, dtype=np.int64))
    assert len(g.lo) < 40  # copies share their symbols


def test_a_large_document_and_many_copies():
    ids = np.concatenate([np.zeros(60_000, np.int64), np.tile(np.arange(5_000), 6), np.arange(40_000)])
    got = list(zip(*(x.tolist() for x in periodic_runs.all_runs(ids, np.zeros(len(ids), np.int64)))))
    assert got == [(0, 60_001, 1), (60_000, 35_000, 5_000)]
    copies = np.tile(np.array([1, 2] * 5 + [3, 4, 5]), 3_000)
    start, length, q = periodic_runs.all_runs(copies, np.repeat(np.arange(3_000), 13))
    assert len(start) == 3_000 and set(length) == {10} and set(q) == {2}


def test_runs_of_nothing(empty):
    assert periodic_runs.periodic_runs(empty).count() == 0


def test_op13_digests(spark):
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r.doc_id: r for r in periodic_runs.op13_periodic_runs(spark, SMALL).collect()}
    assert set(got) == set(given)
    for doc_id, text in given.items():
        words = WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = brute_runs(words)
        best = brute_best(runs)
        want = (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(brute_collapse(words, runs)))
        assert tuple(got[doc_id])[1:] == want, doc_id


# ---- earlier operators: findings of the last verdict ----

def test_exact_dedup_counts_every_row_and_reopens_with_its_buckets(spark, tmp_path):
    from linkstats.llm import exact_dedup
    df = spark.createDataFrame([(1, "a  b"), (1, "a  b"), (2, "a b"), (3, "c")], "doc_id long, text string")
    got = sorted(tuple(r)[:4] for r in exact_dedup.dedupe(df, exact_dedup.DigestIndex(spark)).collect())
    assert got == [(1, 1, 3, True), (1, 1, 3, True), (2, 1, 3, False), (3, 3, 1, True)]
    named = df.withColumn("__digest", F.lit("mine"))
    assert sorted(map(tuple, exact_dedup.keep_first(named, exact_dedup.DigestIndex(spark)).collect())) == [(1, "a  b", "mine"), (3, "c", "mine")]
    path = str(tmp_path / "index")
    texts = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    assert exact_dedup.keep_first(texts, exact_dedup.DigestIndex(spark, path, 4)).count() == 200
    for r in spark.sql("SHOW TABLES LIKE 'digest_index_*'").collect():
        spark.sql(f"DROP TABLE {r['tableName']}")  # as in a new session
    more = texts.withColumn("doc_id", F.col("doc_id") + 1000)
    width = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert exact_dedup.keep_first(more, exact_dedup.DigestIndex(spark, path)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    with pytest.raises(ValueError):
        exact_dedup.DigestIndex(spark, path, 8)


def test_overlaps_are_the_same_with_one_block_and_with_several(spark):
    from linkstats.llm import decontaminate
    items = [" ".join(f"w{i}x{j}" for j in range(20)) for i in range(6)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = [(1, items[2]), (1, items[2]), (1, f"{items[0]} and {items[5]}"), (None, items[1]), (4, "clean text"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one, several = (sorted(map(repr, decontaminate.overlaps(df, bench, block_words=n).collect())) for n in (500_000, 30))
    assert one == several and len(one) == 6
    assert decontaminate.overlaps(df.limit(0), bench).count() == 0


def test_line_dedup_of_long_documents(spark):
    import time

    from linkstats.llm import line_dedup
    n = 20_000
    lines = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.concat(
        F.lit("a line that is long enough "), F.when(i % 3 == 0, i).otherwise(i + 1_000_000 * F.col("id")).cast("string")))
    df = spark.range(1, 4).select(F.col("id").alias("doc_id"), F.array_join(lines, "\n").alias("text"))
    t = time.perf_counter()
    bitmaps = line_dedup.keep_bitmaps(df)
    got = sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept.count("\n") + 1) for r in line_dedup.apply_bitmaps(df, bitmaps).collect())
    shared = len(range(0, n, 3))
    assert got == [(1, n, shared, n - shared), (2, n, shared, n - shared), (3, n, 0, n)]
    assert time.perf_counter() - t < 60


def test_every_labelled_text_has_swap_pairs():
    from linkstats.llm import toxicity
    for text in ("A plain sentence. Another one!", "The old man sings. So be it."):
        pairs = toxicity.swapped(text)
        assert len(pairs) == toxicity.SWAPS
        for a, b in pairs:
            changed = [(x, y) for x, y in zip(re.findall(r"\w+", a), re.findall(r"\w+", b)) if x != y]
            assert changed and all(x.lower() in toxicity.IDENTITY and y in toxicity.IDENTITY for x, y in changed)
        assert toxicity.swapped(text) == pairs
    assert toxicity.swapped("") == []


def test_the_labelled_sample_is_bounded_where_ids_repeat(spark, monkeypatch):
    from linkstats.llm import toxicity
    docs = spark.range(40).select((F.col("id") % 20).alias("doc_id"), F.concat(F.lit("some text "), "id").alias("text"))
    labels = spark.range(20).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    seen = {}
    keep = toxicity.materialize
    monkeypatch.setattr(toxicity, "materialize", lambda df, name: seen.setdefault(name, keep(df, name)))
    toxicity.fit(docs, labels, max_labelled=5)
    assert seen["toxicity_sample"].count() == 5
