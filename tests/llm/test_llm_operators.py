"""The training-data operators against brute force, on edge cases and on the small tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkstats.llm import (chat, decontaminate, exact_dedup, html_text, line_dedup, mixing, near_dedup, suffix_dedup,
                           toxicity, urls)
from linkstats.session import checked_broadcast, measured_bytes

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, kept boolean, size long, rid long, component string"


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def sample_texts():
    """Copies, near copies, shared passages and lines, odd and empty texts."""
    r = random.Random(5)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 7))) for _ in range(300)]

    def words(n):
        return [r.choice(vocab) for _ in range(n)]
    texts = [None, "", "   ", "one", "One", "éÉ ß", "x\ty  z", "x y z", "x y z"]
    passage, line = " ".join(words(70)), "A Shared line of Some Length"
    for _ in range(25):
        base = words(r.randint(5, 120))
        texts.append(" ".join(base))
        for _ in range(r.randint(0, 3)):
            near = list(base)
            near[r.randrange(len(near))] = r.choice(vocab)
            texts.append(" ".join(near))
        texts.append(" ".join(words(10)) + "\n" + line.upper() + " \n" + " ".join(words(3)) + "\n" + line)
        texts.append(" ".join(words(r.randint(0, 30))) + passage + " ".join(words(r.randint(0, 30))))
    texts += ["ab" * 400, "z" * 450, " ".join(words(3000))]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, [None, "a", "b", "c"][i % 4], True, 7, 3, "x") for i, t in enumerate(sample_texts())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


def test_exact_dedup(spark, docs):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t) for i, t in texts_of(docs).items()}
    groups = defaultdict(list)
    for i, t in norm.items():
        groups[t].append(i)
    index = exact_dedup.DigestIndex(spark)
    for _ in range(2):  # a batch that is seen again changes nothing
        got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.dedupe(docs, index).collect()}
        assert got == {i: (min(groups[t]), len(groups[t]), i == min(groups[t]), sha(t)) for i, t in norm.items()}
    later = spark.createDataFrame([(900, "x y z"), (901, "new text"), (901, "new text"), (None, "new text")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.dedupe(later, index).collect()}
    assert got == {900: (6, False), 901: (901, True), None: (901, False)}
    kept = exact_dedup.keep_first(docs.unionByName(docs), exact_dedup.DigestIndex(spark))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(g) for g in groups.values())


def test_line_dedup(docs):
    texts = texts_of(docs)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    held = defaultdict(set)
    for i, t in texts.items():
        for x in t.split("\n"):
            if len(key(x)) >= 20:
                held[key(x)].add(i)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)).collect()}
    want = {}
    for i, t in texts.items():
        lines = t.split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < 3 or i == max(held[key(x)])]
        want[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    assert got == want and any(v[1] for v in want.values())


def test_suffix_dedup(docs):
    texts = {i: t.encode() for i, t in texts_of(docs).items()}
    seen = Counter(t[j:j + 200] for t in texts.values() for j in range(len(t) - 199))
    for batches in (1, 3):
        for r in suffix_dedup.cut_repeats(docs, batches=batches).collect():
            t = texts[r.doc_id]
            cover = np.zeros(len(t), dtype=bool)
            for j in range(len(t) - 199):
                if seen[t[j:j + 200]] > 1:
                    cover[j:j + 200] = True
            spans = int((cover & ~np.concatenate([[False], cover[:-1]])).sum()) if len(t) else 0
            kept = bytes(b for b, c in zip(t, cover) if not c)
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(t), int(cover.sum()), spans, sha(kept))


def test_suffix_index_reopened(spark, tmp_path):
    """A later batch against the index of an older one, whose texts it shares only in part."""
    r = random.Random(9)
    shared = ["".join(r.choice("abcdefgh ") for _ in range(260)) for _ in range(8)]

    def batch(first):
        noise = lambda: "".join(r.choice("ijklmnop ") for _ in range(300))
        return spark.createDataFrame([(first + i, noise() + s + noise()) for i, s in enumerate(shared)], "doc_id long, text string")

    def removed(docs, **options):
        return {x.doc_id: x.n_removed for x in suffix_dedup.cut_repeats(docs, batches=1, **options).collect()}
    path = f"{tmp_path}/index"
    older, later, last = batch(0), batch(100), batch(200)
    assert set(removed(older, index=suffix_dedup.SuffixIndex(spark, path, buckets=3)).values()) == {0}
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        got = removed(later, index=suffix_dedup.SuffixIndex(spark, path))
        both = removed(older.unionByName(later))
        assert got == {i: both[i] for i in range(100, 108)} and sum(got.values()) >= 2080
        with pytest.raises(ValueError):
            suffix_dedup.SuffixIndex(spark, path, buckets=4)
        died = suffix_dedup.SuffixIndex(spark, path)  # adds a batch and never commits
        died.add(spark.createDataFrame([(1, 2, 3, 4 << 16)], suffix_dedup.ROWS))
        third = suffix_dedup.SuffixIndex(spark, path)
        assert third.version == 2 and third.buckets == 3
        got = removed(last, index=third)
        every = removed(older.unionByName(later).unionByName(last))
        assert got == {i: every[i] for i in range(200, 208)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_suffix_dedup_odd_rows(spark):
    """Repeated rows count as two places; null ids and a short line that many documents hold."""
    r = random.Random(4)
    line = "".join(r.choice("abc ") for _ in range(100))
    rows = [(i, "".join(r.choice("defg ") for _ in range(150)) + line + "".join(r.choice("hijk ") for _ in range(150))) for i in range(60)]
    twice = "".join(r.choice("lmno ") for _ in range(500))
    rows += [(900, twice), (900, twice), (None, rows[0][1]), (None, None)]
    got = sorted((x.doc_id or -1, x.n_bytes, x.n_removed) for x in suffix_dedup.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    want = [(-1, 0, 0), (-1, 400, 400), *((i or -1, 400, 400 if i == 0 else 0) for i in range(60)), (900, 500, 500), (900, 500, 500)]
    assert got == sorted(want)


@pytest.mark.parametrize("k", [2, 5])
def test_near_dedup(docs, k):
    def shingles(t):
        w = t.encode().lower().split()
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    sets = {i: shingles(t) for i, t in texts_of(docs).items()}
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    root[a] = root[b] = min(root[a], root[b])
        if all(root[root[i]] == root[i] for i in sets) and _ > 2:
            break
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_components(docs, k=k).collect()}
    assert got == {i: (len(s), root[i], root[i] == i) for i, s in sets.items()}


@pytest.mark.parametrize("block", [mixing.BLOCK, 16])
def test_mixing(docs, block):
    rows = mixing.mix(docs, block=block).collect()
    again = mixing.mix(docs.repartition(5), block=block).collect()
    assert {r.doc_id: r.taken for r in rows} == {r.doc_id: r.taken for r in again}
    sizes = {i: len(t.encode().split()) for i, t in texts_of(docs).items()}
    assert {r.doc_id: r["size"] for r in rows} == sizes
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in rows)
    per = {s: [r for r in rows if r.source == s] for s in {r.source for r in rows}}
    total, weight = 1.5 * sum(sizes.values()), dict(zip(["a", "b", "c", None], [3, 1, 2, 3]))
    cap, target = {s: 2 * g[0].source_size for s, g in per.items()}, {}
    while len(target) < len(per):  # reshare what is above the cap, by weight
        rest = [s for s in per if s not in target]
        level = (total - sum(target.values())) / sum(weight[s] for s in rest)
        over = [s for s in rest if cap[s] <= weight[s] * level]
        target.update({s: cap[s] for s in over} if over else {s: weight[s] * level for s in rest})
    for s, g in per.items():
        assert g[0].target == pytest.approx(target[s])
        # one block lands among HELD entries; of several small ones only a few entries are left
        near = 0.02 * target[s] + 5 if block == mixing.BLOCK else max(r["size"] for r in g)
        assert abs(sum(r.taken for r in g) - target[s]) <= near


def test_small_sources_land_near_beside_a_large_one(spark):
    r = random.Random(12)
    rows = [(source, r.randint(100, 2000)) for source, n in (("a", 40), ("b", 500), ("c", 100), ("d", 50)) for _ in range(n)]
    df = spark.createDataFrame([(i, s, "w " * n) for i, (s, n) in enumerate(rows)], "doc_id long, source string, text string")
    got = mixing.mix(df, share=0.2, block=64).collect()  # one block, eight, two and one; no source is capped
    assert len(got) == len(rows)
    for s in "abcd":
        own = [x for x in got if x.source == s]
        assert abs(sum(x.taken for x in own) - own[0].target) <= 0.001 * own[0].target + 5, s


def test_flight_keeps_both_totals():
    r = np.random.default_rng(3)
    size, p = r.integers(1, 500, 400).astype(float), np.full(400, 0.3)
    q = mixing.flight(size, p, r)
    assert ((q > 0) & (q < 1)).sum() <= 2
    assert q.sum() == pytest.approx(p.sum()) and q @ size == pytest.approx(p @ size)


def test_chat_round_trip(spark):
    odd = "<|im_end|><|im_start|>assistant ok <\\| <\\\\|"
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", odd), (1, 2, "user", None), (1, 3, "assistant", "é\n"), (2, 0, "sys\ntem", odd),
             (3, 1, "assistant", ""), (3, 0, None, "x"), (3, 2, "user", "tail"), (None, 0, "assistant", "n")]
    df = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id long, turn long, role string, text string, formatted string")
    examples = chat.chat_examples(df)
    got = {r.conv_id: r for r in chat.chat_digests(examples).collect()}
    for conv in (1, 2, 3, None):
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: t[1])
        loss = "".join(t[3] or "" for t in own if t[2] == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), sha("".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
    assert examples.where("conv_id = 1").count() == 2 and examples.where("conv_id = 3").count() == 2
    assert chat.chat_examples(df.limit(0)).count() == 0


def test_urls(spark):
    rows = [(1, "HTTP://A.Example.NET/en/x?y"), (2, "http://example.net"), (3, "http://x.net/"), (4, "http://example.com/de/1"),
            (5, "http://b.org/fr/#z"), (6, "http://borg/fr/"), (7, None), (8, "no scheme"), (9, "http://spam-casino.org/a")]
    got = {r.page_id: r for r in urls.filter_urls(spark.createDataFrame([(*x, "v") for x in rows], "page_id long, url string, verdict string")).collect()}
    assert [got[i].rule for i in range(1, 10)] == ["example.net/en/", None, "net/", "example.com/de/", "org/fr/", None, None, None, None]
    assert (got[1].host, got[1].path, got[7].host, got[8].path, got[2].path) == ("a.example.net", "/en/x", "", "", "")
    assert got[1].verdict == got[5].verdict == "allow" and got[3].verdict == got[4].verdict == "block"
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")  # one class only: allowed
    assert [r.verdict for r in urls.filter_urls(one).collect()] == ["allow"] and urls.filter_urls(one.limit(0)).count() == 0


def test_html(spark):
    menu = "<nav>Home News</nav><div class='site-header'>Top</div><aside>Side</aside>"
    foot = "<div>Read all about our terms of use and the privacy rules here</div><footer>&copy; x</footer>"
    page = lambda body: f"<html><head><title>T</title><style>p{{}}</style></head><body>{menu}{body}{foot}</body>"
    rows = [(1, "http://h/1", page("<article><h1>Head</h1><p>A &amp; b<b>old</b>\n c<br>d<script>x</script></p>"
                                   "<div class='comments'><p>bad</p></div><form>f</form></article>")),
            (2, "http://h/2", page("<div>first own text that is only found on this page of all</div>")),
            (3, "http://h/3", page("<div>second text of its own that no other page has got in it</div>")),
            (4, None, None), (5, "http://h/5", "<article>cut off &am")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract_text(df).collect()}
    assert got == {1: "Head A & bold c d", 2: "first own text that is only found on this page of all",
                   3: "second text of its own that no other page has got in it", 4: "", 5: "cut off &am"}


def test_html_repeats_inside_articles(spark):
    r = random.Random(6)

    def own(n=30):
        return " ".join(f"w{r.randrange(10_000)}" for _ in range(n))
    advert, shared = "Buy the new lamp of our partner today and save a lot", own(12)
    rows, want = [], {}
    for i in range(12):  # an advert on most pages, a passage on a few, a short notice on all
        a, b = own(), own()
        some = [shared] if i < 4 else []
        rows.append((i, "http://h/x", "<article>" + "".join(f"<p>{t}</p>" for t in (a, *([advert] if i < 9 else []), "Read on", *some, b)) + "</article>"))
        want[i] = " ".join((a, *some, b))
    for i in range(12, 40):  # one page crawled often does not erase itself
        rows.append((i, "http://copies/x", f"<article><p>{shared}</p><p>{advert}</p></article>"))
        want[i] = f"{shared} {advert}"
    for i in range(40, 46):  # without article: what only two pages share stays
        a = own()
        rows.append((i, "http://bare/x", f"<div>{a}</div>" + (f"<div>{shared}</div>" if i < 42 else "") + f"<div>{advert}</div>"))
        want[i] = f"{a} {shared}" if i < 42 else a
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {x.page_id: x.text for x in html_text.extract_text(df).collect()} == want


def test_broadcast_guard_measures_arrays(spark):
    df = spark.createDataFrame([(1, [1] * 1000), (2, []), (3, None)], "rid long, places array<long>")
    assert 8000 + 6 * 16 - 8 <= measured_bytes(df) <= 8000 + 6 * 16
    limit = "linkstats.broadcast.maxBytes"
    try:
        for size, broadcast in ((4_000, False), (9_000, True)):
            spark.conf.set(limit, str(size))
            plan = checked_broadcast(df)._jdf.queryExecution().logical().toString()
            assert ("broadcast" in plan.lower()) == broadcast
    finally:
        spark.conf.unset(limit)


def test_decontamination(spark, docs):
    r = random.Random(2)
    item = [f"w{r.randrange(500)}" for _ in range(40)]
    changed = list(item)
    changed[7] = changed[19] = changed[31] = "other"
    cases = [(1, "pre " + " ".join(item).upper() + "!", [10]), (2, " ".join(changed), [10]), (3, " ".join(item[:15]), [10]),
             (4, " ".join(item[:9]), []), (5, None, []), (6, "a few short words", [11]), (7, " ".join(reversed(item)), [])]
    bench = spark.createDataFrame([(10, " ".join(item), "x"), (11, "a few short words", "x"), (12, None, "x"), (13, "of the", "x")],
                                  "item_id long, text string, contaminated string")
    bench = bench.withColumn("text", F.when(F.col("item_id") == 11, "only a few short words").otherwise(F.col("text")))
    cases[5] = (6, "here are only a few short words again", [11])
    df = spark.createDataFrame([c[:2] for c in cases], "doc_id long, text string")
    for block in (500_000, 10):  # one block of seeds, and several
        got = {x.doc_id: x.item_ids for x in decontaminate.overlaps(df, bench, block_words=block).collect()}
        assert got == {c[0]: c[2] for c in cases}
        assert sorted(x.doc_id for x in decontaminate.drop_contaminated(df, bench, block_words=block).collect()) == [4, 5, 7]
    assert not decontaminate.overlaps(docs, bench.limit(0)).where("contaminated").count()


def longest_by_trial(equal, least):
    """All segments that begin and end on a match, with four matches in five words."""
    n = [j - i for i in range(len(equal)) for j in range(i + 1, len(equal) + 1)
         if equal[i] and equal[j - 1] and 5 * sum(equal[i:j]) >= 4 * (j - i)]
    return max(n, default=0) if max(n, default=0) >= least else 0


def test_best_overlap_is_the_longest_segment():
    wrong = []
    for n in range(13, 26):
        for changed in (c for k in (1, 2, 3) for c in itertools.combinations(range(n), k)):
            equal = [i not in changed for i in range(n)]
            # the whole is the longest where it qualifies; else all segments are tried
            inner = 5 * len(changed) <= n and 0 not in changed and n - 1 not in changed
            want = n if inner else longest_by_trial(equal, 13)
            if decontaminate.best_overlap(np.array(equal), 13) != want:
                wrong.append((n, changed))
    assert not wrong
    r = random.Random(4)
    for _ in range(400):
        equal = [r.random() < r.choice((0.7, 0.8, 0.9)) for _ in range(r.randint(0, 45))]
        assert decontaminate.best_overlap(np.array(equal, dtype=bool), 13) == longest_by_trial(equal, 13)
    every_fifth = np.arange(1, 101) % 5 != 0
    assert decontaminate.best_overlap(every_fifth, 13) == 99


def test_seeds_hit_every_pattern_of_the_threshold():
    for n in range(13, 26):  # with the most changes 80 % allow; fewer are included
        changed = np.array([sum(1 << i for i in c) for c in itertools.combinations(range(n), n // 5)])
        hit = np.zeros(len(changed), dtype=bool)
        for mask in decontaminate.masks_of(n):
            bits = sum(1 << i for i, bit in enumerate(mask) if bit == "1")
            for place in range(n - len(mask) + 1):
                hit |= changed & (bits << place) == 0
        assert hit.all(), n
    for n in range(5, 13):
        for c in itertools.combinations(range(n), n // 5):
            assert any(all(m[i] == "0" for i in c) for m in decontaminate.masks_of(n)), (n, c)


def test_decontamination_of_changed_passages(spark):
    sizes = [*range(3, 26), 30, 35, 40]
    items = {n: [f"i{n}w{i}" for i in range(n)] for n in sizes}
    r, cases = random.Random(8), []
    for n in sizes:
        every = list(itertools.combinations(range(n), n // 5))
        for c in every if len(every) <= 60 else r.sample(every, 60):
            for extra in ((), (r.randrange(n),), tuple(r.sample(range(n), 2))):
                changed = {*c, *extra}
                equal = [i not in changed for i in range(n)]
                hit = 5 * sum(equal) >= 4 * n if n < 13 else longest_by_trial(equal, 13) > 0
                text = ["before", "it", *(w if e else "other" for w, e in zip(items[n], equal)), "after"]
                cases.append((len(cases), " ".join(text), [n] if hit and n >= 5 else []))
    cases.append((len(cases), " ".join(items[8][:7]), []))  # the end of the item is not there
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    df = spark.createDataFrame([c[:2] for c in cases], "doc_id long, text string")
    got = {x.doc_id: x.item_ids for x in decontaminate.overlaps(df, bench).collect()}
    assert [(c[1], got[c[0]]) for c in cases if got[c[0]] != c[2]] == []
    kept = sorted(x.doc_id for x in decontaminate.drop_contaminated(df, bench).collect())
    assert kept == [c[0] for c in cases if not c[2]]


def test_toxicity_counterfactual(spark):
    r = random.Random(1)
    vocab = [f"word{i}" for i in range(80)]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = [r.choice(vocab) for _ in range(12)] + (["vile"] if toxic and r.random() < 0.7 else [])
        if r.random() < (0.8 if toxic else 0.05):
            words.append("muslim")  # a group is mentioned more often where the label is 1
        r.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    df, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    probe = spark.createDataFrame([(1, "word1 word2 muslim word3"), (2, "word1 word2 christian word3"), (3, "vile word1"), (4, None)],
                                  "doc_id long, text string")

    def gap(weight):
        s = {x.doc_id: x.score for x in toxicity.score(probe, toxicity.fit(df, lab, counterfactual=weight)).collect()}
        assert s[3] > 0.5 > s[2] and s[4] < 0.5
        return abs(s[1] - s[2])
    assert gap(10.0) < 0.5 * gap(0.0)
    none = toxicity.fit(df, lab.limit(0))
    assert {x.score for x in toxicity.score(df, none).collect()} == {0.0}
    held = {x.doc_id: x.held_out for x in toxicity.score(df, none).collect()}
    assert held == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in held}


def test_empty_tables(spark, empty):
    assert exact_dedup.dedupe(empty, exact_dedup.DigestIndex(spark)).count() == 0
    assert line_dedup.apply_bitmaps(empty, line_dedup.keep_bitmaps(empty)).count() == 0
    assert suffix_dedup.cut_repeats(empty).count() == 0
    assert near_dedup.near_components(empty).count() == 0
    assert mixing.mix(empty).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = {r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        out = near_dedup.materialize(out, f"test_{name}")
        assert 0 < out.count() <= n
        docs, n = out, out.count()
    texts = [r.text for r in docs.collect()]
    assert len({re.sub(r"\s+", " ", t) for t in texts}) == len(texts)
    assert not any(b in t for b in bench for t in texts)
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert mixed.count() == n
