"""Operator 9: the sparse suffix array against brute force, broken markup, repeated rows."""

import random
import time
from collections import defaultdict

import numpy as np

from linkstats.llm import html_text as h


def blocks_of(markup):
    return [t for t, _, skip in h.page_blocks(markup) if not skip]


def test_spans_cover_and_agree():
    r = np.random.default_rng(3)
    for _ in range(200):
        texts = [r.integers(0, 4, r.integers(0, 40)).astype(np.uint64) for _ in range(r.integers(1, 6))]
        words, at = np.concatenate(texts).astype(np.uint64), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        if not len(words):
            continue
        text, first, end = h.spans(h.wh.mix(words), at)
        covered = np.zeros(len(words), dtype=int)
        for t, a, b in zip(text, first, end):
            assert at[t] <= a < b <= at[t + 1]
            covered[a:b] += 1
        assert (covered > 0).all()
    a = np.arange(100, dtype=np.uint64)
    for left in range(12):  # an equal run has equal spans wherever it stands, but for its ends
        words = h.wh.mix(np.concatenate([np.arange(1000, 1000 + left, dtype=np.uint64), a]))
        _, first, end = h.spans(words, np.array([0, len(words)]))
        got = {(x - left, y - left) for x, y in zip(first, end) if x >= left + 8}
        alone = h.spans(h.wh.mix(a), np.array([0, 100]))
        assert got == {(x, y) for x, y in zip(*alone[1:]) if x >= 8}


def brute_texts(pages):
    """Blocks whose every span lies on MIN_PAGES distinct pages and SHARE of the host's go."""
    hosts = defaultdict(set)
    for host, blocks in pages:
        hosts[host].add(tuple(blocks))
    out = []
    for host, blocks in pages:
        n = len(hosts[host])

        def common(words):
            return sum(any(words == b.split()[i:i + len(words)] for b in p for i in range(len(b.split()))) for p in hosts[host])
        kept = []
        for b in blocks:
            words = b.split()
            windows = [words[i:i + h.WINDOW] for i in range(max(1, len(words) - h.WINDOW + 1))]
            whole = [p for p in hosts[host] if b in p]
            gone = n >= h.MIN_PAGES and len(whole) >= max(h.MIN_PAGES, h.SHARE * n)
            if not gone:
                assert not all(common(w) >= max(h.MIN_PAGES, h.SHARE * n) for w in windows) or n < h.MIN_PAGES
                kept.append(b)
        out.append(" ".join(kept))
    return out


def test_repeats_equal_brute_force_and_reruns_agree(spark):
    r = random.Random(11)
    pages = []
    for host in range(4):
        shared = [" ".join(f"s{host}x{i}y{r.randrange(50)}" for _ in range(r.randint(1, 30))) for i in range(5)]
        for _ in range(r.randint(2, 9)):
            own = [" ".join(f"o{r.randrange(100_000)}" for _ in range(r.randint(1, 30))) for _ in range(6)]
            pages.append((host, own[:3] + [s for i, s in enumerate(shared) if r.random() < i / 4] + own[3:]))
    pages += [pages[0], pages[0], pages[5]]  # repeated rows
    rows = [(i if i < len(pages) - 3 else [0, 0, 5][i - len(pages) + 3], f"http://h{host}/x", "".join(f"<p>{b}</p>" for b in blocks))
            for i, (host, blocks) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted(zip([x[0] for x in rows], brute_texts(pages)))
    for parts in (1, 5):
        assert sorted((x.page_id, x.text) for x in h.extract_text(df.repartition(parts)).collect()) == want
    assert any(len(t.split()) < sum(len(b.split()) for b in p[1]) for (_, t), p in zip(want, sorted(zip([x[0] for x in rows], [p[1] for p in pages]))))
    assert h.extract_text(df.limit(0)).count() == 0


def test_broken_markup():
    assert blocks_of("<p title=it's>Text</p>") == ["Text"]
    assert blocks_of('<p title="a > b" x=\'>\'>Text') == ["Text"]
    assert blocks_of('<p title="never closed>Text</p><p>More') == ["Text", "More"]
    assert blocks_of("1 < 2 <b>x</b> <3 </> a<!-- <p> --> b <!-- open <p>c") == ["1 < 2 x <3 a b"]
    assert blocks_of("a <p class=x") == ["a <p class=x"]
    assert blocks_of("<script>if (a<b) '</p>'</script >x<textarea>y") == ["x"]
    assert blocks_of("") == [] and blocks_of("<!DOCTYPE html><?php x ?>t") == ["t"]


def test_linear_in_what_is_never_closed():
    def seconds(n):
        t = time.perf_counter()
        for piece in ("<p title='x ", '<a b="c" <', "<!-", "<p a=\"b>'", "</", "<x ="):
            h.page_blocks(piece * n)
        return time.perf_counter() - t
    assert seconds(20_000) < 40 * max(seconds(2_000), 0.003)
