"""What models are fitted on and measured by, benchmark items of few words, examples read back in order."""

import math
import random

from pyspark.sql import functions as F

from linkstats.llm import chat, decontaminate, toxicity, urls


def url_rows(spark, n=400):
    """Junk hosts are long and hyphenated; each host has several urls."""
    r = random.Random(3)

    def word(a, b):
        return "".join(r.choice("abcdefghij") for _ in range(r.randint(a, b)))
    rows = []
    for i in range(n):
        junk = i % 3 == 0
        host = "-".join(word(4, 8) for _ in range(3)) if junk else word(4, 9)
        host += "." + r.choice(["aa", "bb", "cc"])
        rows += [(f"http://{host}/{word(2, 6)}/{k}", int(junk)) for k in range(2)]
    return spark.createDataFrame(rows, "url string, label int")


def test_suffix_statistics_leave_out_the_fold(spark):
    rows = [("aa", 0, 1), ("aa", 0, 1), ("aa", 1, 0), ("aa", 2, 1), ("bb", 3, 1)]
    got = {(r.suffix, r.fold): (r.suffix_n, r.suffix_rate) for r in
           urls.suffix_statistics(spark.createDataFrame(rows, "suffix string, fold int, label int")).collect()}
    assert len(got) == 2 * urls.FOLDS
    for s, f in got:
        rest = [y for suffix, fold, y in rows if suffix == s and fold != f]
        assert got[s, f] == (len(rest), sum(rest) / max(1, len(rest)))


def test_no_label_reaches_the_features_of_its_own_host(spark):
    """Turning the labels of one fold's hosts over leaves their suffix statistics as they are."""
    rows = url_rows(spark, 60)
    lex = urls.lexical(rows)
    turned = lex.where("fold = 0").select("url").withColumn("turn", F.lit(1))
    other = rows.join(turned, "url", "left").select("url", F.when(F.col("turn") == 1, 1 - F.col("label")).otherwise(F.col("label")).alias("label"))

    def statistics(labelled):
        per = urls.suffix_statistics(lex.join(labelled, "url").select("suffix", "fold", "label"))
        return {(r.suffix, r.fold): (r.suffix_n, r.suffix_rate) for r in per.collect()}
    a, b = statistics(rows), statistics(other)
    assert all(a[k] == b[k] for k in a if k[1] == 0) and a != b


def test_trees_judge_unseen_hosts(spark):
    rows = url_rows(spark)
    assert urls.held_out_auc(rows, rows) > 0.95
    r = random.Random(8)
    noise = spark.createDataFrame([(x.url, int(r.random() < 0.3)) for x in rows.collect()], "url string, label int")
    assert abs(urls.held_out_auc(rows, noise) - 0.5) < 0.2  # labels without a rule cannot be learned


def test_items_of_few_words_match_word_for_word(spark):
    docs = spark.createDataFrame([(1, "so the Quick, brown fox ran"), (2, "the quick red fox"), (3, "fox"), (4, ""), (5, None)], "doc_id long, text string")
    items = spark.createDataFrame([(10, "quick brown fox"), (11, "fox!"), (12, "the quick red fox"), (13, "the quick tan fox"), (14, "")],
                                  "item_id long, text string")

    def found(**options):
        return {r.doc_id: (list(r.item_ids), r.longest, r.contaminated) for r in decontaminate.overlaps(docs, items, **options).collect()}
    assert not any(hit for _, _, hit in found().values())
    got = found(min_item=1)
    assert got == {1: ([10, 11], 3, True), 2: ([11, 12], 4, True), 3: ([11], 1, True), 4: ([], 0, False), 5: ([], 0, False)}
    assert found(min_item=3)[3] == ([], 0, False) and found(min_item=1, block_words=1) == got
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, items, min_item=1).collect()) == [4, 5]


def test_examples_read_back_as_they_leave(spark):
    r = random.Random(1)
    turns = [(c, t, r.choice(["user", "assistant"]), r.choice(["", "a<|im_end|>\n", "é\\", "plain"])) for c in range(30) for t in range(r.randint(1, 9))]
    turns += [(7, 100 + t, "assistant", "again " * 50) for t in range(60)]  # the longest conversation holds most of the text
    df = spark.createDataFrame([*turns, (None, 0, "assistant", "n")], "conv_id long, turn long, role string, text string").repartition(5)
    order = ["conv_id", "n_turns", "turns_sha256", "loss_sha256"]
    in_order = chat.chat_digests(chat.chat_examples(df), in_order=True)
    assert [*map(tuple, in_order.orderBy(*order).collect())] == [*map(tuple, chat.chat_digests(chat.chat_examples(df)).orderBy(*order).collect())]
    plan = in_order._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1


def test_the_penalty_weight_comes_from_training_folds():
    r = random.Random(2)

    def row(label):  # feature 0 tells the label, the others tell nothing
        at = sorted({0} if r.random() < (0.9 if label else 0.05) else set()) + sorted(r.sample(range(1, 40), 6))
        return {"label": label, "sign": 0, "at": at, "value": [math.log(2)] * len(at)}
    rows = [row(int(i % 4 == 0)) for i in range(300)]
    assert toxicity.choose_l1(rows, 40, choices=(1e-3, 10.0)) == 1e-3  # 10 leaves no feature
    assert toxicity.choose_l1(rows, 40) == toxicity.choose_l1(list(reversed(rows)), 40)
    assert toxicity.choose_l1([row(0) for _ in range(20)], 40) == toxicity.L1 and toxicity.choose_l1([], 40) == toxicity.L1
