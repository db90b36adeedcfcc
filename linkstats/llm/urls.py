"""URL filter: host and path rules, and gradient-boosted trees on lexical features.

The trees (Spark ML) learn from labelled URLs: lengths, path depth, digit ratio, character
entropy, hyphens, parameter counts and statistics of the host's suffix (its last label): how
many labelled URLs have it and which share of them is blocked. Hosts are dealt into ``FOLDS``
folds by their hash, and a URL sees the suffix statistics of the labelled URLs of the other
folds, so that no label reaches its own features. The statistics cover all labelled URLs; the
trees are fitted on the ``max_labelled`` distinct ones with the smallest hash of the URL.
``held_out_auc`` measures them on hosts whose labels they have not seen.

``weak_labels`` labels URLs where no labelled table is given: a host with a label holding one
of ``JUNK_WORDS`` is labelled 1, others 0. Words are not features, so the trees judge hosts
by their form.

Defined results: host and path of a null url or one without ``://`` are empty; such a url is
judged by the trees like any other; repeated rows are judged alike; with no labelled URL of
one of the classes every unruled url is allowed; other columns are ignored, whatever their
names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkstats.llm.common import lower_ascii, shuffle_width, table
from linkstats.session import checked_broadcast, materialize

# The rules of the contract (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
# Words of junk hosts.
JUNK_WORDS = ["ads", "adult", "bet", "bets", "bingo", "casino", "cheap", "click", "credit", "dating", "deals", "farm",
              "free", "gambling", "loan", "loans", "lottery", "pharmacy", "pills", "poker", "porn", "promo", "slots",
              "spam", "track", "tracker", "viagra", "win", "xxx"]
MAX_LABELLED = 20_000
FOLDS = 5
FEATURES = ["url_len", "host_len", "path_len", "host_labels", "depth", "digit_ratio", "host_entropy", "url_entropy",
            "hyphens", "params", "query_len", "longest_label", "suffix_n", "suffix_rate"]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls. A rule fits its host and all
    subdomains where the path starts with the rule's."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def _entropy(c: Column) -> Column:
    n = F.greatest(F.length(c), F.lit(1)).cast("double")

    def add(acc, ch):
        share = (F.length(c) - F.length(F.replace(c, ch, F.lit("")))) / n
        return acc - share * F.log2(share)
    return F.aggregate(F.filter(F.array_distinct(F.split(c, "")), lambda x: x != ""), F.lit(0.0), add)


def lexical(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """url, host, path, suffix, fold and the lexical features but for the suffix statistics.
    The distinct urls are spread over all tasks: few bytes, but much work each."""
    u = urls.select(F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url")).distinct()
    u = u.repartition(shuffle_width(urls.sparkSession), F.xxhash64("url"))  # by "url" would be dropped beside distinct
    u = u.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                 F.regexp_extract("url", r"(?s)\?([^#]*)", 1).alias("query"))
    labels = F.split("host", r"\.")
    n = F.greatest(F.length("url"), F.lit(1))
    return u.select(
        "url", "host", "path", F.element_at(labels, -1).alias("suffix"), F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int").alias("fold"),
        F.length("url").cast("double").alias("url_len"), F.length("host").cast("double").alias("host_len"),
        F.length("path").cast("double").alias("path_len"), F.size(labels).cast("double").alias("host_labels"),
        F.size(F.filter(F.split("path", "/"), lambda x: x != "")).cast("double").alias("depth"),
        (F.regexp_count("url", F.lit("[0-9]")) / n).alias("digit_ratio"),
        _entropy(F.col("host")).alias("host_entropy"), _entropy(F.col("url")).alias("url_entropy"),
        F.regexp_count("host", F.lit("-")).cast("double").alias("hyphens"),
        F.size(F.filter(F.split("query", "&"), lambda x: x != "")).cast("double").alias("params"),
        F.length("query").cast("double").alias("query_len"),
        F.array_max(F.transform(labels, lambda x: F.length(x))).cast("double").alias("longest_label"))


def weak_labels(urls: DataFrame, words: list[str] = JUNK_WORDS) -> DataFrame:
    """(url, label): 1 where a word of the host is in ``words``."""
    parts = F.split("host", "[^a-z]+")
    return urls.select("url", F.arrays_overlap(parts, F.array(*[F.lit(w) for w in words])).cast("int").alias("label"))


def suffix_statistics(rows: DataFrame) -> DataFrame:
    """(suffix, fold, suffix_n, suffix_rate) over the labelled rows outside each fold."""
    per = rows.groupBy("suffix", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones"))
    whole = per.groupBy("suffix").agg(F.sum("n").alias("all_n"), F.sum("ones").alias("all_ones"))
    every = whole.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(FOLDS - 1))))
    n = F.col("all_n") - F.coalesce("n", F.lit(0))
    ones = F.col("all_ones") - F.coalesce("ones", F.lit(0))
    return every.join(per, ["suffix", "fold"], "left").select(
        "suffix", "fold", n.cast("double").alias("suffix_n"), (ones / F.greatest(n, F.lit(1))).alias("suffix_rate"))


class UrlModel:
    """The fitted trees with the suffix statistics; ``trees`` is None where a class is missing."""

    def __init__(self, lex: DataFrame, labelled: DataFrame, max_labelled: int = MAX_LABELLED, seed: int = 7):
        rows = materialize(lex.join(labelled.select("url", "label").distinct(), "url"), "url_labelled")
        self.stats = materialize(suffix_statistics(rows), "url_suffixes")
        classes = rows.agg(F.count_distinct("label")).first()[0]
        self.trees = None
        if classes == 2:
            sample = materialize(rows.orderBy(F.xxhash64("url"), "url").limit(max_labelled), "url_sample")
            self.trees = GBTClassifier(labelCol="label", featuresCol="features", maxIter=20, maxDepth=4, stepSize=0.3,
                                       seed=seed).fit(self._vectors(sample))

    def _vectors(self, lex: DataFrame) -> DataFrame:
        joined = lex.join(checked_broadcast(self.stats), ["suffix", "fold"], "left").fillna(0.0, ["suffix_n", "suffix_rate"])
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(joined)

    def score(self, lex: DataFrame) -> DataFrame:
        """(url, host, path, score): the estimated probability of label 1."""
        if self.trees is None:
            return lex.select("url", "host", "path", F.lit(0.0).alias("score"))
        scored = self.trees.transform(self._vectors(lex))
        return scored.select("url", "host", "path", vector_to_array("probability")[1].alias("score"))


def held_out_auc(urls: DataFrame, labelled: DataFrame | None = None, url_col: str = "url", max_labelled: int = MAX_LABELLED) -> float:
    """Area under the ROC curve on the hosts of fold 0, for trees and suffix statistics made
    from the labels of the other folds alone. Needs both classes on both sides."""
    lex = materialize(lexical(urls, url_col), "url_features")
    labelled = labelled if labelled is not None else weak_labels(lex)
    known = labelled.join(lex.where("fold <> 0").select("url"), "url", "left_semi")
    model = UrlModel(lex.where("fold <> 0"), known, max_labelled)
    scored = model.score(lex.where("fold = 0")).join(labelled.select("url", F.col("label").cast("double").alias("label")).distinct(), "url")
    return BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label").evaluate(scored)


def filter_urls(pages: DataFrame, labelled: DataFrame | None = None, rules=RULES, id_col: str = "page_id",
                url_col: str = "url", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score."""
    lex = materialize(lexical(pages, url_col), "url_features")
    model = UrlModel(lex, labelled if labelled is not None else weak_labels(lex), max_labelled)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = model.score(lex).select(F.col("url").alias("__url"), "host", "path", rule.alias("rule"),
                                     F.coalesce(verdict, F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"),
                                     "score")
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("__url"))
    return rows.join(judged, "__url").drop("__url")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))
