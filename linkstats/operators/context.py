"""Context vectors per entity.

Only the paragraphs that something links to are tokenised, each once and beside those that
link to it: a task adds up their words before the shuffle and packs the counts of an owner in a
row, so neither the words of a paragraph nor the product of uris and words is ever shuffled. Uris that are spotted by
the same keys (``KeyedParagraphs``) are counted and rendered once, as one group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkstats import session as sess
from linkstats.functions import stem as st
from linkstats.functions import text as tx
from linkstats.functions import uris as ur
from linkstats.session import map_arrow


def stem_vocabulary(texts: DataFrame, text_col: str = "para", algorithm: str = "s") -> DataFrame:
    """T2 at vocabulary level: (token, stem) for every distinct lower-cased word."""
    toks = texts.select(F.explode(tx.words(F.col(text_col))).alias("w")).select(F.lower("w").alias("token")).distinct()
    return st.stem_table(toks, "token", "stem", algorithm).select("token", "stem")


def stem_vocabulary_by_language(texts: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, token, stem) for every distinct lower-cased word of each language, by the
    language's own stemmer; words of a language without one (or of none) stay as they are."""
    words = (texts.select(F.col(lang_col).alias("lang"), F.explode(tx.words(F.col(text_col))).alias("w"))
             .select("lang", F.lower("w").alias("token")).distinct())
    words = sess.materialize(words, "language_words")
    known = F.coalesce(F.col("lang").isin(list(st.BY_LANGUAGE)), F.lit(False))
    out = words.where(~known).select("lang", "token", F.col("token").alias("stem"))
    for lang, algorithm in st.BY_LANGUAGE.items():
        out = out.unionByName(st.stem_table(words.where(F.col("lang") == lang), algorithm=algorithm).select("lang", "token", "stem"))
    return out


def _stem_lookup(tokens: DataFrame, algorithm: str) -> DataFrame:
    """(token, stem) for distinct tokens. A projection-chain stemmer's output is written
    once, so joins plan against a plain scan and the chain runs a single time."""
    out = st.stem_table(tokens, "token", "stem", algorithm).select("token", "stem")
    return out if algorithm in st.STEMMERS else sess.materialize(out, f"stems_{algorithm}")


def stemmed_stop_words(stop_words: DataFrame, algorithm: str = "s") -> DataFrame:
    """Stop words are tokenised and stemmed like the text before comparing."""
    toks = stop_words.select(F.explode(tx.words(F.col("word"))).alias("token")).distinct()
    return _stem_lookup(toks, algorithm).select("stem").distinct()


def stemmed_words(words: DataFrame, algorithm: str = "s") -> DataFrame:
    """(para_key, stem) from (para_key, w). Column stemmers run on every word; the
    Porter chain runs once per distinct lower-cased word and joins back (the vocabulary
    is broadcast only when measured under the limit)."""
    if algorithm in st.STEMMERS:
        return words.select("para_key", st.stem(F.col("w"), algorithm).alias("stem"))
    lowered = words.select("para_key", F.lower("w").alias("token"))
    vocab = _stem_lookup(lowered.select("token").distinct(), algorithm)
    return lowered.join(sess.checked_broadcast(vocab), "token").select("para_key", "stem")


def paragraph_token_counts(paragraphs: DataFrame, stop_words: DataFrame | None = None,
                           algorithm: str = "s") -> DataFrame:
    """(para_key, stem, n) for every distinct paragraph, stop words removed."""
    w = paragraphs.select("para_key", F.explode(tx.words(F.col("para"))).alias("w"))
    s = stemmed_words(w, algorithm)
    if stop_words is not None:
        # The stop list is the user's: it is broadcast only after it was measured.
        s = s.join(sess.checked_broadcast(stemmed_stop_words(stop_words, algorithm)), "stem", "left_anti")
    return s.groupBy("para_key", "stem").agg(F.count(F.lit(1)).alias("n"))


# Uris of one paragraph that one task multiplies with the paragraph's tokens.
BLOCK = 10_000
# Uris of one group that one task gives the group's rows to.
GROUP_BLOCK = 1_000
# Words and owners of a block of paragraphs, entries of a product at once, entries that a task adds up, and
# entries that it packs at once.
WORDS, PRODUCT, ENTRIES, PACK = 1 << 18, 1 << 18, 1 << 21, 1 << 18
# Paragraphs of an owner for each part of its counts, and the most parts.
PART, PARTS = 1_000, 1_024
# Entries of a vector in one piece of its text, and bytes of vectors that a task gives out at once.
CHUNK, TEXT = 100, 1 << 20


def blocked(pairs: DataFrame, counts: DataFrame, block: int = BLOCK, key: str = "para_key",
            each: str = "uri") -> tuple[DataFrame, DataFrame]:
    """Both sides of the product (uri, para_key) x (para_key, stem, n) with a block number: a
    paragraph that more than ``block`` uris link to is cut into blocks of about so many uris,
    and its tokens stand in each of them. The paragraphs with several blocks are at most one
    in ``block`` pairs; their table is broadcast only when measured under the limit."""
    hot = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block)
    hot = sess.materialize(hot.select(key, F.ceil(F.col("_n") / block).cast("int").alias("_blocks")), "hot_paragraphs")
    if hot.isEmpty():
        return pairs.withColumn("_block", F.lit(0)), counts.withColumn("_block", F.lit(0))
    side = sess.checked_broadcast(hot)
    n = F.coalesce("_blocks", F.lit(1))
    left = pairs.join(side, key, "left").withColumn("_block", F.pmod(F.xxhash64(each), n).cast("int")).drop("_blocks")
    right = counts.join(side, key, "left").withColumn("_block", F.explode(F.sequence(F.lit(0), n - 1))).drop("_blocks")
    return left, right


@dataclass
class KeyedParagraphs:
    """The pairs of uris and paragraphs as (uri, key) and (key, para_key): a uri belongs to the
    distinct paragraphs that hold one of its keys. Many uris may share a key that many
    paragraphs hold, so the pairs may outgrow both tables by far; they are only made as output."""

    keys: DataFrame    # (uri, key)
    places: DataFrame  # (key, para_key), distinct

    def grouped(self) -> tuple[DataFrame, DataFrame]:
        """(uri, group), each uri once, and (group, key, n_keys): uris with the same keys are one
        group, known by the sums of the digits of its keys' SHA-256, in whatever order."""
        keys = self.keys.select("uri", "key").distinct()
        digits = [F.conv(F.substring(F.sha2("key", 256), 16 * i + 1, 16), 16, 10).cast("decimal(38,0)") for i in range(4)]
        sums = keys.groupBy("uri").agg(F.count(F.lit(1)).alias("n_keys"), *[F.sum(d).alias(f"_{i}") for i, d in enumerate(digits)])
        uris = sums.select("uri", F.concat_ws(" ", "n_keys", *[f"_{i}" for i in range(4)]).alias("group"), "n_keys")
        uris = sess.materialize(uris, "uri_groups")
        own = uris.withColumnRenamed("uri", "_uri")
        groups = keys.join(own, F.col("uri").eqNullSafe(F.col("_uri"))).select("group", "key", "n_keys").distinct()
        return uris.select("uri", "group"), sess.materialize(groups, "group_keys")

    def pairs(self, block: int = GROUP_BLOCK) -> DataFrame:
        """The distinct (uri, para_key)."""
        uris, groups = self.grouped()
        found = groups.join(self.places, "key")
        several = F.col("n_keys") > 1  # a paragraph may hold several keys of such a group
        found = (found.where(~several).select("group", "para_key")
                 .unionByName(found.where(several).select("group", "para_key").distinct()))
        return _for_uris(uris, found, block).select("uri", "para_key")

    def encoded(self, lang: str) -> KeyedParagraphs:
        return KeyedParagraphs(self.keys.select(ur.wiki_url(F.col("uri"), lang).alias("uri"), "key"), self.places)


def _for_uris(uris: DataFrame, rows: DataFrame, block: int = GROUP_BLOCK) -> DataFrame:
    """The rows of each group for each of its uris; a large group's uris are cut into blocks."""
    left, right = blocked(uris, rows, block, "group")
    return left.join(right, ["group", "_block"]).drop("group", "_block")


def _word_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paragraphs (owners, words) as blocks of about ``WORDS`` words: a row (token) for each
    distinct word of the block, then one with its paragraphs as numbers of these words (body)."""
    for batch in batches:
        batch = pa.Table.from_batches([batch]).combine_chunks().to_batches()
        for rows in batch:
            load = pc.add(*[pc.fill_null(pc.list_value_length(rows.column(c)), 0) for c in ("owners", "words")])
            block = np.cumsum(load.to_numpy(zero_copy_only=False).astype(np.int64)) // WORDS
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), rows.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                part = rows.slice(lo, hi - lo)
                words = part.column("words").flatten().dictionary_encode()
                n = pc.fill_null(pc.list_value_length(part.column("words")), 0).to_numpy(zero_copy_only=False)
                numbers = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), words.indices.cast(pa.int32()))
                sink = pa.BufferOutputStream()
                content = pa.RecordBatch.from_arrays([part.column("owners"), numbers], names=["owners", "words"])
                with pa.ipc.new_stream(sink, content.schema) as out:
                    out.write_batch(content)
                tokens = words.dictionary.cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([tokens, pa.nulls(1, pa.string())]), pa.concat_arrays(
                    [pa.nulls(len(tokens), pa.binary()), pa.array([sink.getvalue().to_pybytes()], pa.binary())])], names=["token", "body"])


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (n[0] of them), start[1], ..."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Where the runs of equal keys begin in sorted ones."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def _added_up(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes, sorted, and the sums of their counts; empties both lists."""
    code, count = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (codes, counts))
    codes.clear()
    counts.clear()
    order = np.argsort(code, kind="stable")
    code, count = code[order], count[order]
    del order
    first = _firsts(code)
    return code[first], (np.add.reduceat(count, first) if len(code) else count)


class _Sums:
    """Counts of (owner, stem), at most about ``ENTRIES`` before they are given out."""

    def __init__(self):
        self.owners: dict = {}
        self.parts: list[int] = []
        self.stems: dict[str, int] = {}
        self.codes, self.counts, self.size = [], [], 0

    def number(self, owner, parts: int) -> int:
        if owner not in self.owners:
            self.owners[owner] = len(self.parts)
            self.parts.append(parts)
        return self.owners[owner]

    def add(self, code: np.ndarray, count: np.ndarray) -> bool:
        """Whether the sums should be given out."""
        self.codes.append(code)
        self.counts.append(count)
        self.size += len(code)
        if self.size <= ENTRIES:
            return False
        code, count = _added_up(self.codes, self.counts)
        self.codes.append(code)
        self.counts.append(count)
        self.size = len(code)
        return self.size > ENTRIES // 2

    def rows(self) -> Iterator[pa.RecordBatch]:
        """(owner, part, parts, packed); an owner without words has one row. A batch has the rows
        of about ``PACK`` entries. The sums are empty afterwards."""
        code, count = _added_up(self.codes, self.counts)
        owner, stem, parts = (code >> 32).astype(np.int32), (code & 0xFFFFFFFF).astype(np.int32), np.array(self.parts, np.int32)
        del code
        owners, names = pa.array(list(self.owners), pa.string()), pa.array(list(self.stems), pa.string())
        part = np.zeros(len(owner), np.int32)
        if (parts > 1).any():
            digest = np.fromiter((zlib.crc32(x.encode()) for x in self.stems), np.int64, len(self.stems))
            self.stems = {}
            part = (digest[stem] % parts[owner]).astype(np.int32)
            order = np.lexsort((part, owner))
            owner, stem, part, count = owner[order], stem[order], part[order], count[order]
            del order, digest
        first = _firsts(owner, part)
        ends = np.append(first, len(owner))
        cuts = [0, *(np.flatnonzero(np.diff(first // PACK)) + 1).tolist(), len(first)]

        def batch(of: np.ndarray, part: np.ndarray, packed: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([owners.take(pa.array(of)), pa.array(part), pa.array(parts[of]), packed],
                                              names=["owner", "part", "parts", "packed"])

        for lo, hi in zip(cuts, cuts[1:]):
            a, b = ends[lo], ends[hi]
            if a == b:
                continue
            entries = pc.binary_join_element_wise(names.take(pa.array(stem[a:b])), pa.array(count[a:b]).cast(pa.string()), ",")
            packed = pc.binary_join(pa.ListArray.from_arrays((ends[lo:hi + 1] - a).astype(np.int32), entries), " ")
            yield batch(owner[first[lo:hi]], part[first[lo:hi]], packed.cast(pa.string()))
        bare = np.setdiff1d(np.arange(len(parts), dtype=np.int32), owner)
        if len(bare):
            yield batch(bare, np.zeros(len(bare), np.int32), pa.array([""] * len(bare), pa.string()))


def _multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The product of owners and words of ``_word_blocks`` with stems, added up in the task."""
    sums, held = _Sums(), []
    for batch in batches:
        at = 0
        for end in np.flatnonzero(batch.column("body").is_valid().to_numpy(zero_copy_only=False)).tolist():
            stems = [x for c in [*held, batch.column("stem").slice(at, end - at)] for x in c.to_pylist()]
            at, held = end + 1, []
            with pa.ipc.open_stream(batch.column("body")[end].as_buffer()) as body:
                rows = body.read_next_batch()
            own = rows.column("owners")
            n_own = pc.fill_null(pc.list_value_length(own), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = own.flatten()
            names, w, parts = (flat.field(c) for c in ("owner", "w", "parts"))
            w, names, parts = w.to_numpy(zero_copy_only=False), names.to_pylist(), parts.to_pylist()
            words, n_words = rows.column("words").flatten().to_numpy(), pc.list_value_length(rows.column("words")).to_numpy()
            # (paragraph, stem, n), by the block's own stems
            distinct = {}
            local = np.array([distinct.setdefault(x, len(distinct)) for x in stems], np.int64)
            code = np.repeat(np.arange(len(n_words)), n_words) * (len(distinct) + 1) + local[words]
            code, n = _added_up([code], [np.ones(len(code), np.int64)])
            paragraph, kind = code // (len(distinct) + 1), code % (len(distinct) + 1)
            start, stop = (np.searchsorted(paragraph, np.arange(len(n_words)), side=x) for x in ("left", "right"))
            of = np.repeat(np.arange(len(n_own)), n_own)
            size = (stop - start)[of]
            cuts = np.cumsum(size) // PRODUCT
            cuts = [0, *(np.flatnonzero(np.diff(cuts)) + 1).tolist(), len(of)]
            kinds = list(distinct)
            for lo, hi in zip(cuts, cuts[1:]):
                owner = np.array([sums.number(o, p) for o, p in zip(names[lo:hi], parts[lo:hi])], np.int64)
                known = np.array([sums.stems.setdefault(x, len(sums.stems)) for x in kinds], np.int64)
                take = _ranges(start[of[lo:hi]], size[lo:hi])
                if sums.add((np.repeat(owner, size[lo:hi]) << 32) + known[kind[take]], n[take] * np.repeat(w[lo:hi], size[lo:hi])):
                    yield from sums.rows()
                    sums = _Sums()
        if at < batch.num_rows:
            held.append(batch.column("stem").slice(at))
    if sums.owners:
        yield from sums.rows()
    pa.default_memory_pool().release_unused()  # the worker stays for other tasks


def _with_owners(paragraphs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``paragraphs`` without those that no pair has, as far as 64-bit hashes of their keys tell,
    so that their texts are not shuffled; all of them if the hashes are too many to broadcast."""
    digest = F.xxhash64(F.col("para_key").cast("string"))
    owned = sess.materialize(pairs.select(digest.alias("_digest")).distinct(), "owned_paragraphs")
    if sess.measured_bytes(owned) > sess.broadcast_limit(owned.sparkSession):
        return paragraphs
    return paragraphs.join(F.broadcast(owned), digest == F.col("_digest"), "left_semi")


def _token_sums(pairs: DataFrame, paragraphs: DataFrame, owner: str, stop_words: DataFrame | None,
                algorithm: str, block: int = BLOCK) -> DataFrame:
    """(owner, part, parts, packed) from (owner, para_key, w): a paragraph's tokens count ``w``
    times for an owner. ``packed`` holds ``stem,n`` entries without stop words, divided by blanks,
    in several parts by the stem for an owner of many paragraphs; it is empty without tokens.

    Its owners come to the paragraph as an array of a block at most; a task multiplies and adds
    up its paragraphs and gives out a row for each owner, so that neither an owner's name nor a
    row's frame is shuffled with each entry. A stemmer sees the distinct words of a block."""
    paragraphs = _with_owners(paragraphs.select("para_key", "para"), pairs)
    many = pairs.groupBy(owner).agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts")).where(F.col("parts") > 1)
    many = sess.materialize(many.select(F.col(owner).alias("_owner"), F.least("parts", F.lit(PARTS)).alias("parts")), "many_paragraphs")
    pairs = pairs.join(sess.checked_broadcast(many), F.col(owner).eqNullSafe(F.col("_owner")), "left")
    left, right = blocked(pairs, paragraphs, block, each=owner)
    one = F.struct(F.col(owner).cast("string").alias("owner"), F.col("w").cast("long").alias("w"), F.coalesce("parts", F.lit(1)).alias("parts"))
    left = left.groupBy("para_key", "_block").agg(F.collect_list(one).alias("owners"))
    blocks = left.join(right, ["para_key", "_block"], "left").select("owners", tx.words(F.col("para")).alias("words"))
    blocks = map_arrow(blocks, _word_blocks, "token string, body binary")
    if algorithm not in st.STEMMERS:
        blocks = blocks.withColumn("token", F.lower("token"))
    stemmed = st.stem_table(blocks, "token", "stem", algorithm, spread=False).select("stem", "body")
    sums = map_arrow(stemmed, _multiplied, "owner string, part int, parts int, packed string").withColumnRenamed("owner", owner)
    part = [owner, "part", "parts"]
    sums = _unpacked(sums.repartition(*part), part).groupBy(*part, "stem").agg(F.sum("n").alias("n"))
    entry = F.col("stem").isNotNull()
    if stop_words is not None:
        # a stop list of stems is the user's: it is broadcast only after it was measured
        stops = stemmed_stop_words(stop_words, algorithm).select(F.col("stem").alias("_stop"))
        sums = sums.join(sess.checked_broadcast(stops), F.col("stem") == F.col("_stop"), "left")
        entry = entry & F.col("_stop").isNull()
    entries = F.collect_list(F.when(entry, F.concat_ws(",", "stem", F.col("n").cast("string"))))
    return sums.groupBy(*part).agg(F.array_join(F.sort_array(entries), " ").alias("packed"))


def _unpacked(rows: DataFrame, keep: list[str]) -> DataFrame:
    """(keep, stem, n) of packed rows; a row with a null stem for an empty one."""
    some = F.col("_e") != ""
    return rows.select(*keep, F.explode(F.split("packed", " ")).alias("_e")).select(
        *keep, F.when(some, F.substring_index("_e", ",", 1)).alias("stem"), F.when(some, F.substring_index("_e", ",", -1).cast("long")).alias("n"))


def _marked(counts: DataFrame, owners: DataFrame) -> DataFrame:
    """``counts`` and a row with a null stem for each owner, so that none is lost."""
    none = [F.lit(None).cast("string").alias("stem"), F.lit(None).cast("long").alias("n")]
    return counts.unionByName(owners.distinct().select(*owners.columns, *none))


def _group_counts(places: DataFrame, groups: DataFrame, paragraphs: DataFrame, stop_words: DataFrame | None,
                  algorithm: str, block: int) -> tuple[DataFrame, DataFrame]:
    """Counts over the distinct paragraphs of each group: of those with one key packed, as its
    key's; of the others as (uri, stem, n), the sums of their keys, less what paragraphs with m
    of them were counted too often, m - 1 times."""
    by_key = sess.materialize(_token_sums(places.withColumn("w", F.lit(1).cast("long")), paragraphs, "key", stop_words, algorithm, block), "key_sums")
    single = groups.where("n_keys = 1").join(by_key, "key").select(F.col("group").alias("uri"), "parts", "packed")
    several = sess.materialize(groups.where("n_keys > 1").select("group", "key"), "several_keys")
    crowded = places.groupBy("para_key").agg(F.count(F.lit(1)).alias("_m")).where("_m > 1").select("para_key")
    crowded = places.join(several, "key").join(crowded, "para_key").groupBy("group", "para_key")
    crowded = sess.materialize(crowded.agg((1 - F.count(F.lit(1))).alias("w")).where("w < 0"), "crowded_paragraphs")
    more = _unpacked(several.join(by_key, "key"), ["group"])
    if not crowded.isEmpty():
        more = more.unionByName(_unpacked(_token_sums(crowded, paragraphs, "group", stop_words, algorithm, block), ["group"]))
    return single, more.groupBy(F.col("group").alias("uri"), "stem").agg(F.sum("n").cast("long").alias("n"))


def _summed(uri_paragraphs: DataFrame | KeyedParagraphs, paragraphs: DataFrame, stop_words: DataFrame | None, algorithm: str,
            lang: str, encode: bool, block: int = BLOCK) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """The counts over the distinct paragraphs of each uri, packed (uri, parts, packed), and None
    twice; of ``KeyedParagraphs`` the same for each group in place of a uri, those of groups with
    several keys as (uri, stem, n) with a null stem for each group, and (uri, group)."""
    if isinstance(uri_paragraphs, KeyedParagraphs):
        keyed = uri_paragraphs.encoded(lang) if encode else uri_paragraphs
        places = sess.materialize(keyed.places, "key_places")
        uris, groups = keyed.grouped()
        single, several = _group_counts(places, groups, paragraphs, stop_words, algorithm, block)
        linked = groups.where("n_keys > 1").join(places.select("key").distinct(), "key").select(F.col("group").alias("uri"))
        return single, _marked(several.where(F.col("stem").isNotNull()), linked), uris
    pairs = uri_paragraphs
    if encode:
        pairs = pairs.select(ur.wiki_url(F.col("uri"), lang).alias("uri"), "para_key")
    pairs = sess.materialize(pairs.select("uri", "para_key").distinct(), "uri_paragraph_pairs")
    packed = _token_sums(pairs.withColumn("w", F.lit(1).cast("long")), paragraphs, "uri", stop_words, algorithm, block)
    return sess.materialize(packed.select("uri", "parts", "packed"), "uri_sums"), None, None


def _counted(uri_paragraphs: DataFrame | KeyedParagraphs, paragraphs: DataFrame, stop_words: DataFrame | None,
             algorithm: str, lang: str, encode: bool, block: int = BLOCK) -> tuple[DataFrame, DataFrame | None]:
    """(uri, stem, n) over the distinct paragraphs of each uri and a row with a null stem for it,
    and None; of ``KeyedParagraphs`` the same for each group in place of a uri, and (uri, group)."""
    packed, several, uris = _summed(uri_paragraphs, paragraphs, stop_words, algorithm, lang, encode, block)
    counts = _marked(_unpacked(packed, ["uri"]).where(F.col("stem").isNotNull()), packed.select("uri"))
    return (counts if several is None else counts.unionByName(several)), uris


def _each_uri(rows: DataFrame, uris: DataFrame | None, few: bool = False) -> DataFrame:
    """``rows`` of groups (in the column uri) for each of their uris. A few, possibly large rows
    that are written are not shuffled and sorted, if their uris can be broadcast."""
    if uris is None:
        return rows
    rows = rows.withColumnRenamed("uri", "group")
    if few:
        uris = sess.materialize(uris.join(rows.select("group").distinct(), "group", "left_semi"), "uris_of_few")
        if sess.measured_bytes(uris) <= sess.broadcast_limit(uris.sparkSession):
            return rows.join(F.broadcast(uris), "group").drop("group").select("uri", *[c for c in rows.columns if c != "group"])
    return _for_uris(uris, rows).select("uri", *[c for c in rows.columns if c != "group"])


def token_counts(uri_paragraphs: DataFrame | KeyedParagraphs, paragraphs: DataFrame, stop_words: DataFrame | None = None,
                 algorithm: str = "s", lang: str = "en", encode: bool = True, block: int = BLOCK) -> DataFrame:
    """T4: (uri, stem, n) summed over the distinct paragraphs linking to each uri.
    The uri is encoded to its wiki URL first, so ids that encode alike merge."""
    packed, several, uris = _summed(uri_paragraphs, paragraphs, stop_words, algorithm, lang, encode, block)
    counts = _unpacked(_each_uri(packed.where("packed <> ''").select("uri", "packed"), uris), ["uri"])
    if several is not None:
        counts = counts.unionByName(_each_uri(several.where(F.col("stem").isNotNull()), uris))
    return counts


def render_vectors(counts: DataFrame, top_k: int | None = None) -> DataFrame:
    """T5: (uri, vector) with vector = "(stem,n),(stem,n),..." by count desc, stem asc,
    from (uri, stem, n) rows where a null stem only marks a uri without tokens (empty
    vector). ``top_k`` keeps the k strongest stems per uri (a top-k report).

    The entries of all vectors are range-partitioned and sorted, become pieces of text where they
    stand, and the pieces of a vector are joined in their order: the task that does it holds
    the text of one vector, not its entries, each an object many times as large."""
    c = counts
    if top_k is not None:
        # Marker rows (null stem) pass by the ranking, whose plain rank filter limits groups early.
        w = Window.partitionBy("uri").orderBy(F.col("n").desc(), F.col("stem"))
        ranked = c.where(F.col("stem").isNotNull()).withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= top_k)
        c = ranked.drop("_rk").unionByName(c.where(F.col("stem").isNull()))
    order = ["uri", F.col("n").desc(), "stem"]
    ranged = c.where(F.col("stem").isNotNull()).select("uri", "stem", F.col("n").cast("long").alias("n"))
    ranged = ranged.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    pieces = map_arrow(ranged, _pieces, "uri string, part int, piece long, vector string")
    bare = c.where(F.col("stem").isNull()).select("uri", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("piece"), F.lit(None).cast("string").alias("vector"))
    pieces = pieces.unionByName(bare).repartition("uri").sortWithinPartitions("uri", "part", "piece")
    return map_arrow(pieces.select("uri", "vector"), _joined, "uri string, vector string")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (uri, stem, n, part) as pieces of text, numbered, of at most ``CHUNK`` entries of one uri."""
    number = 0
    for batch in batches:
        uri = batch.column("uri")
        first = _firsts(pc.dictionary_encode(uri, null_encoding="encode").indices.to_numpy(zero_copy_only=False))
        n = np.diff(np.append(first, batch.num_rows))
        pieces = -(-n // CHUNK)
        at = np.repeat(first, pieces) + _ranges(np.zeros(len(n), np.int64), pieces) * CHUNK
        entries = pc.binary_join_element_wise(batch.column("stem"), batch.column("n").cast(pa.string()), ",")
        text = pc.binary_join(pa.ListArray.from_arrays(np.append(at, batch.num_rows).astype(np.int32), entries), "),(")
        yield pa.RecordBatch.from_arrays([
            uri.take(pa.array(at)), batch.column("part").take(pa.array(at)), pa.array(number + np.arange(len(at), dtype=np.int64)),
            pc.binary_join_element_wise("(", text, ")", "")], names=["uri", "part", "piece", "vector"])
        number += len(at)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(uri, vector) of the pieces of each uri, which come one after the other in their order; a
    null piece only marks a uri."""
    uris: list = []
    texts: list[bytearray] = []

    def batch() -> pa.RecordBatch:
        ends = np.cumsum([0, *map(len, texts)]).astype(np.int32)
        text = texts[0] if len(texts) == 1 else b"".join(texts)
        vectors = pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(text))
        return pa.RecordBatch.from_arrays([pa.array(uris, pa.string()), vectors], names=["uri", "vector"])

    size = 0
    for pieces in batches:
        for uri, text in zip(pieces.column("uri").to_pylist(), pieces.column("vector").cast(pa.binary()).to_pylist()):
            if not texts or uri != uris[-1]:
                if size > TEXT:
                    yield batch()
                    uris, texts, size = [], [], 0
                uris.append(uri)
                texts.append(bytearray())
            if text is not None:
                texts[-1] += b"," + text if texts[-1] else text
                size += len(text)
    if texts:
        yield batch()
    pa.default_memory_pool().release_unused()  # the worker stays for other tasks


def _packed_vectors(packed: DataFrame, several: DataFrame | None, top_k: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """``render_vectors`` of packed rows, those in one part where they stand; then those in
    several parts and the rows (uri, stem, n) of other uris, whose vectors may be large, or None."""
    one = F.when(F.col("packed") != "", F.transform(F.split("packed", " "), lambda e: F.struct(
        (-F.substring_index(e, ",", -1).cast("long")).alias("neg"), F.substring_index(e, ",", 1).alias("stem"))))
    v = F.array_sort(F.coalesce(one, F.array().cast("array<struct<neg: bigint, stem: string>>")))
    if top_k is not None:
        v = F.slice(v, 1, top_k)
    whole = packed.where("parts = 1").select("uri", F.array_join(F.transform(v, lambda x: F.concat(
        F.lit("("), x["stem"], F.lit(","), (-x["neg"]).cast("string"), F.lit(")"))), ",").alias("vector"))
    cut = packed.where("parts > 1").select("uri", "packed")
    rest = []
    if not cut.isEmpty():
        rest.append(_marked(_unpacked(cut, ["uri"]).where(F.col("stem").isNotNull()), cut.select("uri")))
    if several is not None:
        several = sess.materialize(several, "several_counts")  # ranging the rows reads them twice
        if not several.isEmpty():
            rest.append(several)
    return whole, render_vectors(reduce(DataFrame.unionByName, rest), top_k) if rest else None


def vector_chunks(counts: DataFrame, size: int = 1000) -> DataFrame:
    """T5 for vectors of any length: (uri, chunk, vector), where chunk 0, 1, ... hold ``size``
    entries each in the order of ``render_vectors``; joined by commas they are its vector.

    A rank within a uri is a place in one range-partitioned, sorted table minus the uri's
    first place there: a uri that fills many partitions is ranked over all of them, and no
    task holds more than a partition or one chunk.
    """
    order = ["uri", F.col("n").desc(), "stem"]
    ranged = (counts.where(F.col("stem").isNotNull()).repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_part", F.spark_partition_id()).withColumn("_local", F.monotonically_increasing_id()))
    ranged = sess.materialize(ranged, "ranged_counts")
    # one row for each uri and partition it has rows in
    held = ranged.groupBy("uri", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first"))
    before = Window.partitionBy("uri").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("uri", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    ranked = ranged.join(held, ["uri", "_part"]).withColumn("_rank", F.col("_local") + F.col("_shift"))
    entry = F.concat(F.lit("("), F.col("stem"), F.lit(","), F.col("n").cast("string"), F.lit(")"))
    chunks = (ranked.groupBy("uri", F.floor(F.col("_rank") / size).cast("long").alias("chunk"))
              .agg(F.array_sort(F.collect_list(F.struct("_rank", entry.alias("e")))).alias("v")))
    empty = counts.groupBy("uri").agg(F.count("stem").alias("_n")).where("_n = 0")
    return (chunks.select("uri", "chunk", F.array_join(F.col("v.e"), ",").alias("vector"))
            .unionByName(empty.select("uri", F.lit(0).cast("long").alias("chunk"), F.lit("").alias("vector"))))


def context_vector_chunks(uri_paragraphs: DataFrame | KeyedParagraphs, paragraphs: DataFrame, stop_words: DataFrame | None = None,
                          algorithm: str = "s", lang: str = "en", size: int = 1000) -> DataFrame:
    """A8 with T5 in chunks: (uri, chunk, vector)."""
    counts, uris = _counted(uri_paragraphs, paragraphs, stop_words, algorithm, lang, True)
    # written, as ranging the rows reads them twice
    chunks = _each_uri(vector_chunks(sess.materialize(counts, "token_counts"), size), uris)
    return chunks.where(F.col("uri").isNotNull() | (F.col("vector") == ""))  # vectors of no uri have no chunks


def context_vectors(uri_paragraphs: DataFrame | KeyedParagraphs, paragraphs: DataFrame, stop_words: DataFrame | None = None,
                    algorithm: str = "s", lang: str = "en", top_k: int | None = None) -> DataFrame:
    """(uri, vector) per linked uri, each group of uris rendered once."""
    packed, several, uris = _summed(uri_paragraphs, paragraphs, stop_words, algorithm, lang, True)
    whole, large = _packed_vectors(packed, several, top_k)
    out = _each_uri(whole, uris)
    return out if large is None else out.unionByName(_each_uri(sess.materialize(large, "large_vectors"), uris, few=True))
