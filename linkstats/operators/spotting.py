"""Dictionary spotting as a distributed token join (M1) and page-local spots (M2).

A dictionary entry is its sequence of word tokens; it matches wherever the text has
the same words in a row, whatever the separators between them. The reported surface
form is the covered text, so ``substring(text, offset + 1, length(sf)) = sf`` holds.

Plan shape: a text is cut into words with offsets inside its own row, for multi-word
dictionaries with the next pieces beside each word; no text is shuffled. Keys of the next
words join the dictionary by equality: a broadcast hash join when the measured dictionary
size is under the limit, otherwise a shuffled join that AQE splits when one key is hot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkstats import session as sess
from linkstats.functions import text as tx
from linkstats.operators.tokens import text_words


@dataclass
class Dictionary:
    entries: DataFrame      # (key, toks, n, first), one row per distinct token sequence
    lengths: list[int]      # the distinct numbers of words
    size_bytes: int

    @property
    def max_n(self) -> int:
        """Words of the longest entry (0 when there is none)."""
        return max(self.lengths, default=0)

    @property
    def join_side(self) -> DataFrame:
        return sess.checked_broadcast(self.entries, self.size_bytes)


def entry_key(sf):
    """The identity of a dictionary entry: its words joined by one blank."""
    return F.array_join(tx.words(sf), " ")


def build_dictionary(surface_forms: DataFrame, sf_col: str = "sf") -> Dictionary:
    """Distinct token sequences of the surface forms; entries without words are dropped.

    One aggregate measures the table, so the broadcast decision rests on its real size;
    the join recomputes it from the (materialised) link table, which is cheap next to
    the text side.
    """
    toks = tx.words(F.col(sf_col))
    # Words never contain a blank, so the key splits back into the word array exactly.
    d = (surface_forms.where(F.col(sf_col).isNotNull())
         .select(F.array_join(toks, " ").alias("key"))
         .where(F.col("key") != "")
         .distinct()
         .select("key", F.split("key", " ").alias("toks"))
         .select("key", "toks", F.size("toks").alias("n"), F.col("toks")[0].alias("first")))
    row = d.agg(F.collect_set("n").alias("lengths"),
                F.sum(F.octet_length("key") * 2 + F.col("n") * 16 + 64).alias("bytes")).first()
    return Dictionary(d, sorted(row["lengths"]), int(row["bytes"] or 0))


CHUNK_WORDS = 4


def _key(look, n_words: int):
    """The first ``n_words`` words of a look array as a key; null where the text ends before."""
    return F.concat(*[x for i in range(n_words) for x in (F.lit(" "), F.get(look, F.lit(2 * i)))][1:])


def spot(texts: DataFrame, dictionary: Dictionary, id_col: str = "wid", text_col: str = "text",
         chunk_words: int = CHUNK_WORDS, long_text: int | None = None) -> DataFrame:
    """M1: every occurrence of every dictionary entry at every start: (id, sf, offset, key).

    The words of each start are joined with the dictionary by equality of whole keys: one
    key for each length of up to ``chunk_words`` words that the dictionary has. Of longer
    entries only the distinct (first ``chunk_words`` words, length) pairs take part, so a
    start meets a length once, however many entries begin alike; the whole keys of these
    places are then read from their texts and joined with the entries by equality again.
    Rows that share an id, or all columns, are texts of their own.
    """
    d = dictionary.join_side
    if dictionary.max_n <= 1:
        p = text_words(texts, id_col, text_col, long_text=long_text)
        return p.join(d, p["piece"] == d["key"]).select(F.col("id").alias(id_col), F.col("piece").alias("sf"), "offset", "key")

    c = max(1, chunk_words)
    lengths = sorted({min(n, c) for n in dictionary.lengths})
    # A text is known by its id and content: equal rows have equal places, each row its own.
    keyed = texts.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    keep = ()
    if dictionary.max_n > c:
        keyed, keep = keyed.withColumn("_text", F.sha2(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(" "), "text"), 256)), ("_text",)
    p = text_words(keyed, "id", "text", look_words=lengths[-1], keep=keep, long_text=long_text)
    keys = F.array(*[_key(F.col("look"), n) for n in lengths])
    p = p.select("id", *keep, "pos", "offset", "look", F.explode(keys).alias("prefix")).where(F.col("prefix").isNotNull())
    sides = dictionary.entries.select(
        F.array_join(F.slice("toks", 1, c), " ").alias("prefix"), "n", F.when(F.col("n") <= c, F.col("key")).alias("key")).distinct()
    m = p.join(sess.checked_broadcast(sides), "prefix")  # measured itself: the entries are several times as large
    covered = F.array_join(F.slice("look", 1, F.col("n") * 2 - 1), "")
    short = F.col("n") <= c
    if dictionary.max_n <= c:
        return m.select(F.col("id").alias(id_col), covered.alias("sf"), "offset", "key")

    m = sess.materialize(m.select("id", "_text", "pos", "offset", "n", "key", F.when(short, covered).alias("sf")), "spot_prefixes")
    # The places of one text in one row: as many as it has words times lengths, at most.
    far = m.where(~short).select("_text", "pos", "offset", "n").distinct()
    places = far.groupBy("_text").agg(F.collect_list(F.struct("pos", "offset", "n")).alias("at"))
    hit = keyed.where(F.col("text").isNotNull()).join(sess.checked_broadcast(places, _places_bytes(far)), "_text")

    def whole(ps):
        return F.transform("at", lambda x: F.struct(
            x["offset"].alias("offset"), x["n"].alias("n"), F.slice(ps, (x["pos"] + 1).cast("int"), x["n"] * 2 - 1).alias("part")))

    # ``ps`` is bound by a lambda, so a text is split once and not once for each place.
    found = hit.select("id", F.inline(F.flatten(F.transform(F.array(tx.pieces(F.col("text"))), whole))))
    found = found.where(F.size("part") == F.col("n") * 2 - 1)  # fewer where the text ends before
    found = found.select("id", "offset", F.array_join("part", "").alias("sf"),
                         F.array_join(F.filter("part", lambda x, i: i % 2 == 0), " ").alias("whole"))
    found = found.join(d, F.col("whole") == d["key"]).select(F.col("id").alias(id_col), "sf", "offset", "key")
    return m.where(short).select(F.col("id").alias(id_col), "sf", "offset", "key").unionByName(found)


def _places_bytes(places: DataFrame) -> int:
    return places.count() * 160


# Code points of a stretch of text within which spans meet by equality.
STRETCH = 256


def _stretches(start, end, stretch: int):
    """The stretches that a span touches; an empty span touches the one it stands in."""
    return F.sequence(F.floor(start / stretch), F.floor(F.greatest(start, end - 1) / stretch))


def with_link_spans(spots: DataFrame, links: DataFrame, overlaps: bool = True, id_col: str = "wid", stretch: int = STRETCH) -> DataFrame:
    """M1 with ``include_links``: (id, sf, offset, origin) of the dictionary's spots and of
    the page's own link spans (wid, sf, start, end), each place once. ``origin`` is ``link``,
    ``text`` or ``both``. Zero spans and links without text are no occurrences.

    With ``overlaps=False`` the page's own links win: spots that share a character with a link
    span without being it are left out. Spans meet by (page, stretch of text), so a page with
    many links is many keys.
    """
    spans = (links.where(F.col("sf").isNotNull() & (F.col("end") > F.col("start")))
             .select(F.col("wid").alias(id_col), "sf", F.col("start").alias("offset"), "end"))
    found = spots.select(id_col, "sf", "offset").withColumn("_link", F.lit(0))
    if not overlaps:
        a = found.withColumn("_end", F.col("offset") + F.length("sf"))
        b = (spans.select(F.col(id_col).alias("_id"), F.col("offset").alias("_from"), F.col("end").alias("_to")).distinct()
             .withColumn("_at", F.explode(_stretches(F.col("_from"), F.col("_to"), stretch))))
        hit = a.withColumn("_at", F.explode(_stretches(F.col("offset"), F.col("_end"), stretch)))
        crossed = hit.join(b, (F.col(id_col) == F.col("_id")) & (hit["_at"] == b["_at"]) & (F.col("offset") < F.col("_to"))
                           & (F.col("_from") < F.col("_end")) & ~((F.col("offset") == F.col("_from")) & (F.col("_end") == F.col("_to"))))
        found = found.join(crossed.select(id_col, "sf", "offset").distinct(), [id_col, "sf", "offset"], "left_anti")
    both = found.unionByName(spans.select(id_col, "sf", "offset", F.lit(1).alias("_link")))
    kinds = both.groupBy(id_col, "sf", "offset").agg(F.min("_link").alias("_low"), F.max("_link").alias("_high"))
    origin = F.when(F.col("_low") == 1, "link").when(F.col("_high") == 0, "text").otherwise("both")
    return kinds.select(id_col, "sf", "offset", origin.alias("origin"))


def spot_surface_forms(texts: DataFrame, surface_forms: DataFrame, id_col: str = "wid",
                       text_col: str = "text", sf_col: str = "sf") -> DataFrame:
    """M1 with the dictionary built from ``surface_forms``: (id, sf, offset)."""
    d = build_dictionary(surface_forms, sf_col)
    return spot(texts, d, id_col, text_col).select(id_col, "sf", "offset")


# Spots of a cluster that one task may choose from one after the other.
CLUSTER = 10_000


def leftmost_longest(spots: DataFrame, id_col: str = "wid", stretch: int = 1 << 14, cluster: int = CLUSTER) -> DataFrame:
    """Non-overlapping spots, chosen greedily left to right, the longest at each start.

    A spot that starts at or after the end of every earlier spot opens a new cluster and is
    always chosen, so the choice is made cluster by cluster. What lies before a spot is known
    by a maximum over the stretches of its page (a row each) and one within its stretch: a
    page is many keys. A cluster of more than ``cluster`` spots is chosen from by pointer
    jumping (``_by_jumping``), with the same result.
    """
    s = spots.withColumn("end", F.col("offset") + F.length("sf"))
    cols = [c for c in s.columns if c not in (id_col, "offset")]
    longest = (s.groupBy(id_col, "offset").agg(F.max_by(F.struct(*cols), F.col("end")).alias("s"))
               .select(id_col, "offset", "s.*").withColumn("_at", F.floor(F.col("offset") / stretch)))
    longest = sess.materialize(longest, "longest_spots")

    def carried(df, value):
        """The greatest value of the page's stretches before each one."""
        w = Window.partitionBy(id_col).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        sums = df.groupBy(id_col, "_at").agg(F.max(value).alias("_v"))
        return sums.select(F.col(id_col).alias("_id"), F.col("_at").alias("_stretch"), F.max("_v").over(w).alias("_before"))

    def join(df, sums):
        return df.join(sums, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_at") == F.col("_stretch"))).drop("_id", "_stretch")

    w = Window.partitionBy(id_col, "_at").orderBy("offset")
    earlier = F.greatest("_before", F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    flagged = join(longest, carried(longest, F.col("end"))).withColumn("_reach", earlier).drop("_before")
    opens = F.when(F.col("_reach").isNull() | (F.col("offset") >= F.col("_reach")), F.col("offset"))
    flagged = sess.materialize(flagged.withColumn("_opens", opens), "flagged_spots")
    opened = F.greatest("_before", F.max("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    flagged = join(flagged, carried(flagged, F.col("_opens"))).withColumn("_cluster", opened).drop("_before", "_opens", "_reach")
    sizes = flagged.groupBy(id_col, "_cluster").agg(F.count(F.lit(1)).alias("_n"))
    long = sess.materialize(sizes.where(F.col("_n") > cluster), "long_clusters")
    some_long = not long.isEmpty()
    inside = flagged
    if some_long:
        same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_cluster") == F.col("_c"))
        keys = long.select(F.col(id_col).alias("_id"), F.col("_cluster").alias("_c"))
        flagged = sess.materialize(flagged, "clustered_spots")
        inside = flagged.join(keys, same, "left_anti")
    members = [c for c in flagged.columns if c not in (id_col, "_cluster", "_at")]
    grouped = (inside.groupBy(id_col, "_cluster")
               .agg(F.array_sort(F.collect_list(F.struct(*members))).alias("c")))
    elem_type = grouped.schema["c"].dataType
    empty = F.array().cast(elem_type)

    def step(acc, x):
        return F.when(x["offset"] >= acc["last"],
                      F.struct(F.concat(acc["sel"], F.array(x)).alias("sel"), x["end"].alias("last"))
                      ).otherwise(acc)

    chosen = F.aggregate("c", F.struct(empty.alias("sel"), F.lit(-1).cast("long").alias("last")),
                         step, lambda acc: acc["sel"])
    out = grouped.select(id_col, F.explode(chosen).alias("x")).select(id_col, "x.*").select(*spots.columns)
    if some_long:
        rest = flagged.join(keys, same, "left_semi")
        out = out.unionByName(_by_jumping(rest, id_col).select(*spots.columns))
    return out


def _by_jumping(spots: DataFrame, id_col: str) -> DataFrame:
    """The greedy choice in long clusters (id, _cluster, offset, end, _at): every spot points
    to the first one that starts at or after its end, in its own stretch or at the beginning
    of a later one; from the first spots on, the chain is followed by doubling the pointers,
    so its length costs rounds only by its logarithm. Every round is a written table."""
    key = [id_col, "_cluster"]
    stretch = 1 << 10
    s = spots.withColumn("_k", F.floor(F.col("offset") / stretch))
    points = s.select(*key, "_k", F.col("offset").alias("at"), F.col("offset").alias("start")).unionByName(
        s.select(*key, F.floor(F.col("end") / stretch).alias("_k"), F.col("end").alias("at"), F.lit(None).cast("long").alias("start")))
    ahead = Window.partitionBy(*key, "_k").orderBy("at").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    later = Window.partitionBy(*key).orderBy("_k").rowsBetween(1, Window.unboundedFollowing)
    first = points.groupBy(*key, "_k").agg(F.min("start").alias("_first"))
    first = first.select(*key, "_k", F.min("_first").over(later).alias("_later"))
    here = points.withColumn("_here", F.min("start").over(ahead)).where("start IS NULL").select(*key, "_k", "at", "_here").distinct()

    def on(a, b, columns):
        cond = F.lit(True)
        for x, y in columns:
            cond = cond & a[x].eqNullSafe(b[y])
        return cond

    f = first.toDF("_i1", "_c1", "_k1", "_later")
    ends = here.join(f, on(here, f, [(id_col, "_i1"), ("_cluster", "_c1"), ("_k", "_k1")]))
    ends = ends.select(F.col(id_col).alias("_i"), F.col("_cluster").alias("_c"), F.col("at").alias("_e"), F.coalesce("_here", "_later").alias("to"))
    jump = s.join(ends, on(s, ends, [(id_col, "_i"), ("_cluster", "_c"), ("end", "_e")])).select(*key, "offset", "to")
    jump = sess.materialize(jump.where(F.col("to").isNotNull()), "spot_jumps")
    reached = sess.materialize(s.where(F.col("offset") == F.col("_cluster")).select(*key, "offset"), "spots_reached")
    n = reached.count()
    while True:
        r = reached.toDF("_i", "_c", "_o")
        step = jump.join(r, on(jump, r, [(id_col, "_i"), ("_cluster", "_c"), ("offset", "_o")])).select(*key, F.col("to").alias("offset"))
        reached = sess.materialize(reached.unionByName(step).distinct(), "spots_reached")
        now = reached.count()
        if now == n:
            break
        n = now
        b = jump.toDF("_i", "_c", "_o", "_to")
        jump = sess.materialize(jump.join(b, on(jump, b, [(id_col, "_i"), ("_cluster", "_c"), ("to", "_o")]))
                                .select(*key, "offset", F.col("_to").alias("to")), "spot_jumps")
    r = reached.toDF("_i", "_c", "_o")
    return s.join(r, on(s, r, [(id_col, "_i"), ("_cluster", "_c"), ("offset", "_o")]), "left_semi").drop("_k")


def page_sf_map(page_links: DataFrame) -> DataFrame:
    """(wid, sf, uri): a page's own anchors; a repeated anchor keeps its last link."""
    return page_links.groupBy("wid", "sf").agg(F.max_by("uri", "pos").alias("uri"))


def spot_linked(texts: DataFrame, page_links: DataFrame, id_col: str = "wid", text_col: str = "text") -> DataFrame:
    """M2: non-overlapping spots that are anchors of the same page, with the page's link
    target: (wid, sf, offset, uri).

    Words meet the anchors of their own page only, by equality of (page, covered text); a
    stretch of words is built where it begins like one of the page's anchors, and as long.
    Anchors that begin or end with a separator cover no stretch of words and never match.
    """
    anchors = page_sf_map(page_links).withColumnRenamed("wid", id_col).where(F.col("sf").isNotNull())
    anchors = anchors.withColumn("_toks", tx.words(F.col("sf"))).where(F.size("_toks") > 0)
    shapes = anchors.select(id_col, F.struct(F.col("_toks")[0].alias("first"), F.size("_toks").alias("n")).alias("shape"))
    shapes = shapes.groupBy(id_col).agg(F.collect_set("shape").alias("_shapes"))
    several = not anchors.where(F.size("_toks") > 1).isEmpty()
    t = texts.select(id_col, F.col(text_col).alias("_text")).where(F.length("_text") > 0).join(sess.checked_broadcast(shapes), id_col)
    if several:
        # a page's words meet the shapes (first word, number of words) of its own anchors only
        t = t.select(id_col, "_shapes", tx.starts_with_word(F.col("_text")).alias("_w"), tx.pieces(F.col("_text")).alias("ps"))
        t = t.withColumn("at", tx.starts(F.col("ps")))

        def at_word(i):
            fits = F.filter("_shapes", lambda x: (x["first"] == F.get("ps", i)) & (i + x["n"] * 2 - 1 <= F.size("ps")))
            return F.transform(fits, lambda x: F.struct(F.get("at", i).alias("offset"), F.array_join(
                F.slice("ps", i + 1, x["n"] * 2 - 1), "").alias("sf")))
        first = F.when(F.col("_w"), 0).otherwise(1)
        words = F.when(F.size("ps") > first, F.sequence(first, F.size("ps") - 1, F.lit(2)))
        p = t.select(id_col, F.inline(F.flatten(F.transform(words, at_word))))
    else:
        firsts = F.transform("_shapes", lambda x: x["first"])
        p = text_words(t.withColumn("_firsts", firsts), id_col, "_text", keep=("_firsts",)).where(F.array_contains("_firsts", F.col("piece")))
        p = p.select(F.col("id").alias(id_col), "offset", F.col("piece").alias("sf"))
    linked = p.join(sess.checked_broadcast(anchors.select(id_col, "sf", "uri")), [id_col, "sf"])
    if several:
        linked = leftmost_longest(linked, id_col)
    return linked.select(id_col, "sf", "offset", "uri")
