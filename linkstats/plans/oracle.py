"""DuckDB SQL for every registered query (the driver's correctness oracle).

The adapter relations of ``linkstats/sources/pages.py`` are re-stated here as CTEs with
the same patterns (RE2 reads them like Java regex). Sums are cast to BIGINT (DuckDB
widens them to HUGEINT).
"""

from __future__ import annotations

from linkstats.plans import oracle_stems as stems

# ---- shared fragments ---------------------------------------------------------------

W = r"[\p{L}\p{N}]+"
PIECES = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"


def decode(x: str) -> str:
    return (f"replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), "
            f"'&quot;', '\"'), '&#39;', ''''), '&amp;', '&')")


def clean(x: str) -> str:
    return f"trim(regexp_replace({decode(f'regexp_replace({x}, {chr(39)}<[^>]*>{chr(39)}, {chr(39)} {chr(39)}, {chr(39)}g{chr(39)})')}, '[ \\t\\r\\n]+', ' ', 'g'))"


def s_stem(t: str) -> str:
    return (f"CASE WHEN {t} LIKE '%ies' AND {t} NOT LIKE '%eies' AND {t} NOT LIKE '%aies' "
            f"THEN substr({t}, 1, length({t}) - 3) || 'y' "
            f"WHEN {t} LIKE '%es' AND {t} NOT LIKE '%aes' AND {t} NOT LIKE '%ees' AND {t} NOT LIKE '%oes' "
            f"THEN substr({t}, 1, length({t}) - 1) "
            f"WHEN {t} LIKE '%s' AND {t} NOT LIKE '%us' AND {t} NOT LIKE '%ss' "
            f"THEN substr({t}, 1, length({t}) - 1) ELSE {t} END")


WIKI = "http://en.wikipedia.org/wiki/"
RES = "http://en.kb.example.org/resource/"
RES_NO_LANG = "http://kb.example.org/resource/"


def bare_id(x: str) -> str:
    s = f"replace(replace(replace({x}, '{WIKI}', ''), '{RES}', ''), '{RES_NO_LANG}', '')"
    dec = (f"CASE WHEN regexp_matches({s}, '%[0-9A-Fa-f]{{2}}') AND NOT regexp_matches({s}, "
           f"'%([^0-9A-Fa-f]|[0-9A-Fa-f][^0-9A-Fa-f]|[0-9A-Fa-f]?$)') THEN url_decode({s}) ELSE {s} END")
    return f"regexp_replace(regexp_replace({dec}, '[ _]+', '_', 'g'), '^_+|_+$', '', 'g')"


def wiki_url(x: str) -> str:
    return f"('{WIKI}' || {bare_id(x)})"


def resource_uri(x: str) -> str:
    return f"('{RES}' || {bare_id(x)})"


STOP_WORDS = ["the", "and", "of", "to", "a", "in", "is", "it", "that", "for", "on", "with", "as", "by",
              "der", "die", "das", "und", "ein", "eine",
              "de", "la", "le", "les", "des", "et", "un", "une",
              "que", "el", "los", "las", "y", "en"]

# The page text with the text of every anchor between two noncharacters.
MARKED = clean("""regexp_replace(body, '<a href="/([^"]*)">([^<]*)</a>',
    '<a href="/\\1">' || chr(64976) || '\\2' || chr(64977) || '</a>', 'g')""")
for _a, _b in [("chr(64976) || ' '", "chr(64976)"), ("' ' || chr(64977)", "chr(64977)"),
               ("chr(64976) || chr(64977) || ' '", "chr(64976) || chr(64977)")]:
    MARKED = f"replace({MARKED}, {_a}, {_b})"

# ---- adapter CTEs (name -> (dependencies, body)) -------------------------------------

CTES: dict[str, tuple[list[str], str]] = {
    "bodies": ([], r"""SELECT page_id AS wid, url,
        regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '', 'g'),
                       '(?is)<style[^>]*>.*?</style>', '', 'g') AS body FROM pages"""),
    "v_articles": (["bodies"], f"""SELECT wid, {clean('body')} AS text,
        {clean("regexp_extract(body, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} AS h1 FROM bodies"""),
    "texts": (["v_articles"], "SELECT wid, text FROM v_articles WHERE length(text) > 0"),
    "link_arrays": (["bodies"], f"""SELECT wid,
        regexp_extract_all(body, '<a href="/([^"]*)">([^<]*)</a>', 1) AS u,
        regexp_extract_all(body, '<a href="/([^"]*)">([^<]*)</a>', 2) AS s,
        string_split({MARKED}, chr(64976)) AS parts FROM bodies"""),
    "v_links": (["link_arrays"], f"""SELECT wid, pos, uri, {decode('raw_sf')} AS sf, start,
        (start + length(string_split(parts[pos + 2], chr(64977))[1]))::BIGINT AS "end"
        FROM (SELECT *, list_sum([length(replace(x, chr(64977), '')) for x in parts[1:pos + 1]])::BIGINT AS start FROM (
              SELECT wid, parts, (generate_subscripts(u, 1) - 1)::BIGINT AS pos, unnest(u) AS uri, unnest(s) AS raw_sf
              FROM link_arrays))"""),
    "link_facts": (["v_links"], """SELECT wid, sf, uri FROM v_links WHERE NOT (start = 0 AND "end" = 0)"""),
    "redirect_e1": (["v_links"], r"""SELECT uri AS src,
        CASE WHEN regexp_matches(uri, '[^\p{L}\p{N}]') THEN regexp_replace(uri, '[^\p{L}\p{N}]', '', 'g')
             ELSE lower(uri) END AS dst FROM (SELECT DISTINCT uri FROM v_links)"""),
    "v_redirects": (["redirect_e1"], """SELECT DISTINCT src, dst FROM (
        SELECT src, dst FROM redirect_e1 UNION ALL SELECT dst AS src, lower(dst) AS dst FROM redirect_e1)
        WHERE src <> dst AND dst <> ''"""),
    "v_cyclic": ([], """SELECT CAST(p_partkey AS VARCHAR) AS src,
        CAST((p_partkey * p_partkey + 1) % 1000 AS VARCHAR) AS dst FROM part"""),
    "v_titles": (["v_articles", "bodies"], r"""SELECT regexp_replace(b.url, '[?#].*$', '') AS uri, a.h1 AS sf
        FROM v_articles a JOIN bodies b USING (wid) WHERE regexp_matches(a.h1, '[\p{L}\p{N}]')"""),
    "v_paragraphs": (["bodies"], f"""SELECT DISTINCT sha256(para) AS para_key, para FROM (
        SELECT {clean('raw')} AS para FROM (
          SELECT unnest(regexp_extract_all(regexp_replace(body, '(?i)<p(\\s[^>]*)?>', '</p><p>', 'g'),
                                           '(?s)<p>(.*?)</p>', 1)) AS raw FROM bodies))
        WHERE para <> ''"""),
    "documents_t": ([], "SELECT doc_id AS wid, text FROM documents WHERE text IS NOT NULL"),
    "redirect_edges_u": (["v_redirects"], "SELECT src, min(dst) AS dst FROM v_redirects GROUP BY src"),
    "cyclic_edges_u": (["v_cyclic"], "SELECT src, min(dst) AS dst FROM v_cyclic GROUP BY src"),
}


def pieces_cte(name: str, texts: str, id_col: str = "wid", text_col: str = "text") -> str:
    return f"""{name} AS (SELECT id, pos, piece,
        (coalesce(sum(length(piece)) OVER (PARTITION BY id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS "offset",
        regexp_matches(piece, '^[\\p{{L}}\\p{{N}}]') AS is_word
        FROM (SELECT id, (generate_subscripts(p, 1) - 1)::BIGINT AS pos, unnest(p) AS piece
              FROM (SELECT {id_col} AS id, regexp_extract_all({text_col}, '{PIECES}') AS p FROM {texts})))"""


def spots_cte(name: str, texts: str, dict_sql: str, id_col: str = "wid", text_col: str = "text") -> str:
    """Spots of the dictionary (column sf of ``dict_sql``): (id, sf, offset, toks). Entries of
    any length: pieces alternate word and separator, so the words of a place are every other
    piece from there."""
    return f"""{name}_d AS (SELECT toks, len(toks) AS n, toks[1] AS first FROM (
        SELECT DISTINCT regexp_extract_all(sf, '{W}') AS toks FROM ({dict_sql}) WHERE sf IS NOT NULL)
        WHERE len(toks) > 0),
    {name}_t AS (SELECT {id_col} AS id, regexp_extract_all({text_col}, '{PIECES}') AS ps,
        regexp_extract_all({text_col}, '{W}') AS ws FROM {texts}),
    {pieces_cte(f"{name}_p", texts, id_col, text_col)},
    {name}_w AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS wpos FROM {name}_p WHERE is_word),
    {name} AS (SELECT w.id, array_to_string(t.ps[w.pos + 1:w.pos + 2 * d.n - 1], '') AS sf, w."offset", d.toks
        FROM {name}_w w JOIN {name}_d d ON w.piece = d.first JOIN {name}_t t ON t.id = w.id
        WHERE t.ws[w.wpos:w.wpos + d.n - 1] = d.toks)"""


def recursive_resolve_cte(name: str, edges: str) -> str:
    """(title, final) by the walk rule of the redirect resolver."""
    return f"""{name}_walk(title, cur, path, final) AS (
        SELECT src, dst, [dst], NULL::VARCHAR FROM {edges}
        UNION ALL
        SELECT w.title, e.dst, list_append(w.path, e.dst),
               CASE WHEN e.dst IS NULL THEN w.cur WHEN list_contains(w.path, e.dst) THEN e.dst END
        FROM {name}_walk w LEFT JOIN {edges} e ON e.src = w.cur
        WHERE w.final IS NULL),
    {name} AS (SELECT title, final FROM {name}_walk WHERE final IS NOT NULL)"""


def with_ctes(needed: list[str], extra: list[str], select: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    parts = [f"{n} AS ({CTES[n][1]})" for n in order] + extra
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select


ANCHOR_SPOTS = spots_cte("anchor_spots", "texts", "SELECT sf FROM v_links")
TITLE_SPOTS = spots_cte("title_spots", "texts", "SELECT sf FROM v_titles")
PARA_SPOTS = spots_cte("para_spots", "v_paragraphs", "SELECT sf FROM v_titles", "para_key", "para")
RESOLVED = recursive_resolve_cte("resolved", "redirect_edges_u")
RESOLVED_CYCLIC = recursive_resolve_cte("resolved_c", "cyclic_edges_u")

UP = f"""up AS (SELECT DISTINCT t.uri, s.id AS para_key FROM para_spots s
        JOIN (SELECT uri, regexp_extract_all(sf, '{W}') AS toks FROM v_titles) t ON s.toks = t.toks)"""
LINKED_PARAGRAPHS = f"""blocks AS (SELECT raw, {clean('raw')} AS para FROM (
          SELECT unnest(regexp_extract_all(regexp_replace(body, '(?i)<p(\\s[^>]*)?>', '</p><p>', 'g'),
                                           '(?s)<p>(.*?)</p>', 1)) AS raw FROM bodies
          UNION ALL SELECT unnest(regexp_extract_all(body, '(?is)<[uo]l[^>]*>(.*?)</[uo]l>', 1)) AS raw FROM bodies)),
    v_paragraphs AS (SELECT DISTINCT sha256(para) AS para_key, para FROM blocks WHERE para <> ''),
    up AS (SELECT DISTINCT uri, sha256(para) AS para_key FROM (
        SELECT para, unnest(regexp_extract_all(raw, '<a href="/([^"]*)">([^<]*)</a>', 1)) AS uri FROM blocks WHERE para <> ''))"""
STOPS = "stops AS (SELECT DISTINCT " + s_stem("lower(w)") + " AS stem FROM (SELECT unnest(regexp_extract_all(x, '" + W + "')) AS w FROM (SELECT unnest([" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]) AS x)))"
PTC = f"""ptc AS (SELECT para_key, stem, count(*) AS n FROM (
        SELECT para_key, {s_stem('lower(w)')} AS stem FROM (
          SELECT para_key, unnest(regexp_extract_all(para, '{W}')) AS w FROM v_paragraphs))
        WHERE stem NOT IN (SELECT stem FROM stops) GROUP BY para_key, stem)"""
TC = f"""tc AS (SELECT u.uri, p.stem, sum(p.n)::BIGINT AS n FROM
        (SELECT DISTINCT {wiki_url('uri')} AS uri, para_key FROM up) u JOIN ptc p USING (para_key)
        GROUP BY u.uri, p.stem)"""
CONTEXT = ["v_paragraphs", "v_titles"]
PARAGRAPH_WORDS = f"SELECT para_key, lower(unnest(regexp_extract_all(para, '{W}'))) AS token FROM v_paragraphs"
STOP_LIST = "SELECT unnest([" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]) AS token"
PORTER = [f"porter_words AS MATERIALIZED ({stems.porter(f'SELECT DISTINCT token FROM ({PARAGRAPH_WORDS}) UNION {STOP_LIST}')})",
          f"""ptc AS (SELECT para_key, stem, count(*) AS n FROM ({PARAGRAPH_WORDS}) JOIN porter_words USING (token)
              WHERE stem NOT IN (SELECT stem FROM porter_words JOIN ({STOP_LIST}) USING (token)) GROUP BY para_key, stem)"""]
COUNTS = f"""k AS (SELECT wid, sf, uri, count(*) AS links FROM link_facts GROUP BY wid, sf, uri),
    n AS (SELECT id AS wid, sf, count(*) AS spots FROM anchor_spots GROUP BY id, sf),
    lsj AS (SELECT k.wid, k.sf, k.uri, k.links, coalesce(n.spots, 0)::BIGINT AS spots,
                   (k.links * coalesce(n.spots, 1))::BIGINT AS weight FROM k LEFT JOIN n USING (wid, sf)),
    wrows AS (SELECT sf, uri, weight FROM lsj UNION ALL SELECT title AS sf, final AS uri, 1 AS weight FROM resolved),
    pairs AS (SELECT sf, uri, sum(weight)::BIGINT AS n FROM wrows WHERE uri IS NOT NULL AND length(uri) > 0 GROUP BY sf, uri)"""
TOTALS = """ann AS (SELECT sf, count(*) AS annotated FROM link_facts WHERE sf IS NOT NULL GROUP BY sf),
    spt AS (SELECT sf, count(*) AS spotted FROM anchor_spots WHERE sf IS NOT NULL GROUP BY sf),
    totals AS (SELECT a.sf, a.annotated, coalesce(s.spotted, 1)::BIGINT AS total FROM ann a LEFT JOIN spt s USING (sf)),
    phantoms AS (SELECT lower(sf) AS sf, -1::BIGINT AS annotated, 1::BIGINT AS total FROM totals WHERE sf <> lower(sf))"""
SFMAP = """sfmap AS (SELECT wid, sf, arg_max(uri, pos) AS uri FROM v_links GROUP BY wid, sf),
    linked AS (SELECT s.id AS wid, s.sf, s."offset", m.uri FROM anchor_spots s JOIN sfmap m ON s.id = m.wid AND s.sf = m.sf)"""
TARGETS = """tgt AS (SELECT d.u, coalesce(ex.final, fo.final, d.u) AS target FROM (SELECT DISTINCT uri AS u FROM {src}) d
        LEFT JOIN resolved ex ON ex.title = d.u
        LEFT JOIN (SELECT lower(title) AS lu, min(final) AS final FROM resolved GROUP BY lower(title)) fo ON fo.lu = lower(d.u))"""


def _q(needed, extra, select):
    return with_ctes(needed, extra, select)


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["article_filter"] = _q(["v_articles", "link_arrays"], [], """SELECT a.wid, a.h1 AS title,
        length(a.text)::BIGINT AS text_chars, len(l.u)::BIGINT AS n_links FROM v_articles a JOIN link_arrays l USING (wid)""")
    q["redirect_edges"] = _q(["v_redirects"], [], "SELECT src, dst FROM v_redirects")
    q["article_text"] = _q(["v_articles", "link_arrays"], [], """SELECT a.wid, length(a.text)::BIGINT AS text_chars,
        len(l.u)::BIGINT AS n_spans FROM v_articles a JOIN link_arrays l USING (wid) WHERE length(a.text) > 0""")
    q["extract_links"] = _q(["v_links"], [], 'SELECT wid, pos, uri, sf, start, "end" FROM v_links')
    q["link_facts"] = _q(["link_facts"], [], "SELECT wid, sf, uri FROM link_facts")
    q["surface_forms"] = _q(["v_links"], [], "SELECT DISTINCT sf FROM v_links WHERE sf IS NOT NULL")
    vocab = f"""vocab AS (SELECT token, row_number() OVER (ORDER BY token)::BIGINT AS token_id, count FROM (
        SELECT token, count(*)::BIGINT AS count FROM (
          SELECT unnest(regexp_extract_all(sf, '{W}')) AS token FROM (SELECT DISTINCT sf FROM v_links WHERE sf IS NOT NULL))
        GROUP BY token))"""
    q["sf_vocabulary"] = _q(["v_links"], [vocab], "SELECT token, token_id, count FROM vocab")
    q["vocab_stats"] = _q(["v_links"], [vocab], """SELECT count(*)::BIGINT AS vocab_size,
        coalesce(sum(count), 0)::BIGINT AS total_count, coalesce(max(token_id), 0)::BIGINT AS max_token_id FROM vocab""")
    q["token_lookup"] = _q(["texts", "v_links"], [vocab, pieces_cte("tp", "texts")], """SELECT p.id AS wid,
        count(*)::BIGINT AS n_tokens, sum(CASE WHEN v.token_id IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_unknown
        FROM tp p LEFT JOIN vocab v ON v.token = p.piece WHERE p.is_word GROUP BY p.id""")
    words_of = lambda src: f"""SELECT w AS token, count(*) AS count FROM (SELECT unnest(regexp_extract_all(sf, '{W}')) AS w
        FROM (SELECT DISTINCT sf FROM {src} WHERE sf IS NOT NULL)) GROUP BY w"""
    q["vocab_reverse_lookup"] = _q(["v_links", "v_titles"], [
        f"old AS (SELECT *, row_number() OVER (ORDER BY token) AS id FROM ({words_of('v_titles')}))", f"more AS ({words_of('v_links')})",
        """store AS (SELECT o.token, o.id, o.count + coalesce(m.count, 0) AS count FROM old o LEFT JOIN more m USING (token)
            UNION ALL SELECT token, (SELECT max(id) FROM old) + row_number() OVER (ORDER BY token), count FROM more
            WHERE token NOT IN (SELECT token FROM old))"""],
        """SELECT p_partkey::BIGINT AS token_id, coalesce(token, '<UNKNOWN>') AS token, coalesce(count, 0)::BIGINT AS vocab_count
        FROM part LEFT JOIN store ON id = p_partkey""")
    q["strip_markup"] = _q(["v_articles"], [], "SELECT wid, text, h1 FROM v_articles")
    q["tokenize_offsets"] = _q(["documents_t"], [pieces_cte("dp", "documents_t")], """SELECT id AS wid,
        (row_number() OVER (PARTITION BY id ORDER BY pos) - 1)::BIGINT AS tpos, piece AS token, "offset"
        FROM dp WHERE is_word""")
    q["spot_single"] = _q(["documents_t", "v_links"], [spots_cte("ds", "documents_t", "SELECT sf FROM v_links")],
                          'SELECT id AS wid, sf, "offset" FROM ds')
    q["spot_multi"] = _q(["texts", "v_titles"], [TITLE_SPOTS], 'SELECT id AS wid, sf, "offset" FROM title_spots')
    q["spot_linked"] = _q(["texts", "v_links"], [ANCHOR_SPOTS, SFMAP], 'SELECT wid, sf, "offset", uri FROM linked')

    q["tokenize_long_texts"] = q["tokenize_offsets"]
    q["spot_long_texts"] = q["spot_multi"]
    own = """own AS (SELECT DISTINCT wid, sf, start AS "offset", "end" FROM v_links WHERE sf IS NOT NULL AND "end" > start),
        text_spots AS (SELECT DISTINCT id AS wid, sf, "offset" FROM anchor_spots)"""
    origins = """SELECT coalesce(o.wid, s.wid) AS wid, coalesce(o.sf, s.sf) AS sf, coalesce(o."offset", s."offset") AS "offset",
        CASE WHEN s.wid IS NULL THEN 'link' WHEN o.wid IS NULL THEN 'text' ELSE 'both' END AS origin
        FROM {spots} s FULL JOIN (SELECT DISTINCT wid, sf, "offset" FROM own) o ON o.wid = s.wid AND o.sf = s.sf AND o."offset" = s."offset" """
    q["spot_with_links"] = _q(["texts", "v_links"], [ANCHOR_SPOTS, own], origins.format(spots="text_spots"))
    q["spot_beside_links"] = _q(["texts", "v_links"], [ANCHOR_SPOTS, own, """beside AS (SELECT * FROM text_spots s WHERE NOT EXISTS (
        SELECT 1 FROM own o WHERE o.wid = s.wid AND s."offset" < o."end" AND o.start_ < s."offset" + length(s.sf)
        AND NOT (o.start_ = s."offset" AND o."end" = s."offset" + length(s.sf))))""".replace("o.start_", 'o."offset"')],
                                origins.format(spots="beside"))
    q["spot_headings_apart"] = _q(["texts", "v_titles"], [TITLE_SPOTS, """starts AS (SELECT id, "offset", max_by(sf, length(sf)) AS sf,
        row_number() OVER (PARTITION BY id ORDER BY "offset") AS k FROM title_spots GROUP BY id, "offset"),
        walk(id, k, sf, "offset", chosen, last) AS (
          SELECT id, k, sf, "offset", true, "offset" + length(sf) FROM starts WHERE k = 1
          UNION ALL SELECT s.id, s.k, s.sf, s."offset", s."offset" >= w.last,
                 CASE WHEN s."offset" >= w.last THEN s."offset" + length(s.sf) ELSE w.last END
          FROM walk w JOIN starts s ON s.id = w.id AND s.k = w.k + 1)"""],
                                  'SELECT id AS wid, sf, "offset" FROM walk WHERE chosen')

    base_counts = ["link_facts", "texts", "v_links", "redirect_edges_u"]
    q["link_spot_join"] = _q(base_counts, [ANCHOR_SPOTS, RESOLVED, COUNTS],
                             "SELECT wid, sf, uri, links, spots, weight FROM lsj")
    q["pair_link_counts"] = _q(["link_facts"], [], """SELECT sf, uri, count(*)::BIGINT AS n FROM link_facts
        WHERE uri IS NOT NULL AND length(uri) > 0 GROUP BY sf, uri""")
    q["stream_pair_link_counts"] = q["pair_link_counts"]
    q["uri_link_counts"] = _q(["link_facts"], [], """SELECT uri, count(*)::BIGINT AS n FROM link_facts
        WHERE uri IS NOT NULL AND length(uri) > 0 GROUP BY uri""")
    q["pair_counts"] = _q(base_counts, [ANCHOR_SPOTS, RESOLVED, COUNTS], "SELECT sf, uri, n FROM pairs")
    q["uri_counts"] = _q(base_counts, [ANCHOR_SPOTS, RESOLVED, COUNTS],
                         "SELECT uri, sum(n)::BIGINT AS n FROM pairs GROUP BY uri")
    q["sf_annotated_counts"] = _q(["link_facts"], [], """SELECT sf, count(*)::BIGINT AS annotated FROM link_facts
        WHERE sf IS NOT NULL GROUP BY sf""")
    q["sf_spotted_counts"] = _q(["texts", "v_links"], [ANCHOR_SPOTS], """SELECT sf, count(*)::BIGINT AS spotted
        FROM anchor_spots GROUP BY sf""")
    q["total_sf_counts"] = _q(["link_facts", "texts"], [ANCHOR_SPOTS, TOTALS], """SELECT sf, annotated, total FROM totals
        UNION ALL SELECT sf, annotated, total FROM phantoms""")
    q["lowercase_phantoms"] = _q(["link_facts", "texts"], [ANCHOR_SPOTS, TOTALS],
                                 "SELECT sf, annotated, total FROM phantoms")

    q["resolve_redirects"] = _q(["redirect_edges_u"], [RESOLVED], "SELECT final, title FROM resolved")
    q["resolved_redirect_map"] = _q(["redirect_edges_u"], [RESOLVED], "SELECT title, final FROM resolved")
    q["resolve_link_targets"] = _q(["link_facts", "redirect_edges_u"], [RESOLVED, TARGETS.format(src="link_facts")],
                                   "SELECT l.wid, l.sf, l.uri, t.target FROM link_facts l LEFT JOIN tgt t ON t.u = l.uri")
    q["resolve_redirects_cyclic"] = _q(["cyclic_edges_u"], [RESOLVED_CYCLIC], "SELECT final, title FROM resolved_c")
    q["resolve_redirects_doubling"] = q["resolve_redirects_cyclic"]

    q["uri_paragraphs"] = _q(CONTEXT, [PARA_SPOTS, UP], "SELECT uri, para_key FROM up")
    q["stem_vocabulary"] = _q(["v_paragraphs"], [], f"""SELECT token, {s_stem('token')} AS stem FROM (
        SELECT DISTINCT lower(w) AS token FROM (SELECT unnest(regexp_extract_all(para, '{W}')) AS w FROM v_paragraphs))""")
    q["token_counts"] = _q(CONTEXT, [PARA_SPOTS, UP, STOPS, PTC, TC], "SELECT uri, stem, n FROM tc")
    vec = lambda k: f"""SELECT u.uri, coalesce(v.vector, '') AS vector FROM (SELECT DISTINCT {wiki_url('uri')} AS uri FROM up) u
        LEFT JOIN (SELECT uri, string_agg('(' || stem || ',' || CAST(n AS VARCHAR) || ')', ',' ORDER BY n DESC, stem) AS vector
                   FROM (SELECT uri, stem, n, row_number() OVER (PARTITION BY uri ORDER BY n DESC, stem) AS rk FROM tc)
                   WHERE rk <= {k} GROUP BY uri) v USING (uri)"""
    q["context_vectors"] = _q(CONTEXT, [PARA_SPOTS, UP, STOPS, PTC, TC], vec(10 ** 12))
    q["context_vectors_topk"] = _q(CONTEXT, [PARA_SPOTS, UP, STOPS, PTC, TC], vec(10))

    q["stem_vocabulary_porter"] = _q(["v_paragraphs"], [], stems.porter(f"SELECT DISTINCT token FROM ({PARAGRAPH_WORDS})"))
    q["context_vectors_porter"] = _q(CONTEXT, [PARA_SPOTS, UP, *PORTER, TC], vec(10 ** 12))
    q["stats_job_token_counts_porter"] = _q(["bodies"], [LINKED_PARAGRAPHS, *PORTER, TC], vec(10 ** 12))
    words_in = lambda lang: f"""SELECT DISTINCT lower(unnest(regexp_extract_all(text, '{W}'))) AS token FROM documents
        WHERE lang IS NOT DISTINCT FROM {lang}"""
    q["stem_vocabulary_by_language"] = " UNION ALL ".join(
        [f"SELECT 'en' AS lang, token, stem FROM ({stems.porter(words_in(repr('en')))})"]
        + [f"SELECT '{code}' AS lang, token, stem FROM ({stems.snowball(name, words_in(repr(code)))})"
           for code, name in (("de", "german"), ("fr", "french"), ("es", "spanish"))]
        + [f"""SELECT DISTINCT lang, lower(w) AS token, lower(w) AS stem FROM (
            SELECT lang, unnest(regexp_extract_all(text, '{W}')) AS w FROM documents WHERE lang NOT IN ('en', 'de', 'fr', 'es') OR lang IS NULL)"""])

    q["stop_list_file_vectors"] = q["context_vectors"]
    q["context_vector_chunks"] = _q(CONTEXT, [PARA_SPOTS, UP, STOPS, PTC, TC], f"""
        SELECT uri, chunk, string_agg('(' || stem || ',' || CAST(n AS VARCHAR) || ')', ',' ORDER BY rk) AS vector FROM (
          SELECT *, (rk - 1) // 25 AS chunk FROM (SELECT uri, stem, n, row_number() OVER (PARTITION BY uri ORDER BY n DESC, stem) AS rk FROM tc))
        GROUP BY uri, chunk
        UNION ALL SELECT uri, 0, '' FROM (SELECT DISTINCT {wiki_url('uri')} AS uri FROM up) WHERE uri NOT IN (SELECT uri FROM tc)""")

    q["article_uri_paragraphs"] = _q(["bodies"], [LINKED_PARAGRAPHS], "SELECT uri, para_key FROM up")
    q["stats_job_token_counts"] = _q(["bodies"], [LINKED_PARAGRAPHS, STOPS, PTC, TC], vec(10 ** 12))

    q["rewrite_text"] = _q(["texts", "v_links", "redirect_edges_u"],
                           [ANCHOR_SPOTS, SFMAP, RESOLVED, TARGETS.format(src="linked"),
                            f"""repl AS (SELECT l.wid, l."offset", ' ' || {resource_uri('t.target')} || ' ' AS r
                                FROM linked l JOIN tgt t ON t.u = l.uri)""",
                            pieces_cte("rp", "texts")],
                           """SELECT p.id AS wid, string_agg(coalesce(r.r, p.piece), '' ORDER BY p.pos) AS text
        FROM rp p LEFT JOIN repl r ON r.wid = p.id AND r."offset" = p."offset" GROUP BY p.id""")
    q["uri_normalize"] = _q(["v_links"], [], f"""SELECT id, {resource_uri('id')} AS resource_uri, {wiki_url('id')} AS wiki_url
        FROM (SELECT url AS id FROM pages UNION SELECT uri AS id FROM v_links)""")
    status = lambda c: (f"CASE WHEN {c} IS NULL THEN 'null' WHEN json_valid({c}) AND ltrim({c}) LIKE '{{%' "
                        f"THEN 'ok' ELSE 'corrupt' END")
    q["quarantine_corrupt"] = f"""SELECT source, status, count(*)::BIGINT AS n FROM (
        SELECT 'events.props' AS source, {status('props')} AS status FROM events
        UNION ALL SELECT 'documents.text' AS source, {status('text')} AS status FROM documents) GROUP BY source, status"""

    q["dq_empty_sf"] = _q(["v_links"], [], """SELECT 'empty_sf' AS "check", count(*)::BIGINT AS n_rows,
        coalesce(sum(CASE WHEN sf = '' THEN 1 ELSE 0 END), 0)::BIGINT AS n_violations
        FROM (SELECT DISTINCT sf FROM v_links WHERE sf IS NOT NULL)""")
    q["dq_redirect_count"] = _q(["v_redirects"], [], """SELECT 'redirect_count' AS "check", count(*)::BIGINT AS n_rows,
        (count(*) - count(DISTINCT src))::BIGINT AS n_violations FROM v_redirects""")
    q["dq_redirect_terminal"] = _q(["redirect_edges_u"], [RESOLVED], """SELECT 'redirect_terminal' AS "check",
        count(*)::BIGINT AS n_rows,
        coalesce(sum(CASE WHEN r.final IN (SELECT src FROM redirect_edges_u) THEN 1 ELSE 0 END), 0)::BIGINT AS n_violations
        FROM resolved r""")
    q["dq_annotated_total"] = _q(["link_facts", "texts"], [ANCHOR_SPOTS, TOTALS], """SELECT 'annotated_total' AS "check",
        (SELECT count(*) FROM link_facts)::BIGINT AS n_rows,
        abs((SELECT coalesce(sum(CASE WHEN annotated = -1 THEN 0 ELSE annotated END), 0) FROM
              (SELECT annotated FROM totals UNION ALL SELECT annotated FROM phantoms))
            - (SELECT count(*) FROM link_facts))::BIGINT AS n_violations""")
    q["dq_spot_offsets"] = _q(["texts", "v_links", "v_titles"], [ANCHOR_SPOTS, TITLE_SPOTS], """SELECT 'spot_offsets' AS "check",
        count(*)::BIGINT AS n_rows,
        coalesce(sum(CASE WHEN substring(t.text, s."offset" + 1, length(s.sf)) <> s.sf THEN 1 ELSE 0 END), 0)::BIGINT AS n_violations
        FROM (SELECT id, sf, "offset" FROM anchor_spots UNION ALL SELECT id, sf, "offset" FROM title_spots) s
        JOIN texts t ON t.wid = s.id""")
    q["quarantined_rows"] = """SELECT line, count(*)::BIGINT AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
        WHERE trim(line, ' ' || chr(9) || chr(13)) <> '' AND NOT (json_valid(line) AND ltrim(line) LIKE '{%') GROUP BY line"""
    wiki = """wiki AS (SELECT a.wid, 'Page ' || a.wid || chr(10) || chr(10) || 'Page' || chr(9) || 'Heading' || chr(10) || a.wid || chr(9) || a.h1 || '.'
        || chr(10) || chr(10) || coalesce(l.items, '') || chr(10) AS text, coalesce(l.n, 0)::BIGINT AS n_links FROM v_articles a LEFT JOIN (
          SELECT wid, string_agg(sf || ' more', chr(10) ORDER BY pos) AS items, count(*) AS n FROM v_links GROUP BY wid) l USING (wid))"""
    q["xml_article_text"] = _q(["v_articles", "v_links"], [wiki], "SELECT wid, text, n_links FROM wiki")
    q["xml_links"] = _q(["v_links"], [], "SELECT wid, pos, sf, uri, sf AS covered FROM v_links")
    q["xml_redirect_edges"] = q["redirect_edges"]
    q["xml_export_link_facts"] = _q(["v_links"], [], "SELECT wid, sf, uri FROM v_links")
    q["xml_job_pair_counts"] = _q(["v_articles", "v_links", "redirect_edges_u"], [
        wiki, "link_facts AS (SELECT wid, sf, uri FROM v_links)", spots_cte("anchor_spots", "wiki", "SELECT sf FROM v_links"), RESOLVED, COUNTS],
        "SELECT sf, uri, n FROM pairs")
    q["annotated_corpus_table"] = q["rewrite_text"]
    q["stats_job_pair_counts"] = q["pair_counts"]
    q["stats_job_uri_counts"] = q["uri_counts"]
    q["stats_job_total_sf_counts"] = q["total_sf_counts"]
    q["annotate_job"] = q["rewrite_text"]
    q["json_export_link_facts"] = q["link_facts"]
    q["json_job_pair_counts"] = q["pair_counts"]
    q["tsv_uri_counts"] = q["uri_link_counts"]
    return q
