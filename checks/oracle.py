"""DuckDB SQL that states each registered query's result on the same tables."""

from __future__ import annotations

from checks.fixture import LISTS, TOPICS
from docwatch.functions.stopwords import ENGLISH
from docwatch.operators.language import PROFILES
from docwatch.operators.summaries import PLACEHOLDERS

W = r"\p{L}\p{N}_"
AS_OF, EARLIER = 1_706_659_200, 1_706_572_800


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values) -> str:
    return "[" + ", ".join(quoted(v) for v in values) + "]"


def strip(x: str) -> str:
    return f"trim({x}, E' \\n\\t\\r')"


def joined(x: str) -> str:
    return f"coalesce(array_to_string({x}, '|'), '')"


def unescape(x: str) -> str:
    for entity, char in (("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"')):
        x = f"replace({x}, '{entity}', '{char}')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def clean(x: str) -> str:
    return strip(f"regexp_replace({unescape(x)}, '\\s+', ' ', 'g')")


def plain_html(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]+>', '', 'g')"


_RAW = r"(?is)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<noscript\b.*?(?:</noscript\s*>|\z)|<!--.*?(?:-->|\z)"
_ASIDE = ["head", "nav", "footer", "aside", "form"]
_BOX = [*_ASIDE, "article", "main", "div", "section", "ul", "ol", "table", "blockquote"]
_BLOCK = [*_BOX, "body", "p", "br", "li", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "pre"]
_NAMED = r"""\b(?:class|id)\s?=\s?("[^"]*"|'[^']*'|[^\s"'>]*)"""
_HIDDEN = (
    r"""(?i)(?:^|[\s"'])(?:ads?|advert|advertisement|breadcrumbs?|comments?|cookie|menu|newsletter|promo"""
    r"""|related|share|sidebar|social)(?:$|[-_\s"'])"""
)


def html_texts(src: str) -> str:
    """CTEs from ``src(k, x)`` to ``read_texts(k, t)``: readable text of markup.

    The open boxes by recursion over a page's box tags, the best run by prefix sums.
    """
    spaced = "regexp_replace(body, '[ \\t\\r\\f]+', ' ', 'g')"
    main = strip(f"regexp_replace({spaced}, ' ?\\n[ \\n]*', chr(10), 'g')")
    solid = "length(regexp_replace(gap, '[ \\t\\n\\r\\f\\v]+', '', 'g'))"
    return f"""marked AS (SELECT k, regexp_replace(x, {quoted(_RAW)}, ' ', 'g') AS q FROM {src}
            WHERE length(x) >= 30 AND contains(x, '<') AND contains(x, '>')),
        cuts AS (SELECT k, regexp_extract_all(q, '<[^>]+>') AS tags, string_split_regex(q, '<[^>]+>') AS gaps FROM marked),
        tags AS (SELECT k, unnest(range(1, len(tags) + 1)) AS i, unnest(tags) AS tag FROM cuts),
        named AS (SELECT k, i, tag, starts_with(tag, '</') AS closing,
            lower(regexp_extract(tag, '^</?([A-Za-z][A-Za-z0-9]*)', 1)) AS name FROM tags),
        kinds AS (SELECT k, i, closing, name, list_contains({listed(_BLOCK)}, name) AS is_block,
            list_contains({listed(_BOX)}, name) OR (name = 'body' AND NOT closing) AS is_box,
            list_contains({listed(_ASIDE)}, name) OR len(list_filter(regexp_extract_all(tag, {quoted('(?i)' + _NAMED)}, 1),
                lambda v: regexp_matches(v, {quoted(_HIDDEN)}))) > 0 AS off FROM named),
        boxes AS (SELECT k, name, closing, off, row_number() OVER (PARTITION BY k ORDER BY i) AS nth FROM kinds WHERE is_box),
        opened AS (SELECT k, 0::BIGINT AS nth, []::VARCHAR[] AS stack FROM marked
            UNION ALL
            SELECT k, b.nth, CASE WHEN name = 'body' THEN []::VARCHAR[]
                WHEN NOT closing THEN list_append(stack, name || CASE WHEN off THEN '!' ELSE '' END)
                WHEN len(hits) = 0 THEN stack ELSE stack[1 : hits[-1] - 1] END
            FROM (SELECT o.k, b.nth, name, closing, off, stack,
                    list_filter(range(1, len(stack) + 1), lambda j: rtrim(stack[j], '!') = name) AS hits
                  FROM opened o JOIN boxes b ON b.k = o.k AND b.nth = o.nth + 1) AS b),
        around AS (SELECT k, nth AS box_no, len(list_filter(stack, lambda s: ends_with(s, '!'))) > 0 AS off,
            len(list_filter(stack, lambda s: s IN ('article', 'main'))) > 0 AS inside FROM opened),
        states AS (SELECT k, i, count(*) FILTER (is_block) OVER w AS block_no, count(*) FILTER (is_box) OVER w AS box_no,
                last_value(CASE WHEN name = 'a' THEN NOT closing
                    WHEN name = 'body' OR list_contains({listed(_BOX)}, name) THEN false END IGNORE NULLS) OVER w AS linked
            FROM kinds WINDOW w AS (PARTITION BY k ORDER BY i)),
        segments AS (SELECT k, unnest(range(0, len(gaps))) AS i, unnest(gaps) AS gap FROM cuts),
        blocks AS (SELECT g.k, coalesce(block_no, 0) AS block_no, coalesce(box_no, 0) AS box_no,
                string_agg(gap, '' ORDER BY i) AS txt, sum({solid}) AS n, sum(CASE WHEN linked THEN {solid} ELSE 0 END) AS n_linked
            FROM segments g LEFT JOIN states USING (k, i) GROUP BY ALL),
        scored AS (SELECT b.k, block_no, off, txt,
                CASE WHEN off OR n = 0 THEN 0 ELSE n - 4 * n_linked - CASE WHEN inside THEN 0 ELSE 20 END END AS s
            FROM blocks b JOIN around USING (k, box_no)),
        sums AS (SELECT *, sum(s) OVER w AS p, sum(s) OVER w - s AS p0 FROM scored
            WINDOW w AS (PARTITION BY k ORDER BY block_no, off ROWS UNBOUNDED PRECEDING)),
        ends AS (SELECT *, min(p0) OVER (PARTITION BY k ORDER BY block_no ROWS UNBOUNDED PRECEDING) AS low FROM sums),
        best AS (SELECT k, max(p - low) AS top, arg_min(block_no, (low - p, block_no)) AS stop,
            arg_min(low, (low - p, block_no)) AS low FROM ends GROUP BY k),
        chosen AS (SELECT e.k, top, stop, min(block_no) AS start FROM ends e JOIN best b ON e.k = b.k AND e.p0 = b.low
            GROUP BY e.k, top, stop),
        bodies_of AS (SELECT s.k, string_agg(txt, chr(10) ORDER BY block_no) AS body FROM scored s JOIN chosen c
            ON s.k = c.k WHERE NOT off AND (top <= 0 OR block_no BETWEEN start AND stop) GROUP BY s.k),
        read_texts AS (SELECT k, CASE WHEN length(x) >= 30 THEN nullif({strip(unescape(
            f"CASE WHEN contains(x, '<') AND contains(x, '>') THEN coalesce(nullif({main}, ''), {plain_html('x')}) ELSE x END"))}, '') END AS t
            FROM {src} LEFT JOIN bodies_of USING (k))"""


ITEMS = """items AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, doc_id, source AS src, url,
         1704067200 + (doc_id * 1601951) % 2592000 AS ts,
         left(split_part(text, chr(10), 1), 80) AS title, text,
         CASE WHEN n_chars >= 500 THEN [lang, source] ELSE [] END AS topics,
         lang AS true_lang, n_chars
  FROM documents LEFT JOIN pages ON page_id = doc_id)"""


def with_items(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join([ITEMS, *ctes]) + "\n" + body


# ---- tagging ----------------------------------------------------------------

RAW = strip("title || chr(10) || text")
MATCH = strip(f"translate(replace(lower({RAW}), 'ß', 'ss'), '—–’‘“”', '--''''\"\"')")
LEET = strip(f"regexp_replace(translate(lower({RAW}), '013457@$', 'oieastas'), '\\s+', ' ', 'g')")


def _hit(term: str) -> str:
    term = term.lower()
    if len(term) >= 6 or any(c in term for c in " -/._"):
        return f"contains(m, {quoted(term)})"
    if term.isalnum():
        return f"regexp_matches(m, '(^|[^{W}]){term}([^{W}]|$)')"
    return f"regexp_matches(m, '[{W}]{term}[{W}]')"


def _picked(flags: dict[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {flag} THEN {quoted(name)} END" for name, flag in flags.items())
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


def _kw_flags(min_hits: int = 1) -> dict[str, str]:
    flags = {}
    for topic in sorted(LISTS["keyword"]):
        hits = [f"CAST({_hit(k)} AS INT)" for k in LISTS["keyword"][topic]]
        flag = f"({' + '.join(hits)}) >= {min_hits}"
        for ex in LISTS["exclude"].get(topic, []):
            flag += f" AND NOT contains(m, {quoted(ex.lower())})"
        flags[topic] = flag
    return flags


def _any(kind: str, column: str) -> dict[str, str]:
    return {
        t: " OR ".join(f"contains({column}, {quoted(x.lower())})" for x in LISTS[kind][t])
        for t in sorted(LISTS[kind])
    }


def _leet(term: str) -> str:
    return term.lower().translate(str.maketrans("013457@$", "oieastas"))


def _matched() -> str:
    picks = [
        f"CASE WHEN list_contains(kw, {quoted(t)}) AND contains(l, {quoted(_leet(k))}) THEN {quoted(k)} END"
        for t in sorted(LISTS["keyword"])
        for k in LISTS["keyword"][t]
    ]
    # no spelling occurs twice in the dictionary, so nothing is left to dedupe
    return f"list_filter([{', '.join(picks)}], lambda x: x IS NOT NULL)"


EVIDENCE = [
    f"texts AS (SELECT *, {MATCH} AS m, {LEET} AS l FROM items)",
    f"kws AS (SELECT *, {_picked(_kw_flags())} AS kw, {_picked(_any('negative', 'l'))} AS neg FROM texts)",
    f"evidence AS (SELECT *, {_matched()} AS terms FROM kws)",
]
SCORES = [
    f"""anchors AS (SELECT ({listed(TOPICS)})[label + 1] AS topic,
        CAST(arg_min(embedding, vec_id) AS DOUBLE[]) AS vec FROM embeddings GROUP BY label)""",
    """scores AS (SELECT CAST(vec_id AS VARCHAR) AS id, topic,
        max(list_dot_product(CAST(embedding AS DOUBLE[]), vec)) AS score
        FROM embeddings CROSS JOIN anchors GROUP BY vec_id, topic)""",
    """near AS (SELECT id, list(topic) FILTER (score >= 0.42) AS near,
        list(topic) FILTER (score >= 0.42 + 0.05) AS strong FROM scores GROUP BY id)""",
]
KEPT = "list_filter({t}, lambda x: NOT (list_contains(neg, x) AND NOT list_contains(coalesce(strong, []), x)))"
UNION = "list_sort(list_distinct(list_concat(kw, coalesce(near, []))))"


def _tagging() -> dict[str, str]:
    both = [*EVIDENCE, *SCORES]
    return {
        "items_per_topic": with_items(
            *EVIDENCE,
            body="SELECT topic, count(*) AS n_items FROM (SELECT unnest(kw) AS topic FROM evidence) GROUP BY topic",
        ),
        "tag_large_dictionary": _large_dictionary(),
        "tag_keywords": with_items(*EVIDENCE, body=f"SELECT id, {joined('kw')} AS topics FROM evidence"),
        "tag_min_hits": with_items(
            *EVIDENCE, body=f"SELECT id, {joined(_picked(_kw_flags(2)))} AS topics FROM evidence"
        ),
        "exclude_topics": with_items(
            *EVIDENCE, body=f"SELECT id, {joined(_picked(_any('exclude', 'm')))} AS excluded FROM evidence"
        ),
        "matched_keywords": with_items(*EVIDENCE, body=f"SELECT id, {joined('terms')} AS keywords FROM evidence"),
        "anchor_scores": "WITH " + ", ".join(SCORES) + " SELECT id, topic, round(score, 6) AS score FROM scores",
        "tag_embeddings": with_items(
            *both, body=f"SELECT id, {joined(UNION)} AS topics FROM evidence LEFT JOIN near USING (id)"
        ),
        "drop_negatives": with_items(
            *both, body=f"SELECT id, {joined(KEPT.format(t='kw'))} AS topics FROM evidence LEFT JOIN near USING (id)"
        ),
        "tag_hybrid": with_items(
            *both,
            body=f"""SELECT id, {joined(KEPT.format(t=UNION))} AS topics, {joined('terms')} AS keywords
                FROM evidence LEFT JOIN near USING (id)""",
        ),
        "enrich": with_items(
            *both,
            *_languages(),
            body=f"""SELECT id, CASE WHEN true_lang = 'en' THEN 'xx' ELSE lang END AS lang,
                CASE WHEN true_lang <> 'en' THEN round(CAST(CAST(conf AS FLOAT) AS DOUBLE), 4) END AS lang_conf,
                CASE WHEN true_lang = 'en' THEN {joined('topics')} ELSE {joined(KEPT.format(t=UNION))} END AS topics,
                CASE WHEN true_lang = 'en' THEN '' ELSE {joined('terms')} END AS keywords
                FROM evidence LEFT JOIN near USING (id) JOIN languages USING (id)""",
        ),
        "enrich_batch": with_items(
            *EVIDENCE,
            *_languages(),
            "newest AS (SELECT id FROM items ORDER BY ts DESC, id LIMIT 2000)",
            body=f"""SELECT e.id, CASE WHEN n.id IS NOT NULL THEN lang END AS lang,
                CASE WHEN n.id IS NULL THEN {joined('topics')}
                     ELSE {joined('list_filter(kw, lambda x: NOT list_contains(neg, x))')} END AS topics,
                CASE WHEN n.id IS NULL THEN '' ELSE {joined('terms')} END AS keywords
                FROM evidence e JOIN languages USING (id) LEFT JOIN newest n ON n.id = e.id""",
        ),
        "stream_tagged": with_items(
            *EVIDENCE,
            *_languages(),
            body=f"""SELECT id, {joined('list_filter(kw, lambda x: NOT list_contains(neg, x))')} AS topics,
                {joined('terms')} AS keywords, lang FROM evidence JOIN languages USING (id)""",
        ),
        "stream_topic_counts": with_items(
            *EVIDENCE,
            """tagged AS (SELECT ts, unnest(list_filter(kw, lambda x: NOT list_contains(neg, x))) AS topic,
                ts // 86400 * 86400 AS day FROM evidence)""",
            "spans AS (SELECT ts, topic, unnest([day, day - 86400]) AS window_start FROM tagged)",
            body="""SELECT window_start, topic, count(*) AS n FROM spans
                WHERE ts < window_start + 129600 GROUP BY window_start, topic""",
        ),
        "stream_topic_panes": with_items(
            *EVIDENCE,
            """tagged AS (SELECT ts, unnest(CASE WHEN doc_id % 3 = 0 THEN list_distinct(topics)
                ELSE list_filter(kw, lambda x: NOT list_contains(neg, x)) END) AS topic,
                ts // 86400 * 86400 AS day FROM evidence)""",
            "spans AS (SELECT ts, topic, unnest([day, day - 86400]) AS window_start FROM tagged)",
            body="""SELECT window_start, topic, count(*) AS n FROM spans
                WHERE ts < window_start + 129600 GROUP BY window_start, topic""",
        ),
        "stream_topic_counts_appended": with_items(
            *EVIDENCE,
            """tagged AS (SELECT ts, unnest(list_filter(kw, lambda x: NOT list_contains(neg, x))) AS topic,
                ts // 86400 * 86400 AS day FROM evidence)""",
            "spans AS (SELECT ts, topic, unnest([day, day - 86400]) AS window_start FROM tagged)",
            body="""SELECT window_start, topic, count(*) AS n FROM spans
                WHERE ts < window_start + 129600
                  AND window_start + 129600 <= (SELECT max(ts) FROM items) - 129600
                GROUP BY window_start, topic""",
        ),
    }


# ---- language ---------------------------------------------------------------


def _large_dictionary() -> str:
    """Each term against each text; short terms, all of letters here, against the words of the text."""
    places = [("keyword", i, None) for i in (1, 2, 3, 4)] + [("exclude", 9, 10), ("negative", 14, 15)]
    good = "regexp_full_match({0}, '[A-Za-z]{{2,}}')"
    picks = []
    for at, (kind, a, b) in enumerate(places):
        words = [f"u[{i + 1}]" for i in (a, b) if i is not None]
        term = " || ' ' || ".join(words)
        test = " AND ".join(good.format(w) for w in words)
        picks.append(f"SELECT source AS topic, '{kind}' AS kind, doc_id * 10 + {at} AS ord, {term} AS term FROM cut WHERE {test}")
    return with_items(
        f"texts AS (SELECT id, {MATCH} AS m, {LEET} AS l FROM items)",
        "cut AS (SELECT doc_id, source, string_split(text, ' ') AS u FROM documents)",
        f"terms AS (SELECT topic, kind, term, min(ord) AS ord FROM ({' UNION ALL '.join(picks)}) GROUP BY topic, kind, term)",
        "forms AS (SELECT DISTINCT kind, lower(term) AS f FROM terms)",
        f"tokens AS (SELECT id, unnest(list_distinct(regexp_extract_all(m, '[{W}]+'))) AS f FROM texts)",
        """in_match AS (SELECT id, f FROM tokens WHERE length(f) < 6
            UNION SELECT id, f FROM texts, (SELECT DISTINCT f FROM forms WHERE kind <> 'negative') WHERE (length(f) >= 6 OR contains(f, ' ')) AND contains(m, f))""",
        "in_leet AS (SELECT id, f FROM texts, (SELECT DISTINCT f FROM forms WHERE kind <> 'exclude') WHERE contains(l, f))",
        """hit AS (SELECT DISTINCT id, topic FROM terms JOIN in_match ON f = lower(term) WHERE kind = 'keyword'
            EXCEPT SELECT DISTINCT id, topic FROM terms JOIN in_match ON f = lower(term) WHERE kind = 'exclude')""",
        "neg AS (SELECT DISTINCT id, topic FROM terms JOIN in_leet ON f = lower(term) WHERE kind = 'negative')",
        """spelled AS (SELECT id, topic, ord, term FROM hit JOIN terms USING (topic) JOIN in_leet USING (id)
            WHERE kind = 'keyword' AND f = lower(term))""",
        "once AS (SELECT id, term, min((topic, ord)) AS place FROM spelled GROUP BY id, term)",
        body="""SELECT id, coalesce((SELECT string_agg(topic, '|' ORDER BY topic) FROM hit WHERE hit.id = texts.id), '') AS topics,
            coalesce((SELECT string_agg(term, '|' ORDER BY place) FROM once WHERE once.id = texts.id), '') AS keywords,
            coalesce((SELECT string_agg(topic, '|' ORDER BY topic) FROM neg WHERE neg.id = texts.id), '') AS negatives FROM texts""",
    )


def _languages() -> list[str]:
    names = sorted(PROFILES)
    hits = ", ".join(f"len(list_filter(tok, lambda t: list_contains({listed(PROFILES[n])}, t))) AS {n}" for n in names)
    best = f"greatest({', '.join(names)})"
    pick = " ".join(f"WHEN {n} = {best} THEN '{n}'" for n in names)
    total = " + ".join(names)
    return [
        f"tokens AS (SELECT id, {RAW} AS raw, regexp_extract_all(lower({RAW}), '[{W}]+') AS tok FROM items)",
        f"hits AS (SELECT id, raw, {hits} FROM tokens)",
        f"""languages AS (SELECT id,
            CASE WHEN raw = '' THEN NULL WHEN {total} = 0 THEN 'und' ELSE CASE {pick} END END AS lang,
            CASE WHEN raw = '' THEN NULL WHEN {total} = 0 THEN 0.0
                 ELSE CAST({best} AS DOUBLE) / ({total}) END AS conf FROM hits)""",
    ]


def _windows(text: str) -> str:
    """Buckets of all three-letter windows of a text."""
    letters = f"' ' || trim(regexp_replace(lower({text}), '[^\\p{{L}}]+', ' ', 'g')) || ' '"
    points = f"list_transform(string_split({letters}, ''), lambda c: unicode(c))"
    return (
        f"list_transform(list_zip({points}, ({points})[2:], ({points})[3:]), "
        "lambda w: (961 * w[1] + 31 * w[2] + w[3]) % 16381)"
    )


_PROFILED = (
    f"""seen AS (SELECT lang, b, count(*) AS n FROM (
          SELECT lang, unnest({_windows('text')}) AS b FROM documents WHERE lang IS NOT NULL)
        WHERE b IS NOT NULL GROUP BY lang, b)""",
    "totals AS (SELECT lang, sum(n) AS total FROM seen GROUP BY lang)",
    """logs AS (SELECT t.lang, r.b, ln((coalesce(s.n, 0) + 0.5) / (t.total + 0.5 * 16381)) AS l
        FROM totals t CROSS JOIN (SELECT unnest(range(16381)) AS b) r LEFT JOIN seen s ON s.lang = t.lang AND s.b = r.b)""",
    "odds AS (SELECT lang, b, CAST(round(1000 * (l - avg(l) OVER (PARTITION BY b))) AS BIGINT) AS o FROM logs)",
    f"""judged AS (SELECT id, b, count(*) AS n FROM (SELECT id, unnest({_windows(RAW)}) AS b FROM items)
        WHERE b IS NOT NULL GROUP BY id, b)""",
    "scores AS (SELECT id, lang, sum(n * o) AS score FROM judged JOIN odds USING (b) GROUP BY id, lang)",
    """guesses AS (SELECT id, arg_max(lang, (score, -place)) AS lang, 1 / sum(exp((score - best) / 3000.0)) AS conf
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY lang) AS place,
                     max(score) OVER (PARTITION BY id) AS best FROM scores) GROUP BY id)""",
)


def _language() -> dict[str, str]:
    return {
        "detect_language_profiles": with_items(
            *_PROFILED,
            body=f"""SELECT id, CASE WHEN {RAW} = '' THEN NULL ELSE coalesce(g.lang, 'und') END AS lang,
                CASE WHEN {RAW} = '' THEN NULL ELSE round(coalesce(g.conf, 0.0), 6) END AS lang_conf
                FROM items LEFT JOIN guesses g USING (id)""",
        ),
        "detect_language": with_items(
            *_languages(), body="SELECT id, lang, round(conf, 6) AS lang_conf FROM languages"
        ),
        "prefer_languages": with_items(
            body="""SELECT id, true_lang AS lang, CAST(list_position(['en', 'de', 'ru'], true_lang) AS INT) AS lang_rank
                FROM items WHERE true_lang IN ('en', 'de', 'ru')"""
        ),
    }


# ---- sources and tables -----------------------------------------------------

_RSS = """rss AS (SELECT page_id AS ord,
    CASE WHEN page_id % 9 = 0 THEN replace(url, 'http', 'ftp') ELSE url END AS url FROM pages)"""  # padding is trimmed
_XML_ITEMS = """feeds AS (SELECT doc_id, source, right(source, 1) IN ('0', '2', '4', '6', '8') AS rss,
    trim(left(split_part(text, chr(10), 1), 80)) AS title, trim(text, E' \\n') AS body,
    'https://' || source || '.example.org/' || doc_id AS url,
    TIMESTAMP '2024-01-01' + to_seconds((doc_id * 1601951) % 2592000) AS moment,
    1704067200 + (doc_id * 1601951) % 2592000 AS ts FROM documents)"""
_TERMS = """raw AS (SELECT source AS topic, (['keyword', 'anchor', 'negative', 'exclude'])[n_chars % 4 + 1] AS kind,
    CAST(doc_id AS INT) AS ord, CASE WHEN n_chars % 31 = 0 THEN '  '
    ELSE chr(9) || lower(text) || ' ' END AS term FROM documents),
    topics AS (SELECT DISTINCT source AS topic FROM documents WHERE lang = 'es' AND source > 'src12')"""


def _tables() -> dict[str, str]:
    return {
        "read_feed_entries": f"""WITH {_XML_ITEMS} SELECT CASE WHEN rss THEN 'g' ELSE 'a' END || doc_id AS id,
            url AS link, title,
            CASE WHEN rss THEN strftime(moment, '%a, %d %b %Y %H:%M:%S +0000') END AS published,
            CASE WHEN NOT rss THEN strftime(moment, '%Y-%m-%dT%H:%M:%SZ') END AS updated,
            body AS summary, CASE WHEN rss THEN 0 ELSE 2 END AS n_links, false AS is_corrupt FROM feeds""",
        "stream_items": f"""WITH {_XML_ITEMS} SELECT
            sha256(concat_ws('|', url, nullif(title, ''), CASE WHEN rss THEN 'g' ELSE 'a' END || doc_id)) AS id,
            url, ts, title, body AS text FROM feeds""",
        "feed_sources": f"""WITH {_RSS}, nested AS (
              SELECT CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN 2 ELSE 3 END AS part, doc_id AS ord,
                     CASE WHEN n_chars % 17 = 0 THEN '' ELSE 'reddit:' || source || '/' || lang END AS url FROM documents
              UNION ALL SELECT 1, page_id, url FROM pages
              UNION ALL SELECT 0, ord, url FROM rss WHERE regexp_matches(url, '(?i)^https?://')),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY part, ord) AS r FROM nested WHERE url <> '')
            SELECT url, part, ord FROM ranked WHERE r = 1""",
        "only_http_sources": f"WITH {_RSS} SELECT * FROM rss WHERE regexp_matches(url, '(?i)^https?://')",
        "dropped_sources": f"WITH {_RSS} SELECT * FROM rss WHERE NOT regexp_matches(url, '(?i)^https?://')",
        "items_insert": with_items(
            "arrivals AS (SELECT id, url, ts, title, text FROM items UNION ALL "
            "SELECT 'x' || id, url, ts + 3600, title, text FROM items UNION ALL "
            "SELECT id, url, ts + 7200, title, text FROM items)",
            "stored AS (SELECT id, url, ts, title, text FROM items WHERE doc_id % 2 = 0)",
            "by_id AS (SELECT * FROM arrivals QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts) = 1)",
            "unseen AS (SELECT * FROM by_id WHERE id NOT IN (SELECT id FROM stored) AND "
            "(url IS NULL OR url NOT IN (SELECT url FROM stored WHERE url IS NOT NULL)))",
            "added AS (SELECT * FROM unseen QUALIFY url IS NULL OR row_number() OVER (PARTITION BY url ORDER BY ts, id) = 1)",
            body="SELECT * FROM stored UNION ALL SELECT * FROM added",
        ),
        "scan_pending": with_items(
            body="SELECT id, ts, title FROM items WHERE true_lang <> 'en' ORDER BY ts DESC, id LIMIT 2000"
        ),
        "enrich_update": with_items(
            body=f"""SELECT id, CASE WHEN true_lang <> 'en' THEN true_lang END AS lang,
                CASE WHEN true_lang <> 'en' THEN 0.5 END AS lang_conf,
                CASE true_lang WHEN 'en' THEN {joined('topics')} WHEN 'de' THEN src ELSE '' END AS topics,
                CASE WHEN true_lang <> 'en' THEN title ELSE '' END AS keywords FROM items"""
        ),
        "scan_recent": with_items(
            body=f"""SELECT id, title || ' ' || text AS content, {joined('topics')} AS topics, ts
                FROM items WHERE ts >= {AS_OF} - 36 * 3600"""
        ),
        "retain_recent": with_items(body=f"SELECT id, ts, title FROM items WHERE ts >= {AS_OF} - 36 * 3600"),
        "check_items": with_items(
            """broken AS (SELECT CAST(CAST(length(text) % 150 AS DOUBLE) / 100 AS FLOAT) AS lang_conf,
                CASE WHEN doc_id % 19 > 0 THEN src END AS src, coalesce(url, src) AS url,
                CASE WHEN doc_id % 23 > 0 THEN topics END AS topics,
                CASE WHEN doc_id % 29 > 0 THEN title END AS id FROM items)""",
            body="""SELECT 'id is null' AS rule, count(*) FILTER (id IS NULL) AS violations FROM broken
                UNION ALL SELECT 'src is null', count(*) FILTER (src IS NULL) FROM broken
                UNION ALL SELECT 'ts is null', 0 UNION ALL SELECT 'entities is null', 0
                UNION ALL SELECT 'keywords is null', 0
                UNION ALL SELECT 'topics is null', count(*) FILTER (topics IS NULL) FROM broken
                UNION ALL SELECT 'lang_conf outside 0..1', count(*) FILTER (lang_conf > 1) FROM broken
                UNION ALL SELECT 'id repeated', count(*) FROM
                    (SELECT id FROM broken WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)
                UNION ALL SELECT 'url repeated', count(*) FROM
                    (SELECT url FROM broken WHERE url IS NOT NULL GROUP BY url HAVING count(*) > 1)""",
        ),
        "check_clusters": f"""WITH {DOC_CLUSTERS}
            SELECT unnest(['cluster_id is null', 'start_ts is null', 'size is null', 'rep_item_ids is null']) AS rule,
                0 AS violations
            UNION ALL SELECT 'score is null', count(*) FILTER (score IS NULL) FROM clusters
            UNION ALL SELECT 'cluster_id repeated', count(*) FROM (SELECT left(cluster_id, 3) FROM clusters
                GROUP BY left(cluster_id, 3) HAVING count(*) > 1)""",
        "build_terms": f"""WITH {_TERMS} SELECT topic, kind, min(ord) AS ord, {strip('term')} AS term FROM raw
            SEMI JOIN topics USING (topic) WHERE {strip('term')} <> '' GROUP BY topic, kind, {strip('term')}""",
        "unknown_terms": f"WITH {_TERMS} SELECT topic, kind, ord, term FROM raw ANTI JOIN topics USING (topic)",
    }


# ---- entries and text -------------------------------------------------------


def _text() -> dict[str, str]:
    plain = f"""CASE WHEN length(html) >= 30 THEN nullif({strip(unescape(
        f"CASE WHEN contains(html, '<') AND contains(html, '>') THEN {plain_html('html')} ELSE html END"))}, '') END"""
    # only a link that is the page's own address finds the landed page
    markup = """markup AS (SELECT 'd' || doc_id AS k, '<p>' || text || '</p>' AS x FROM documents WHERE doc_id % 4 = 0
        UNION ALL SELECT 'p' || page_id, html FROM pages)"""
    entries = f"""entries AS (SELECT d.doc_id AS n, source, d.text,
            CASE WHEN d.doc_id % 2 = 0 AND url IS NOT NULL THEN url
                 WHEN d.doc_id % 3 = 0 THEN 'urn:doc:' || d.doc_id ELSE url END AS url,
            CASE WHEN d.doc_id % 3 = 0 THEN 'urn:doc:' || d.doc_id END AS entry_id,
            CASE WHEN d.doc_id % 7 > 0 THEN left(split_part(d.text, chr(10), 1), 80) END AS title,
            CASE WHEN d.doc_id % 4 = 0 THEN t
                 WHEN d.doc_id % 4 = 1 AND length(d.text) >= 30 THEN nullif({strip('d.text')}, '')
                 END AS inline,
            1704067200 + (d.doc_id * 1601951) % 2592000 AS moment
        FROM documents d LEFT JOIN pages ON page_id = d.doc_id LEFT JOIN read_texts ON k = 'd' || d.doc_id)"""
    bodies = """bodies AS (SELECT e.*, CASE WHEN inline IS NULL THEN t END AS page_text
        FROM entries e LEFT JOIN pages p ON p.url = e.url LEFT JOIN read_texts ON k = 'p' || page_id)"""
    whole = f"""whole AS (SELECT *, coalesce(inline, page_text, {strip(
        "coalesce(CASE WHEN n % 8 IN (2, 6) THEN text END, '')"
        )}) AS body FROM bodies)"""
    return {
        "html_to_text": f"""WITH RECURSIVE markup AS (SELECT page_id AS k, html AS x FROM pages), {html_texts('markup')}
            SELECT page_id, t AS text FROM pages JOIN read_texts ON k = page_id""",
        "strip_html_tags": f"SELECT page_id, {plain} AS text FROM pages",
        "clean_text_cols": f"SELECT page_id, {clean('html')} AS text FROM pages",
        "normalize_for_match": f"SELECT doc_id, {strip('replace(lower(text), chr(223), chr(115) || chr(115))')} AS text FROM documents",
        "normalize_leet": f"""SELECT doc_id, {strip("regexp_replace(translate(lower(text), '013457@$', 'oieastas'), '\\s+', ' ', 'g')")}
            AS text FROM documents""",
        "short_body_report": with_items(
            body="SELECT id, url, length(text) AS n_chars FROM items WHERE length(text) < 400"
        ),
        "entries_to_items": f"""WITH RECURSIVE {markup}, {html_texts('markup')}, {entries}, {bodies}, {whole}
            SELECT sha256(coalesce(nullif(concat_ws('|', nullif(url, ''), nullif(title, ''), entry_id), ''), body)) AS id,
                'rss' AS src, url, CASE n % 20 WHEN 0 THEN moment - 7200 WHEN 4 THEN moment + 5 * 3600
                    WHEN 5 THEN moment // 60 * 60 WHEN 8 THEN moment // 86400 * 86400 WHEN 9 THEN 1704067200
                    WHEN 10 THEN moment + 7 * 3600 WHEN 11 THEN moment - 9 * 3600 WHEN 12 THEN moment // 60 * 60
                    ELSE moment END AS ts,
                coalesce(title, '') AS title, body AS text FROM whole""",
    }


# ---- clustering -------------------------------------------------------------

_TOKENS = [
    "docs AS (SELECT id, concat_ws(' ', title, text) AS content FROM items)",
    f"""words AS (SELECT id, list_filter(regexp_extract_all(lower(content), '[{W}]{{2,}}'),
        lambda t: NOT list_contains({listed(ENGLISH)}, t)) AS t FROM docs)""",
    """terms AS (SELECT id, unnest(list_concat(t,
        list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM words)""",
    "tf AS (SELECT id, term, count(*) AS tf FROM terms GROUP BY id, term)",
    "n AS (SELECT count(*) AS n FROM docs)",
    """dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term
        HAVING df >= (SELECT CASE WHEN n >= 4 THEN 2 ELSE 1 END FROM n) AND df <= 0.85 * (SELECT n FROM n))""",
]
_K = "CAST(CASE WHEN n_docs <= 8 THEN 2 ELSE greatest(2, least(round_even(sqrt(n_docs / 2), 0), 24)) END AS INT)"


def rollup(label: str, as_of: int, name: str, summary: str = "NULL") -> str:
    labelled = f"(SELECT id, ts, coalesce(topics[1], 'misc') AS topic, {label} AS label FROM items)"
    return f"""{name}_parts AS (SELECT label, left(md5(id), 3) AS part, md5(string_agg(id, '|' ORDER BY id)) AS digest
        FROM {labelled} GROUP BY label, left(md5(id), 3)),
        {name}_ids AS (SELECT label, md5(string_agg(digest, '|' ORDER BY part)) AS cluster_id
        FROM {name}_parts GROUP BY label),
        {name} AS (SELECT label, any_value(cluster_id) AS cluster_id,
        list(topic ORDER BY ts, id)[1] AS topic, min(ts) AS start_ts, max(ts) AS end_ts, CAST(count(*) AS INT) AS size,
        CAST(count(*) + 2.0 / greatest(1.0, ({as_of} - max(ts)) / 3600.0) AS FLOAT) AS score,
        {summary.format(topic='list(topic ORDER BY ts, id)[1]')} AS summary,
        list(id ORDER BY ts DESC, id)[1:5] AS reps
        FROM {labelled} JOIN {name}_ids USING (label)
        GROUP BY label HAVING count(*) >= 3)"""


KMEANS_ROUNDS = 12


def _kmeans(rounds: int = KMEANS_ROUNDS) -> list[str]:
    """CTEs of the fixed number of rounds; a finished run gives the same labels again."""
    ctes = [
        "keyed AS (SELECT id, md5(content) AS point FROM docs)",
        "points AS (SELECT point, count(*) AS copies FROM keyed GROUP BY point)",
        """raw AS (SELECT id, term, tf * (ln((1.0 + n) / (1.0 + df)) + 1.0) AS w FROM tf JOIN dfs USING (term), n)""",
        "norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM raw GROUP BY id)",
        """cells AS MATERIALIZED (SELECT point, term, any_value(w / norm) AS w
            FROM raw JOIN norms USING (id) JOIN keyed USING (id) GROUP BY point, term)""",
        """l0 AS MATERIALIZED (SELECT point, 1 AS copies, row_number() OVER (ORDER BY point) - 1 AS label
            FROM (SELECT DISTINCT point FROM cells) ORDER BY point
            LIMIT (SELECT CASE WHEN n <= 8 THEN 2 ELSE greatest(2, least(round_even(sqrt(n / 2), 0), 24)) END::INT FROM n))""",
    ]
    for i in range(rounds):
        old = f" UNION ALL SELECT label, term, c FROM c{i - 1} WHERE label NOT IN (SELECT label FROM l{i})" if i else ""
        ctes += [
            f"""c{i} AS MATERIALIZED (SELECT label, term, sum(w * copies) / any_value(size) AS c
                FROM cells JOIN l{i} USING (point)
                JOIN (SELECT label, sum(copies) AS size FROM l{i} GROUP BY label) USING (label)
                GROUP BY label, term{old})""",
            f"""d{i} AS (SELECT point, label, sum(w * c) AS dot FROM cells JOIN c{i} USING (term) GROUP BY point, label)""",
            f"""l{i + 1} AS MATERIALIZED (SELECT point, copies, arg_min(label, (-score, label)) AS label FROM (
                SELECT point, copies, label, round(2 * coalesce(dot, 0) - length, 9) AS score
                FROM points CROSS JOIN (SELECT label, sum(c * c) AS length FROM c{i} GROUP BY label)
                LEFT JOIN d{i} USING (point, label)) GROUP BY point, copies)""",
        ]
    return ctes


_FRESH_LABEL = "CASE WHEN length(src) = 4 THEN src || '-' || true_lang ELSE src END"
STORED = rollup("src", EARLIER, "stored", "'- stored ' || {topic}")
FRESH = rollup(_FRESH_LABEL, AS_OF, "fresh")
_CLUSTER = "cluster_id, topic, start_ts, end_ts, size, round(CAST(score AS DOUBLE), 3) AS score, summary"


def _clustering() -> dict[str, str]:
    return {
        "cluster_docs": with_items(_TOKENS[0], body="SELECT * FROM docs"),
        "terms_ngrams": with_items(*_TOKENS[:4], body="SELECT * FROM tf"),
        "df_prune": with_items(*_TOKENS, body="SELECT * FROM dfs"),
        "tfidf": with_items(
            *_TOKENS,
            "raw AS (SELECT id, term, tf * (ln((1.0 + n) / (1.0 + df)) + 1.0) AS w FROM tf JOIN dfs USING (term), n)",
            "norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM raw GROUP BY id)",
            body="SELECT id, term, round(w / norm, 6) AS weight FROM raw JOIN norms USING (id)",
        ),
        "cluster_tfidf": with_items(
            *_TOKENS, *_kmeans(), body=f"SELECT id, CAST(label AS INT) AS label FROM keyed JOIN l{KMEANS_ROUNDS} USING (point)"
        ),
        "choose_k": f"""WITH parts AS (SELECT source AS part, count(*) AS n_docs FROM documents GROUP BY source
            UNION ALL SELECT 'all', count(*) FROM documents) SELECT part, n_docs, {_K} AS k FROM parts""",
        "similarity_components": """WITH RECURSIVE edges AS (
            SELECT CAST(a.vec_id AS VARCHAR) AS u, CAST(b.vec_id AS VARCHAR) AS v FROM embeddings a, embeddings b
            WHERE a.vec_id <> b.vec_id
              AND list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) > 1 - 0.65),
            reach AS (SELECT CAST(vec_id AS VARCHAR) AS id, CAST(vec_id AS VARCHAR) AS seen FROM embeddings
                UNION SELECT r.id, e.v FROM reach r JOIN edges e ON e.u = r.seen)
            SELECT id, min(seen) AS component FROM reach GROUP BY id""",
        # every group joins its nearest where both are each other's, until none is near enough
        "cluster_embeddings": """WITH RECURSIVE points AS (SELECT CAST(vec_id AS VARCHAR) AS id,
                CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
            pairs AS MATERIALIZED (SELECT a.id AS a, b.id AS b, list_dot_product(a.v, b.v) AS s FROM points a, points b WHERE a.id <> b.id),
            steps AS (SELECT 0 AS step, id, id AS label FROM points
                UNION ALL
                SELECT step + 1, id, coalesce(into_label, label) FROM (
                    WITH means AS (SELECT x.label AS g, y.label AS h, avg(s) AS s FROM steps x JOIN pairs ON x.id = a
                            JOIN steps y ON y.id = b WHERE x.label <> y.label GROUP BY ALL),
                        nearest AS (SELECT g, arg_min(h, (-round(s, 12), h)) AS h, max(s) AS s FROM means GROUP BY g),
                        merged AS (SELECT n.h AS g, n.g AS into_label FROM nearest n JOIN nearest m ON m.g = n.h AND m.h = n.g
                            WHERE n.g < n.h AND n.s > 1 - 0.70)
                    SELECT step, id, label, into_label FROM steps LEFT JOIN merged ON g = label
                    WHERE EXISTS (SELECT 1 FROM merged)))
            SELECT id, label FROM steps WHERE step = (SELECT max(step) FROM steps)""",
        "cluster_rollup": with_items(FRESH, body=f"SELECT {_CLUSTER}, {joined('reps')} AS rep_item_ids FROM fresh"),
        "cluster_members": with_items(
            FRESH,
            body=f"""SELECT cluster_id, id FROM (SELECT id, {_FRESH_LABEL} AS label FROM items)
                JOIN fresh USING (label)""",
        ),
        "clusters_upsert": with_items(
            STORED,
            FRESH,
            body=f"""SELECT coalesce(s.cluster_id, f.cluster_id) AS cluster_id,
                CASE WHEN s.cluster_id IS NULL THEN f.topic ELSE s.topic END AS topic,
                CASE WHEN s.cluster_id IS NULL THEN f.start_ts ELSE s.start_ts END AS start_ts,
                coalesce(f.end_ts, s.end_ts) AS end_ts, coalesce(f.size, s.size) AS size,
                round(CAST(greatest(s.score, f.score) AS DOUBLE), 3) AS score, s.summary AS summary,
                {joined('coalesce(f.reps, s.reps)')} AS rep_item_ids
                FROM stored s FULL JOIN fresh f ON s.cluster_id = f.cluster_id""",
        ),
        "run_stats": with_items(
            *EVIDENCE,
            FRESH,
            body=f"""SELECT 'items before' AS stat, count(*) AS value FROM items
                UNION ALL SELECT 'items', count(*) FROM items
                UNION ALL SELECT 'items with language', count(*) FROM items
                UNION ALL SELECT 'items with topics', count(*) FROM items WHERE len(topics) > 0
                UNION ALL SELECT 'items in clusters', CAST(sum(size) AS BIGINT) FROM fresh
                UNION ALL SELECT 'clusters', count(*) FROM fresh
                UNION ALL SELECT 'digest rows', CAST(sum(least(n, 8)) AS BIGINT) FROM (SELECT topic, count(*) AS n,
                    max(end_ts) AS e FROM fresh GROUP BY topic) WHERE e >= {AS_OF} - 36 * 3600""",
        ),
    }


# ---- summaries --------------------------------------------------------------

_REPS = [
    FRESH,
    "wanted AS (SELECT cluster_id, unnest(reps) AS id, generate_subscripts(reps, 1) - 1 AS pos FROM fresh)",
    "reps AS (SELECT cluster_id, pos, id, title, url, text FROM wanted JOIN items USING (id))",
]
_CONTEXT = [
    *_REPS,
    f"""blocks AS (SELECT cluster_id, pos, concat_ws(chr(10),
        CASE WHEN {clean('title')} <> '' THEN 'Title: ' || {clean('title')} END,
        CASE WHEN url <> '' THEN 'URL: ' || url END, nullif({clean('text')}, '')) AS block FROM reps)""",
    """contexts AS (SELECT cluster_id,
        string_agg(block, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY pos) AS context
        FROM blocks GROUP BY cluster_id)""",
]
_SENTENCES = [
    f"""lines AS (SELECT cluster_id, {strip('unnest(string_split(context, chr(10)))')} AS line,
        generate_subscripts(string_split(context, chr(10)), 1) AS a FROM contexts)""",
    r"""pieces AS (SELECT cluster_id, a, string_split(regexp_replace(regexp_replace(line, '^Title: ', ''),
        '([.?!])\s+', '\1' || chr(10), 'g'), chr(10)) AS s FROM lines
        WHERE line <> '' AND line <> '---' AND NOT starts_with(line, 'URL: '))""",
    """sentences AS (SELECT cluster_id, a, unnest(s) AS sentence, generate_subscripts(s, 1) AS b FROM pieces)""",
    f"""words AS (SELECT cluster_id, a, b, unnest(list_filter(regexp_extract_all(lower(sentence), '[{W}]{{2,}}'),
        lambda t: NOT list_contains({listed(ENGLISH)}, t))) AS word FROM sentences WHERE sentence <> '')""",
    "dfs AS (SELECT word, count(DISTINCT cluster_id) AS df FROM words GROUP BY word)",
    """means AS (SELECT cluster_id, a, b, round(avg(ln((1.0 + (SELECT count(*) FROM contexts)) / (1.0 + df)) + 1.0), 9) AS mean
        FROM words JOIN dfs USING (word) GROUP BY cluster_id, a, b)""",
    """best AS (SELECT * FROM means QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY mean DESC, a, b) <= 3)""",
    """raws AS (SELECT cluster_id, string_agg('- ' || array_to_string(string_split(sentence, ' ')[1:60], ' '), chr(10)
        ORDER BY a, b) AS raw FROM best JOIN sentences USING (cluster_id, a, b) GROUP BY cluster_id)""",
]
_TURNS = [
    """turns AS (SELECT conv_id || '-' || turn AS cluster_id, conv_id, turn, text AS t FROM conversations)""",
    """raws AS (SELECT cluster_id, CASE turn % 7 WHEN 0 THEN t
        WHEN 1 THEN '- ' || replace(t, '. ', chr(10) || '- ') || chr(10) || 'Entities: A, B'
        WHEN 2 THEN replace(t, '. ', ' - ') WHEN 3 THEN '' WHEN 4 THEN 'Entities: ' || t
        WHEN 5 THEN string_split(t, ' ')[1] ELSE '• ' || t END AS raw FROM turns)""",
    """reps AS (SELECT cluster_id, pos, id, title, url, text FROM (
        SELECT cluster_id, 0 AS pos, CAST(conv_id AS VARCHAR) AS id FROM turns
        UNION ALL SELECT cluster_id, 1, CAST(conv_id + turn + 1 AS VARCHAR) FROM turns) JOIN items USING (id))""",
]
_HOST = r"""list_filter(string_split(regexp_extract(u, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1), '.'), lambda p: p <> '')"""
_FACTS = [
    f"""facts AS (SELECT cluster_id,
        list_filter(list({clean('title')} ORDER BY pos), lambda x: x <> '') AS titles,
        list_filter(list(url ORDER BY pos), lambda x: x IS NOT NULL AND x <> '') AS urls FROM reps GROUP BY cluster_id)""",
    f"""hosts AS (SELECT cluster_id, list(coalesce(h[-2], h[1]) ORDER BY i) AS hosts FROM (
        SELECT cluster_id, i, {_HOST} AS h FROM (
            SELECT cluster_id, unnest(urls) AS u, generate_subscripts(urls, 1) AS i FROM facts))
        WHERE len(h) > 0 GROUP BY cluster_id)""",
    """names AS (SELECT cluster_id, titles, list_concat(titles[1:3], list_transform(coalesce(hosts, [])[1:6],
        lambda x: upper(left(x, 1)) || lower(substr(x, 2)))) AS named FROM facts LEFT JOIN hosts USING (cluster_id))""",
    """fallback AS (SELECT cluster_id, titles, coalesce(nullif(array_to_string(
        list_filter(named, lambda x, i: list_position(named, x) = i)[1:6], ', '), ''), '—') AS entities FROM names)""",
]
_HOLDERS = listed(PLACEHOLDERS)


def _formatted(keep_lines: bool) -> list[str]:
    """CTEs up to ``done(cluster_id, summary)`` from ``raws`` and ``fallback``."""
    lines = f"list_filter(list_transform(string_split(raw, chr(10)), lambda x: {clean('x')}), lambda x: x <> '')"
    txt = f"coalesce(array_to_string({lines}, chr(10)), '')" if keep_lines else clean("raw")
    return [
        f"txts AS (SELECT cluster_id, {txt} AS txt FROM raws)",
        rf"""parsed AS (SELECT cluster_id, coalesce(titles, []) AS titles,
            CASE WHEN regexp_matches(txt, '(?im)^entities\s*:\s*(.*)$')
                 THEN {clean("regexp_extract(txt, '(?im)^entities" + chr(92) + "s*:" + chr(92) + "s*(.*)$', 1)")}
                 ELSE coalesce(entities, '—') END AS entities,
            {strip("regexp_replace(txt, '(?im)^entities\\s*:.*$', '', 'g')")} AS body
            FROM txts LEFT JOIN fallback USING (cluster_id))""",
        rf"""ways AS (SELECT *,
            list_transform(list_filter(list_transform(string_split(body, chr(10)), lambda x: {strip('x')}),
                lambda x: left(x, 1) IN ('-', '•', '—')), lambda x: {strip("regexp_replace(x, '^[-•]\\s*', '')")}) AS marked,
            list_filter(list_transform(string_split_regex({strip("regexp_replace(body, '^[- •]+', '')")}, '\s-\s'),
                lambda x: {strip('x')}), lambda x: x <> '') AS inline,
            list_filter(list_transform(string_split(regexp_replace(body, '([.?!])\s+', '\1' || chr(1), 'g'), chr(1)),
                lambda x: {strip('x')}), lambda x: x <> '') AS sentences FROM parsed)""",
        """found AS (SELECT cluster_id, titles, entities, CASE WHEN len(marked) <= 1 AND len(inline) >= 2 THEN inline
            WHEN len(marked) = 0 THEN sentences ELSE marked END AS b FROM ways)""",
        """titled AS (SELECT cluster_id, entities, CASE WHEN len(b) < 3 THEN list_concat(b,
            list_filter(titles, lambda x, i: NOT list_contains(b, x) AND list_position(titles, x) = i)[1:3 - len(b)])
            ELSE b END AS b FROM found)""",
        f"cleaned AS (SELECT cluster_id, entities, list_transform(list_filter(b, lambda x: x <> ''), lambda x: {clean('x')}) AS b FROM titled)",
        f"filled AS (SELECT cluster_id, entities, CASE WHEN len(b) = 0 THEN {_HOLDERS} ELSE b END AS b FROM cleaned)",
        """done AS (SELECT cluster_id, '- ' || b[1] || chr(10) || '- ' || coalesce(b[2], b[-1]) || chr(10) || '- ' ||
            coalesce(b[3], b[-1]) || chr(10) || 'Entities: ' || coalesce(nullif(entities, ''), '—') AS summary FROM filled)""",
    ]


def _summaries() -> dict[str, str]:
    top = "top AS (SELECT * FROM fresh ORDER BY score DESC, cluster_id LIMIT 24)"
    of_top = [
        FRESH,
        top,
        "wanted AS (SELECT cluster_id, unnest(reps) AS id, generate_subscripts(reps, 1) - 1 AS pos FROM top)",
        _REPS[2],
        *_CONTEXT[3:],
    ]
    return {
        "top_clusters": f"""WITH {DOC_CLUSTERS} SELECT cluster_id, size, round(CAST(score AS DOUBLE), 3) AS score
            FROM clusters ORDER BY clusters.score DESC NULLS LAST, cluster_id LIMIT 24""",
        "rep_items": with_items(*_REPS, body="SELECT cluster_id, CAST(pos AS INT) AS pos, id, title, url FROM reps"),
        "cluster_context": with_items(*_CONTEXT, body="SELECT * FROM contexts"),
        "extractive_summary": with_items(
            *_CONTEXT,
            *_SENTENCES,
            body="SELECT cluster_id, coalesce(raw, '') AS raw FROM contexts LEFT JOIN raws USING (cluster_id)",
        ),
        "entities_fallback": with_items(*_TURNS, *_FACTS, body="SELECT cluster_id, entities FROM fallback"),
        "empty_context_summary": with_items(
            *_TURNS,
            *_FACTS,
            body=f"""SELECT cluster_id, '- ' || array_to_string(CASE WHEN len(titles) = 0 THEN {_HOLDERS}
                ELSE titles[1:3] END, chr(10) || '- ') || chr(10) || 'Entities: ' || entities AS summary FROM fallback""",
        ),
        "format_summaries": with_items(*_TURNS, *_FACTS, *_formatted(False), body="SELECT * FROM done"),
        "format_summaries_by_line": with_items(*_TURNS, *_FACTS, *_formatted(True), body="SELECT * FROM done"),
        "summarize": with_items(
            *of_top,
            *_SENTENCES,
            *_FACTS,
            *_formatted(True),
            body="SELECT cluster_id, topic, size, done.summary FROM fresh LEFT JOIN done USING (cluster_id)",
        ),
        "summary_update": f"""WITH {DOC_CLUSTERS} SELECT cluster_id, topic, size,
            coalesce('- quality ' || quality, summary) AS summary
            FROM clusters LEFT JOIN labels ON CAST(doc_id AS VARCHAR) = cluster_id""",
    }


# ---- digest -----------------------------------------------------------------

DOC_CLUSTERS = """heads AS (SELECT *, text AS head FROM documents),
    clusters AS (SELECT CAST(doc_id AS VARCHAR) AS cluster_id, CASE WHEN doc_id % 3 = 0 THEN 'misc' ELSE lang END AS topic,
        CASE WHEN doc_id % 11 > 0 THEN 1704067200 + (doc_id * 1601951) % 2592000 END AS end_ts,
        CAST(n_chars % 97 + 1 AS INT) AS size,
        CASE WHEN doc_id % 13 > 0 THEN CAST(n_chars % 101 AS FLOAT) END AS score,
        CASE doc_id % 5
            WHEN 0 THEN '- ' || replace(head, '. ', '.' || chr(10) || '* ') || chr(10) || 'Entities: ' || source
            WHEN 1 THEN '- ' || replace(head, '. ', '.' || chr(10) || '* ') || ' Entities : ' || source || ', ' || lang
            WHEN 2 THEN upper(replace(head, 'ß', 'SS')) || '!!!'
            WHEN 3 THEN upper(replace(head, 'ß', '')) END AS summary,
        [CAST(doc_id AS VARCHAR), CAST(doc_id + 1 AS VARCHAR), CAST(doc_id + 2 AS VARCHAR)] AS reps FROM heads)"""

_COUNTS = f"""counts AS (SELECT topic, sum(size) AS total FROM clusters
    WHERE end_ts IS NULL OR end_ts >= {AS_OF} - 36 * 3600 GROUP BY topic)"""
_TOP = """top AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY score DESC NULLS LAST, size DESC, cluster_id) AS rank
    FROM clusters WHERE topic IN (SELECT topic FROM counts) QUALIFY rank <= 8)"""
_TEXTS = f"texts AS (SELECT cluster_id, coalesce(nullif({strip('summary')}, ''), '(no summary available)') AS s FROM clusters)"
_INLINE = rf"'(?i)^(.*?(?:^|[^{W}]))entities\s*:\s*(.+)$'"
_SPLIT = [
    _TEXTS,
    f"""split_lines AS (SELECT cluster_id, list_filter(list_transform(string_split({unescape('s')}, chr(10)),
        lambda x: {strip('x')}), lambda x: x <> '') AS ls FROM texts)""",
    rf"""split_done AS (SELECT cluster_id,
        coalesce({strip(f"regexp_extract(list_filter(ls, lambda x: regexp_matches(x, {_INLINE}))[1], {_INLINE}, 2)")}, '') AS entities,
        list_filter(list_transform(list_filter(list_transform(ls, lambda x: CASE WHEN regexp_matches(x, {_INLINE})
            THEN rtrim(regexp_extract(x, {_INLINE}, 1), E' \n\t') ELSE x END), lambda x: x <> ''),
            lambda x: {strip(r"regexp_replace(x, '^[-*•]\s+', '')")}), lambda x: x <> '') AS bullets FROM split_lines)""",
]


def _linked(url: str) -> list[str]:
    return [
        "wanted AS (SELECT cluster_id, unnest(reps) AS id, generate_subscripts(reps, 1) - 1 AS pos FROM clusters)",
        f"reps AS (SELECT cluster_id, CAST(pos AS INT) AS pos, title, {url} AS url FROM wanted JOIN items USING (id))",
        f"""links AS (SELECT cluster_id, pos, coalesce(nullif({clean('title')}, ''), url) AS title, url
            FROM reps WHERE url <> '')""",
        """per AS (SELECT cluster_id, list(url ORDER BY pos) AS urls, list(url || ' ' || title ORDER BY pos) AS shown
            FROM links GROUP BY cluster_id)""",
        "found AS (SELECT cluster_id, CAST(count(*) AS INT) AS n_items FROM reps GROUP BY cluster_id)",
        """tones AS (SELECT cluster_id, CASE WHEN len(list_filter(coalesce(urls, []), lambda u: contains(u, 'gov')
                OR contains(u, 'europa.eu') OR contains(u, 'nato.int'))) > 0 THEN 'Official'
            WHEN (upper(s) = s AND lower(s) <> s) OR contains(s, '!!!') THEN 'Propagandistic'
            ELSE 'Neutral/Reportage' END AS tone FROM texts LEFT JOIN per USING (cluster_id))""",
    ]


def _escaped(x: str) -> str:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        x = f"replace({x}, '{char}', '{entity}')"
    return x


_HTML = [
    f"""shown AS (SELECT topic, rank, concat_ws(chr(10), '<h3>' || rank || ') Summary</h3>',
        CASE WHEN len(bullets) > 0 THEN '<ul>' || array_to_string(list_transform(bullets,
            lambda b: '<li>' || {_escaped(clean('b'))} || '</li>'), '') || '</ul>'
            ELSE '<p>(no summary available)</p>' END,
        CASE WHEN entities <> '' THEN '<p><b>Entities:</b> ' || {_escaped('entities')} || '</p>' END,
        '<p><b>Tone:</b> ' || tone || '</p>',
        CASE WHEN n_items > 0 THEN '<p><b>Links:</b></p><ul>' || coalesce(array_to_string(anchored, ''), '') || '</ul>'
            ELSE '<p><b>Links:</b> (none)</p>' END) AS html
        FROM top JOIN split_done USING (cluster_id) JOIN tones USING (cluster_id)
        LEFT JOIN found USING (cluster_id) LEFT JOIN (SELECT cluster_id, list('<li><a href="' || {_escaped('url')} || '">'
            || {_escaped('title')} || '</a></li>' ORDER BY pos) AS anchored FROM links GROUP BY cluster_id)
            USING (cluster_id))""",
    "ranked AS (SELECT topic, total, row_number() OVER (ORDER BY total DESC, topic) AS section FROM counts)",
    f"""report AS (
        SELECT NULL AS topic, 0 AS section, '<!DOCTYPE html>' || chr(10) ||
            '<html lang="en"><head><meta charset="utf-8"><title>Daily Monitoring Digest</title></head><body>' || chr(10)
            || '<h1>Daily Monitoring Digest — 31.Jan.2024 00:00 (UTC)</h1>' || chr(10)
            || '<p><b>Topic counts (last 24–36h buffer):</b> '
            || string_agg({_escaped('topic')} || ': ' || total, ', ' ORDER BY section) || '</p>' AS html FROM ranked
        UNION ALL SELECT topic, section, '<h2>' || {_escaped('topic')} || ' (up to 8 clusters)</h2>' || chr(10)
            || string_agg('<div>' || html || '</div>', chr(10) ORDER BY rank)
            FROM ranked JOIN shown USING (topic) GROUP BY topic, section
        UNION ALL SELECT NULL, 2147483647, '</body></html>')""",
]


def _digest() -> dict[str, str]:
    marked = "replace(url, 'example.org', 'europa.eu')"
    return {
        "topic_counts": f"WITH {DOC_CLUSTERS}, {_COUNTS} SELECT topic, CAST(total AS BIGINT) AS total FROM counts",
        "top_per_topic": f"""WITH {DOC_CLUSTERS}, {_COUNTS}, {_TOP}
            SELECT topic, rank, cluster_id, size, round(CAST(score AS DOUBLE), 3) AS score FROM top""",
        "split_summary": f"""WITH {DOC_CLUSTERS}, {', '.join(_SPLIT)}
            SELECT cluster_id, {joined('bullets')} AS bullets, entities FROM split_done""",
        "tone": with_items(
            DOC_CLUSTERS, _TEXTS, *_linked(marked), body="SELECT cluster_id, tone FROM tones"
        ),
        "cluster_links": with_items(
            DOC_CLUSTERS, *_linked("url")[:3], body="SELECT cluster_id, pos, title, url FROM links"
        ),
        "digest_html": with_items(
            DOC_CLUSTERS, _COUNTS, _TOP, *_SPLIT, *_linked(marked), *_HTML, body="SELECT topic, section, html FROM report"
        ),
        "write_digest": with_items(
            DOC_CLUSTERS, _COUNTS, _TOP, *_SPLIT, *_linked(marked), *_HTML,
            body="SELECT unnest(string_split(html, chr(10))) AS value FROM report",
        ),
        "digest_table": with_items(
            DOC_CLUSTERS, _COUNTS, _TOP, *_SPLIT, *_linked(marked),
            body=_DIGEST_ROWS,
        ),
    }


_DIGEST_ROWS = f"""SELECT topic, CAST(total AS BIGINT) AS topic_total, rank, cluster_id, size,
                round(CAST(score AS DOUBLE), 3) AS score, {joined('bullets')} AS bullets, entities, tone,
                {joined('shown')} AS links, coalesce(n_items, 0) AS n_items
                FROM top JOIN counts USING (topic) JOIN split_done USING (cluster_id) JOIN tones USING (cluster_id)
                LEFT JOIN per USING (cluster_id) LEFT JOIN found USING (cluster_id)"""


def _whole_run() -> str:
    """Tags, labels, roll-up, summaries of the clusters shown, and the digest, each from the one before."""
    grouped = rollup("label", AS_OF, "fresh").replace("FROM items)", "FROM tagged_items)")
    of_shown = "wanted AS (SELECT cluster_id, unnest(reps) AS id, generate_subscripts(reps, 1) - 1 AS pos FROM shown)"
    inner = ", ".join
    return with_items(
        f"""tagged AS (WITH {inner([*EVIDENCE, *SCORES])} SELECT id, {KEPT.format(t=UNION)} AS topics
            FROM evidence LEFT JOIN near USING (id))""",
        f"labels AS (WITH {inner([*_TOKENS, *_kmeans()])} SELECT id, label FROM keyed JOIN l{KMEANS_ROUNDS} USING (point))",
        """tagged_items AS (SELECT id, ts, tagged.topics, label FROM items JOIN tagged USING (id) JOIN labels USING (id))""",
        f"grouped AS (WITH {grouped} SELECT * FROM fresh)",
        f"shown AS (WITH clusters AS (SELECT * FROM grouped), {_COUNTS}, {_TOP} SELECT * FROM top)",
        f"""done_all AS (WITH {inner([of_shown, _REPS[2], *_CONTEXT[3:], *_SENTENCES, *_FACTS, *_formatted(True)])}
            SELECT * FROM done)""",
        "clusters AS (SELECT g.* EXCLUDE summary, d.summary FROM grouped g LEFT JOIN done_all d USING (cluster_id))",
        _COUNTS, _TOP, *_SPLIT, *_linked("url"),
        body=_DIGEST_ROWS,
    )


def _store() -> dict[str, str]:
    """The store holds the same table, however it is divided and versioned."""
    plain = _tables()
    same = {
        "store_insert": "items_insert",
        "store_update": "enrich_update",
        "store_compact": "enrich_update",
        "store_recent": "scan_recent",
        "store_retain": "retain_recent",
    }
    keyed = f"SELECT * FROM ({plain['stream_items']}) WHERE regexp_extract(url, '([0-9]+)$', 1)::BIGINT % 3 <> 0"
    return {"stream_items_keyed": keyed, **{name: plain[twin] for name, twin in same.items()}}


def all_sql() -> dict[str, str]:
    parts = (_tagging(), _language(), _tables(), _store(), _text(), _clustering(), _summaries(), _digest())
    return {"run_resumed": _whole_run(), **{name: sql for part in parts for name, sql in part.items()}}
