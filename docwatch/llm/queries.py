"""The queries of this subpackage and the SQL they must equal, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docwatch.llm import centroids, exact_dedup, lexical_search, maxent_lm, minhash, mixing, packing, quality_rules
from docwatch.llm import sharding, substring_dedup, token_counts, url_filter, vector_packing
from docwatch.session import fresh_path, materialize

SHARDS = 16


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


URL_RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]


#: What of a page's markup isn't its text: comments, whole elements of these names, other tags.
#: What isn't closed reaches to the end of the page, so that no start is searched for in vain.
NOT_TEXT = r"(?is)<!--.*?(?:-->|\z)|<(head|script|style|nav|header|footer|aside)\b.*?(?:</\1\s*>|\z)|<[^>]*(?:>|\z)"


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by rules and, where none fits, by boosted trees.

    The trees learn from labels of the pages themselves, see :func:`page_labels`.
    """
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    # written first: the planner would copy the steps of the counts into every filter on a label
    labels = materialize(page_labels(pages), "page-labels")
    judged = url_filter.judge_urls(pages.select("page_id", "url"), labels, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "bad_score")


def page_labels(pages: DataFrame) -> DataFrame:
    """``url, bad`` of every page: a fitting rule's verdict, else the base rules on its own text.

    The labels table isn't used: its ids are those of documents, not of pages.
    """
    rule = url_filter.matched_rule(url_filter.url_host(F.col("url")), url_filter.url_path(F.col("url")), URL_RULES)
    ruled = F.when(rule["verdict"] == "block", 1).when(rule["verdict"] == "allow", 0)
    text = F.when(ruled.isNull(), F.regexp_replace("html", NOT_TEXT, " "))
    counted = quality_rules.with_text_counts(pages.select("url", ruled.alias("ruled"), text.alias("text")))
    failed = quality_rules.base_failed(quality_rules.Limits()).cast("int")
    return counted.select("url", F.coalesce("ruled", failed).alias("bad"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the sources' target shares; one row per document."""
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and cross-document line frequency; one row per document."""
    return quality_rules.judge(documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts; one row per document."""
    return exact_dedup.assign_copies(documents(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences; one row per piece."""
    return packing.pack(documents(spark, sf_dir), packing.public_encoder())


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages found earlier in the corpus; one row per document.

    ``kept`` says that the whole text stays. ``removed`` lists ``start+length`` of what
    went, in code points of the original text.
    """
    left = substring_dedup.without_passages(documents(spark, sf_dir).select("doc_id", "text"))
    spans = F.transform("removed", lambda s: F.concat_ws("+", s["start"], s["length"]))
    lost = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return left.select("doc_id", "kept", lost.alias("removed_chars"), F.array_join(spans, " ").alias("removed"), "text")


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near duplicates on sets of two-word shingles; one row per document."""
    return minhash.near_groups(documents(spark, sf_dir), minhash.MinHash(width=2))


def op8_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every text under the trained model and the unigram base."""
    return maxent_lm.score_texts(documents(spark, sf_dir))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals after three batches: all inserts, revised counts, deleted copies.

    The revision counts a text without its repeated lines; the deletion takes back
    every row but the smallest id of equal texts. The first batch is sent twice.
    Texts are read once, for a narrow table of counts.
    """
    path = fresh_path(spark, "token-store")
    text = F.coalesce("text", F.lit(""))
    old = token_counts.word_count(text)
    new = token_counts.word_count(F.array_join(F.array_distinct(F.split(text, "\n")), "\n"))
    counted = documents(spark, sf_dir).select(
        "doc_id", "source", "lang", F.md5(text).alias("text_key"), old.alias("old"), new.alias("new")
    )
    counted = materialize(counted, "counted")
    load = token_counts.inserts(counted, "words/1", F.col("old"))
    token_counts.commit(load, path, "1-load")
    token_counts.commit(load, path, "1-load")
    change = ["source", "lang", F.lit("words/1").alias("tokenizer")]
    revised = counted.select(F.lit("revise").alias("change"), *change, F.col("old").alias("old_tokens"), F.col("new").alias("new_tokens"))
    token_counts.commit(revised, path, "2-repeated-lines")
    first = counted.groupBy("text_key").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1")
    # a table of its own, so that the join can be split where one text has very many copies
    first = materialize(first.drop("n"), "first-copies")
    copies = counted.join(first, "text_key").filter("doc_id > first_id")
    gone = copies.select(F.lit("delete").alias("change"), *change, F.col("new").alias("old_tokens"), F.lit(None).cast("long").alias("new_tokens"))
    token_counts.commit(gone, path, "3-copies")
    return token_counts.totals(spark, path)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes, by virtual slots."""
    rows, slot_map = sharding.shard_documents(documents(spark, sf_dir), SHARDS)
    sharding.save_map(slot_map, spark, fresh_path(spark, "slot-maps"))
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def op11_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of as few sequences as vector best fit needs; one row per piece."""
    return vector_packing.pack(documents(spark, sf_dir), packing.public_encoder())


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of each benchmark item."""
    index = lexical_search.build_index(documents(spark, sf_dir))
    return lexical_search.search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster after three rounds, and how tight the clusters are."""
    return centroids.cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_mixing,
        op3_quality_rules,
        op4_exact_dedup,
        op5_packing,
        op6_substring_dedup,
        op7_minhash,
        op8_maxent_lm,
        op9_token_counts,
        op10_sharding,
        op11_vector_packing,
        op12_lexical_search,
        op13_centroids,
    )
}

WORD_LIST = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SQL: dict[str, str] = {}

SQL["op3_quality_rules"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
                  md5(coalesce(text, '')) AS k, {WORD_LIST} AS w
           FROM documents),
wide AS (SELECT r, i, list_aggregate(w[i : i + 4], 'string_agg', chr(10)) AS span
         FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, span) AS n FROM wide) WHERE n > 1),
covered AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(i, i + 5)) AS at FROM twice) GROUP BY r),
raw AS (SELECT r, host, k, unnest(string_split(t, chr(10))) AS line FROM d),
lines AS (SELECT r, host, k, line,
                 regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'),
                                '^ ', ''), ' $', ''), '[0-9]+', '0', 'g') AS norm
          FROM raw),
filled AS (SELECT *, len(string_split(norm, ' ')) AS lw FROM lines WHERE norm <> ''),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM filled GROUP BY r),
texts AS (SELECT host, count(DISTINCT k) AS n_texts FROM filled GROUP BY host),
spread AS (SELECT host, norm, count(DISTINCT k) AS n FROM filled GROUP BY host, norm),
common AS (SELECT host, norm FROM spread JOIN texts USING (host) WHERE n > 4 AND n > 0.02::DOUBLE * n_texts),
lost AS (SELECT f.r, sum(CASE WHEN c.norm IS NULL THEN 0 ELSE lw END)::DOUBLE / sum(lw) AS share
         FROM filled f LEFT JOIN common c ON f.host = c.host AND f.norm = c.norm GROUP BY f.r),
counted AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(list_aggregate(w, 'string_agg', ''))::BIGINT AS wc,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dups.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         coalesce(lost.share, 0.0) AS lost_share
  FROM d LEFT JOIN covered USING (r) LEFT JOIN dups USING (r) LEFT JOIN lost USING (r))
SELECT doc_id, n_words, coalesce(wc, 0)::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_share,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND lost_share <= 0.5 AS kept
FROM counted
"""

SQL["op4_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM (SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
             first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id FROM d)
"""

SQL["op6_substring_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
parts AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, regexp_extract_all(text, '[\x20\x09-\x0D]+') AS g,
                 regexp_matches(text, '^[\x20\x09-\x0D]')::INT AS lead FROM d WHERE text IS NOT NULL),
words AS (SELECT r, i, w[i] AS word,
                 CASE WHEN i + lead - 1 >= 1 THEN g[i + lead - 1] ELSE '' END AS gap
          FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM parts)),
placed AS (SELECT r, i, lower_word, length(word) AS n,
                  sum(length(gap) + length(word)) OVER w - length(word) AS start,
                  sum(length(gap) - length(replace(gap, chr(10), ''))) OVER w AS line_no,
                  coalesce(sum((md5(lower_word) < '33')::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS phrase_no
           FROM (SELECT *, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_word FROM words)
           WINDOW w AS (PARTITION BY r ORDER BY i)),
units AS (
  SELECT 0 AS kind, r, line_no AS no, string_agg(lower_word, ' ' ORDER BY i) AS u, count(*) AS n_words, min(start) AS start, max(start + n) AS stop
  FROM placed GROUP BY r, line_no
  UNION ALL
  SELECT 1, r, phrase_no, string_agg(lower_word, ' ' ORDER BY i), count(*), min(start), max(start + n) FROM placed GROUP BY r, phrase_no),
numbered AS (SELECT units.*, doc_id, row_number() OVER (PARTITION BY units.r, kind ORDER BY no) AS place
             FROM units JOIN d USING (r) WHERE kind = 0 OR n_words >= 3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY kind, u ORDER BY doc_id, place) AS nth FROM numbered),
again AS (SELECT *, place - row_number() OVER (PARTITION BY r, kind ORDER BY place) AS run FROM ranked WHERE nth > 1),
runs AS (SELECT r, min(start) AS start, max(stop) AS stop FROM again GROUP BY r, kind, run HAVING sum(n_words) >= 30),
joined AS (SELECT *, sum(opens) OVER (PARTITION BY r ORDER BY start, stop) AS span
           FROM (SELECT *, CASE WHEN start <= max(stop) OVER (PARTITION BY r ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                                THEN 0 ELSE 1 END AS opens FROM runs)),
spans AS (SELECT r, min(start)::BIGINT AS start, max(stop)::BIGINT AS stop FROM joined GROUP BY r, span),
gone AS (SELECT r, list(start ORDER BY start) AS a, list(stop ORDER BY start) AS b FROM spans GROUP BY r)
SELECT doc_id, a IS NULL AS kept,
       coalesce(list_sum(list_transform(range(1, len(a) + 1), lambda i: b[i] - a[i])), 0)::BIGINT AS removed_chars,
       coalesce(array_to_string(list_transform(range(1, len(a) + 1), lambda i: a[i] || '+' || (b[i] - a[i])), ' '), '') AS removed,
       CASE WHEN a IS NULL THEN text ELSE
         array_to_string(list_transform(range(0, len(a) + 1), lambda i:
           substring(text, (CASE WHEN i = 0 THEN 0 ELSE b[i] END + 1)::BIGINT,
                     ((CASE WHEN i = len(a) THEN length(text) ELSE a[i + 1] END) - (CASE WHEN i = 0 THEN 0 ELSE b[i] END))::BIGINT)), '') END AS text
FROM d LEFT JOIN gone USING (r)
"""

SQL["op9_token_counts"] = rf"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS text, md5(coalesce(text, '')) AS k FROM documents),
lines AS (SELECT doc_id, k, unnest(string_split(text, chr(10))) AS line FROM d),
once AS (SELECT doc_id, sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')))::BIGINT AS n
         FROM (SELECT DISTINCT doc_id, line FROM lines) GROUP BY doc_id),
kept AS (SELECT min(doc_id) AS doc_id FROM d GROUP BY k)
SELECT source, lang, 'words/1' AS tokenizer, count(*)::BIGINT AS docs, sum(n)::BIGINT AS tokens
FROM d JOIN kept USING (doc_id) JOIN once USING (doc_id) GROUP BY source, lang
"""

SQL["op7_minhash"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
         ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM d),
distinct_sets AS (SELECT list_sort(s) AS s, min(doc_id) AS node, len(any_value(s)) AS n FROM sets WHERE len(s) > 0 GROUP BY 1),
items AS (SELECT node, n, unnest(s) AS x FROM distinct_sets),
links AS (
  SELECT a.node AS u, b.node AS v
  FROM items a JOIN items b ON a.x = b.x AND a.node < b.node
       AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT node, node AS seen FROM distinct_sets UNION SELECT reach.node, v FROM reach JOIN both_ways ON seen = u),
parts AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
SELECT sets.doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(component, sets.doc_id) AS component_id,
       coalesce(component, sets.doc_id) = sets.doc_id AS kept
FROM sets LEFT JOIN distinct_sets ON list_sort(sets.s) = distinct_sets.s LEFT JOIN parts USING (node)
"""

SQL["op12_lexical_search"] = r"""
WITH lowered AS (
  SELECT 'd' AS kind, doc_id AS id, row_number() OVER () AS r,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'b', item_id, 0, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
terms AS (SELECT kind, id, r, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM lowered),
tfs AS (SELECT r, id AS doc_id, term, count(*) AS tf FROM terms WHERE kind = 'd' GROUP BY ALL),
docs AS (SELECT r, sum(tf)::BIGINT AS n FROM tfs GROUP BY r),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM tfs, whole GROUP BY term, n_docs),
asked AS (SELECT DISTINCT id AS item_id, term FROM terms WHERE kind = 'b'),
scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN docs USING (r), whole GROUP BY item_id, r, doc_id),
ranked AS (SELECT item_id, doc_id, score,
                  row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def _kmeans_sql(rounds: int, k: int) -> str:
    """The rounds as steps of one WITH: labels from centroids, centroids from labels."""
    apart = "list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT"
    floor_mean = "((s - ((s % n) + n) % n) // n)::BIGINT"
    steps = [
        """p AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
               FROM embeddings WHERE len(embedding) = 64
               AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"""c0 AS (SELECT row_number() OVER (ORDER BY h, v) - 1 AS cluster, v AS c
                FROM (SELECT sha256('1:' || vec_id) AS h, v FROM p ORDER BY h, v LIMIT {k}))""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""l{i} AS (SELECT r, first(cluster ORDER BY distance, cluster) AS cluster, min(distance) AS distance
                  FROM (SELECT r, cluster, {apart} AS distance FROM p, c{i}) GROUP BY r)"""
        )
        if i < rounds:
            steps.append(
                f"""m{i} AS (SELECT cluster, list({floor_mean} ORDER BY i) AS c
                      FROM (SELECT cluster, i, sum(v[i])::BIGINT AS s, count(*) AS n
                            FROM (SELECT cluster, v, unnest(range(1, 65)) AS i FROM l{i} JOIN p USING (r))
                            GROUP BY cluster, i) GROUP BY cluster),
                c{i + 1} AS (SELECT cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))"""
            )
    return f"""WITH {", ".join(steps)}
    SELECT vec_id, cluster::INT AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
           sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM l{rounds} JOIN p USING (r) JOIN c{rounds} USING (cluster)"""


SQL["op13_centroids"] = _kmeans_sql(3, 16)
