"""Every registered query: ``(spark, sf_dir) -> DataFrame`` over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixture as fx
from docwatch.functions import text as tx
from docwatch.functions.arrays import explode_rows
from docwatch.operators import collect, digest, features, language, language_profiles, quality, rollup
from docwatch.operators import summaries as sm
from docwatch.operators import tables, tagging
from docwatch.operators.kmeans import cluster_tfidf
from docwatch.operators.linkage import cluster_embeddings, similarity_components
from docwatch.plans import stages
from docwatch.plans.run_log import RunLog
from docwatch.schema import CLUSTERS
from docwatch.session import fresh_path, materialize
from docwatch.sources import config
from docwatch.sources.feeds import read_feed_entries
from docwatch.sources.store import ItemStore
from docwatch.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def joined(column: str) -> F.Column:
    """An array as one string, so that both engines hash it alike."""
    return F.concat_ws("|", column).alias(column)


def epoch(column: str) -> F.Column:
    return F.unix_seconds(column).alias(column)


def rounded(column: str, digits: int = 6) -> F.Column:
    return F.round(F.col(column).cast("double"), digits).alias(column)


# ---- flagship ---------------------------------------------------------------


@query
def items_per_topic(spark, sf_dir):
    """Items per topic by the keyword rule."""
    tags = tagging.tag_keywords(fx.plain_items(spark, sf_dir), fx.BOOK)
    exploded = explode_rows(tags, [], F.col("topics"), "topic")
    return exploded.groupBy("topic").agg(F.count("*").alias("n_items"))


# ---- scans, sources, upserts ------------------------------------------------


def _landed_feeds(spark, sf_dir) -> str:
    path = fresh_path(spark, "feeds")
    fx.feed_xml(spark, sf_dir).write.partitionBy("dialect", "feed").text(path)
    return path


@query
def read_feed_entries_(spark, sf_dir):
    entries = read_feed_entries(spark, _landed_feeds(spark, sf_dir))
    return entries.select(
        "id", "link", "title", "published", "updated", "summary", F.size("links").alias("n_links"),
        F.col("corrupt").isNotNull().alias("is_corrupt"),
    )


def _source_tables(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    scheme = F.when(F.col("page_id") % 9 == 0, F.replace("url", F.lit("http"), F.lit("ftp"))).otherwise(F.col("url"))
    padded = F.when(F.col("page_id") % 10 == 1, F.concat(F.lit(" "), scheme, F.lit("\n"))).otherwise(scheme)
    rss = pages.select(F.col("page_id").alias("ord"), padded.alias("url"))
    docs = fx.table(spark, sf_dir, "documents")
    kind = F.when(F.col("lang") == "en", "subs").when(F.col("lang") == "de", "search_rss").otherwise("per_sub_search")
    nested = docs.select(
        kind.alias("kind"), F.col("doc_id").alias("ord"),
        F.when(F.col("n_chars") % 17 == 0, "").otherwise(F.concat(F.lit("reddit:"), "source", F.lit("/"), "lang")).alias("url"),
    )
    again = pages.select(F.lit("subs").alias("kind"), F.col("page_id").alias("ord"), "url")
    return rss, nested.union(again)


@query
def feed_sources(spark, sf_dir):
    return config.feed_sources(*_source_tables(spark, sf_dir))


@query
def only_http_sources(spark, sf_dir):
    return config.only_http_sources(_source_tables(spark, sf_dir)[0])


@query
def dropped_sources(spark, sf_dir):
    return config.dropped_sources(_source_tables(spark, sf_dir)[0])


@query
def items_insert(spark, sf_dir):
    """Half of the items stored; all arrive again, with changed ids and urls."""
    rows = fx.plain_items(spark, sf_dir)
    number = F.col("id").cast("long")
    stored = rows.filter(F.pmod(number, F.lit(2)) == 0)
    renamed = rows.withColumns({"id": F.concat(F.lit("x"), "id"), "ts": F.col("ts") + F.expr("INTERVAL 1 HOUR")})
    incoming = rows.union(renamed).union(rows.withColumn("ts", F.col("ts") + F.expr("INTERVAL 2 HOURS")))
    result = tables.items_insert(stored, incoming)
    return result.select("id", "url", epoch("ts"), "title", "text")


@query
def scan_pending(spark, sf_dir):
    rows = fx.items(spark, sf_dir)
    partly = rows.withColumn("lang", F.when(F.col("true_lang") == "en", F.col("true_lang")))
    return tables.scan_pending(partly, limit=2000).select("id", epoch("ts"), "title")


@query
def enrich_update(spark, sf_dir):
    rows = fx.items(spark, sf_dir)
    done = rows.filter(F.col("true_lang") != "en").select(
        "id", F.col("true_lang").alias("lang"), F.lit(0.5).alias("lang_conf"),
        F.when(F.col("true_lang") == "de", F.array("src")).alias("topics"), F.array("title").alias("keywords"),
    )
    return tables.enrich_update(rows.drop("true_lang"), done).select(
        "id", "lang", rounded("lang_conf"), joined("topics"), joined("keywords")
    )


@query
def scan_recent(spark, sf_dir):
    return tables.scan_recent(fx.plain_items(spark, sf_dir), fx.AS_OF).select(
        "id", "content", joined("topics"), epoch("ts")
    )


@query
def retain_recent(spark, sf_dir):
    return tables.retain_recent(fx.plain_items(spark, sf_dir), fx.AS_OF).select("id", epoch("ts"), "title")


def _cluster_columns(frame):
    return frame.select(
        "cluster_id", "topic", epoch("start_ts"), epoch("end_ts"), "size", rounded("score", 3),
        "summary", joined("rep_item_ids"),
    )


@query
def clusters_upsert(spark, sf_dir):
    return _cluster_columns(
        tables.clusters_upsert(fx.stored_clusters(spark, sf_dir), fx.fresh_clusters(spark, sf_dir))
    )


@query
def summary_update(spark, sf_dir):
    clusters = fx.document_clusters(spark, sf_dir)
    labels = fx.table(spark, sf_dir, "labels")
    new = labels.select(
        F.col("doc_id").cast("string").alias("cluster_id"),
        F.concat(F.lit("- quality "), F.col("quality").cast("string")).alias("summary"),
    )
    return tables.summary_update(clusters, new).select("cluster_id", "topic", "size", "summary")


@query
def check_items(spark, sf_dir):
    rows = fx.items(spark, sf_dir)
    number = F.col("id").cast("long")
    broken = rows.withColumns(
        {
            "lang_conf": (F.length("text") % 150 / 100).cast("float"),
            "src": F.when(number % 19 > 0, F.col("src")),
            "url": F.coalesce("url", "src"),
            "topics": F.when(number % 23 > 0, F.col("topics")),
            "id": F.when(number % 29 > 0, F.col("title")),
        }
    )
    return quality.check_items(broken)


@query
def check_clusters(spark, sf_dir):
    clusters = fx.document_clusters(spark, sf_dir)
    return quality.check_clusters(clusters.withColumn("cluster_id", F.substring("cluster_id", 1, 3)))


# ---- the store ----------------------------------------------------------------


def _store(spark, sf_dir, rows) -> ItemStore:
    store = ItemStore(spark, fresh_path(spark, "store"))
    store.insert(rows)
    return store


@query
def store_insert(spark, sf_dir):
    """As items_insert: half of the items first, then all with changed ids and urls."""
    rows = fx.plain_items(spark, sf_dir)
    store = _store(spark, sf_dir, rows.filter(F.pmod(F.col("id").cast("long"), F.lit(2)) == 0))
    renamed = rows.withColumns({"id": F.concat(F.lit("x"), "id"), "ts": F.col("ts") + F.expr("INTERVAL 1 HOUR")})
    store.insert(rows.union(renamed).union(rows.withColumn("ts", F.col("ts") + F.expr("INTERVAL 2 HOURS"))))
    return store.items().select("id", "url", epoch("ts"), "title", "text")


def _updated_store(spark, sf_dir) -> ItemStore:
    """Changes in two steps; the second holds where both set a row."""
    rows = fx.items(spark, sf_dir)
    store = _store(spark, sf_dir, rows.drop("true_lang"))
    none = F.lit(None).cast("array<string>")
    foreign = rows.filter(F.col("true_lang") != "en")
    first = {"lang": F.lit("xx"), "lang_conf": F.lit(0.1).cast("float"), "topics": none, "keywords": none}
    store.update(foreign.withColumns(first))
    done = foreign.select(
        "id", "ts", F.col("true_lang").alias("lang"), F.lit(0.5).cast("float").alias("lang_conf"),
        F.when(F.col("true_lang") == "de", F.array("src")).alias("topics"), F.array("title").alias("keywords"),
    )
    store.update(done)
    return store


@query
def store_update(spark, sf_dir):
    return _updated_store(spark, sf_dir).items().select("id", "lang", rounded("lang_conf"), joined("topics"), joined("keywords"))


@query
def store_compact(spark, sf_dir):
    store = _updated_store(spark, sf_dir)
    store.compact()
    store.vacuum(keep=1)
    return store.items().select("id", "lang", rounded("lang_conf"), joined("topics"), joined("keywords"))


@query
def store_recent(spark, sf_dir):
    store = _store(spark, sf_dir, fx.plain_items(spark, sf_dir))
    return tables.scan_recent(store.recent(fx.AS_OF), fx.AS_OF).select("id", "content", joined("topics"), epoch("ts"))


@query
def store_retain(spark, sf_dir):
    store = _store(spark, sf_dir, fx.plain_items(spark, sf_dir))
    store.retain(fx.AS_OF)
    return store.items().select("id", epoch("ts"), "title")


# ---- dictionary -------------------------------------------------------------


def _raw_terms(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    kinds = F.array(*[F.lit(k) for k in config.TERM_KINDS])
    raw = docs.select(
        F.concat(F.lit(" "), "source", F.lit(" ")).alias("topic"),
        F.get(kinds, (F.col("n_chars") % 4).cast("int")).alias("kind"),
        F.col("doc_id").cast("int").alias("ord"),
        F.when(F.col("n_chars") % 31 == 0, F.lit("  "))
        .otherwise(F.concat(F.lit("\t"), F.lower("text"), F.lit(" ")))
        .alias("term"),
    )
    topics = docs.filter(F.col("lang") == "es").select(F.col("source").alias("topic"))
    few = topics.filter(F.col("topic") > "src12")
    return raw, few


@query
def build_terms(spark, sf_dir):
    return config.build_terms(*_raw_terms(spark, sf_dir))


@query
def unknown_terms(spark, sf_dir):
    return config.unknown_terms(*_raw_terms(spark, sf_dir))


# ---- entries and text -------------------------------------------------------


@query
def entries_to_items(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages").select("url", "html")
    rows = collect.entries_to_items(fx.feed_entries(spark, sf_dir), fx.AS_OF, pages)
    return rows.select("id", "src", "url", epoch("ts"), "title", "text")


@query
def short_body_report(spark, sf_dir):
    return collect.short_body_report(fx.plain_items(spark, sf_dir), 400)


@query
def html_to_text(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    return tx.with_html_text(pages, F.col("html"), "text").select("page_id", "text")


@query
def strip_html_tags(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    return pages.select("page_id", tx.strip_html_tags(F.col("html")).alias("text"))


@query
def clean_text_cols(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    return pages.select("page_id", tx.clean_text(F.col("html")).alias("text"))


@query
def normalize_for_match(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    return docs.select("doc_id", tx.normalize_for_match(F.col("text")).alias("text"))


@query
def normalize_leet(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    return docs.select("doc_id", tx.normalize_leet(F.col("text")).alias("text"))


# ---- tagging ----------------------------------------------------------------


@query
def tag_keywords(spark, sf_dir):
    return tagging.tag_keywords(fx.plain_items(spark, sf_dir), fx.BOOK).select("id", joined("topics"))


@query
def tag_min_hits(spark, sf_dir):
    return tagging.tag_keywords(fx.plain_items(spark, sf_dir), fx.BOOK, min_hits=2).select("id", joined("topics"))


@query
def exclude_topics(spark, sf_dir):
    return tagging.exclude_topics(fx.plain_items(spark, sf_dir), fx.BOOK).select("id", joined("excluded"))


@query
def matched_keywords(spark, sf_dir):
    return tagging.matched_keywords(fx.plain_items(spark, sf_dir), fx.BOOK).select("id", joined("keywords"))


def _large_book(spark, sf_dir) -> config.Dictionary:
    """Words and phrases of every document as the terms of its source."""
    # the rest of a text past the last place stays in one piece
    docs = fx.table(spark, sf_dir, "documents").withColumn("words", F.split("text", " ", 17))
    words = F.col("words")
    word = lambda i: F.when(F.get(words, F.lit(i)).rlike("^[A-Za-z]{2,}$"), F.get(words, F.lit(i)))
    parts = [("keyword", word(i)) for i in (1, 2, 3, 4)]
    parts += [("exclude", F.concat(word(9), F.lit(" "), word(10))), ("negative", F.concat(word(14), F.lit(" "), word(15)))]
    listed = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(i).alias("place"), t.alias("term")) for i, (k, t) in enumerate(parts)])
    raw = docs.select(F.col("source").alias("topic"), (F.col("doc_id") * 10).alias("first"), F.explode(listed).alias("t"))
    raw = raw.select("topic", "t.kind", (F.col("first") + F.col("t.place")).cast("int").alias("ord"), "t.term")
    topics = docs.select(F.col("source").alias("topic")).distinct()
    names = [r.topic for r in topics.collect()]
    return config.Dictionary.from_table(names, config.build_terms(raw.filter("term is not null"), topics))


@query
def tag_large_dictionary(spark, sf_dir):
    """A dictionary that grows with the documents, by the automaton."""
    book = _large_book(spark, sf_dir)
    found = tagging.text_evidence(fx.plain_items(spark, sf_dir), book)
    return found.select("id", joined("topics"), joined("keywords"), joined("negatives"))


@query
def anchor_scores(spark, sf_dir):
    scores = tagging.anchor_scores(fx.vectors(spark, sf_dir), fx.anchors(spark, sf_dir))
    return scores.select("id", "topic", rounded("score"))


def _near(spark, sf_dir):
    return tagging.near_topics(fx.vectors(spark, sf_dir), fx.anchors(spark, sf_dir))


@query
def tag_embeddings(spark, sf_dir):
    labels = tagging.tag_keywords(fx.plain_items(spark, sf_dir), fx.BOOK)
    return tagging.tag_embeddings(labels, _near(spark, sf_dir)).select("id", joined("topics"))


@query
def drop_negatives(spark, sf_dir):
    evidence = tagging.text_evidence(fx.plain_items(spark, sf_dir), fx.BOOK)
    kept = tagging.drop_negatives(evidence.select("id", "topics"), evidence, _near(spark, sf_dir))
    return kept.select("id", joined("topics"))


@query
def tag_hybrid(spark, sf_dir):
    tags = tagging.tag_hybrid(
        fx.plain_items(spark, sf_dir), fx.BOOK, fx.vectors(spark, sf_dir), fx.anchors(spark, sf_dir)
    )
    return tags.select("id", joined("topics"), joined("keywords"))


@query
def enrich(spark, sf_dir):
    """Items of three languages are pending; the English ones are done already."""
    rows = fx.items(spark, sf_dir)
    partly = rows.withColumn("lang", F.when(F.col("true_lang") == "en", F.lit("xx"))).drop("true_lang")
    done = stages.enrich(
        partly, fx.BOOK, fx.vectors(spark, sf_dir), fx.anchors(spark, sf_dir), limit=None
    )
    return done.select("id", "lang", rounded("lang_conf", 4), joined("topics"), joined("keywords"))


@query
def enrich_batch(spark, sf_dir):
    """The stage with its limit, whose feature it is to work on the newest pending rows."""
    rows = fx.plain_items(spark, sf_dir)
    done = stages.enrich(rows, fx.BOOK, limit=2000)
    return done.select("id", "lang", joined("topics"), joined("keywords"))


# ---- language ---------------------------------------------------------------


@query
def detect_language(spark, sf_dir):
    found = language.detect_language(fx.plain_items(spark, sf_dir))
    return found.select("id", "lang", rounded("lang_conf"))


@query
def detect_language_profiles(spark, sf_dir):
    counts = language_profiles.count_profiles(fx.table(spark, sf_dir, "documents"))
    profiles = language_profiles.Profiles.from_table(materialize(counts, "profiles"))
    items = fx.plain_items(spark, sf_dir).select("id", tagging.item_text().alias("raw"))
    found = language_profiles.with_profile_language(items, F.col("raw"), profiles)
    return found.select("id", "lang", rounded("lang_conf"))


@query
def prefer_languages(spark, sf_dir):
    rows = fx.items(spark, sf_dir).withColumn("lang", F.col("true_lang"))
    return language.prefer_languages(rows).select("id", "lang", F.col("lang_rank").cast("int").alias("lang_rank"))


# ---- clustering -------------------------------------------------------------


def _all_docs(spark, sf_dir):
    return features.cluster_docs(fx.as_recent(fx.items(spark, sf_dir)))


@query
def cluster_docs(spark, sf_dir):
    return _all_docs(spark, sf_dir).select("id", "content")


@query
def terms_ngrams(spark, sf_dir):
    return features.terms_ngrams(_all_docs(spark, sf_dir))


@query
def df_prune(spark, sf_dir):
    docs = _all_docs(spark, sf_dir)
    return features.df_prune(features.terms_ngrams(docs), docs.count())


@query
def tfidf(spark, sf_dir):
    return features.tfidf_of(_all_docs(spark, sf_dir)).select("id", "term", rounded("weight"))


@query
def choose_k(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    whole = features.choose_k(docs.select(F.lit("all").alias("part"))).withColumn("part", F.lit("all"))
    parts = docs.groupBy("source").agg(F.count("*").alias("n_docs"))
    each = parts.select("n_docs", features.k_for(F.col("n_docs")).alias("k"), F.col("source").alias("part"))
    return whole.unionByName(each)


@query
def cluster_tfidf_(spark, sf_dir):
    """Until labels settle. The SQL has more rounds than the small tables take; those after the last change nothing."""
    return cluster_tfidf(fx.as_recent(fx.items(spark, sf_dir)))


@query
def similarity_components_(spark, sf_dir):
    return similarity_components(fx.vectors(spark, sf_dir), fx.LINK_DISTANCE)


@query
def cluster_embeddings_(spark, sf_dir):
    return cluster_embeddings(fx.vectors(spark, sf_dir), 0.70)


@query
def cluster_rollup(spark, sf_dir):
    return _cluster_columns(fx.fresh_clusters(spark, sf_dir))


@query
def cluster_members(spark, sf_dir):
    rows = fx.items(spark, sf_dir)
    labels = fx.fresh_labels(rows)
    rolled = rollup.rollup_labels(fx.as_recent(rows), labels, fx.AS_OF)
    return rollup.cluster_members(rolled, labels)


# ---- summaries --------------------------------------------------------------


@query
def top_clusters(spark, sf_dir):
    return sm.top_clusters(fx.document_clusters(spark, sf_dir)).select("cluster_id", "size", rounded("score", 3))


@query
def rep_items(spark, sf_dir):
    reps = sm.rep_items(fx.fresh_clusters(spark, sf_dir), fx.plain_items(spark, sf_dir))
    return reps.select("cluster_id", "pos", "id", "title", "url")


def _contexts(spark, sf_dir):
    reps = sm.rep_items(fx.fresh_clusters(spark, sf_dir), fx.plain_items(spark, sf_dir))
    return sm.cluster_context(reps)


@query
def cluster_context(spark, sf_dir):
    return _contexts(spark, sf_dir)


@query
def extractive_summary(spark, sf_dir):
    return sm.extractive_summary(_contexts(spark, sf_dir))


@query
def format_summaries(spark, sf_dir):
    facts = sm.rep_facts(fx.turn_reps(spark, sf_dir))
    return sm.format_summaries(fx.raw_summaries(spark, sf_dir), facts)


@query
def format_summaries_by_line(spark, sf_dir):
    facts = sm.rep_facts(fx.turn_reps(spark, sf_dir))
    return sm.format_summaries(fx.raw_summaries(spark, sf_dir), facts, keep_lines=True)


@query
def entities_fallback(spark, sf_dir):
    return sm.entities_fallback(fx.turn_reps(spark, sf_dir))


@query
def empty_context_summary(spark, sf_dir):
    return sm.empty_context_summary(sm.rep_facts(fx.turn_reps(spark, sf_dir)))


@query
def summarize(spark, sf_dir):
    clusters = fx.fresh_clusters(spark, sf_dir)
    done = sm.summarize(clusters, fx.plain_items(spark, sf_dir))
    return done.select("cluster_id", "topic", "size", "summary")


# ---- digest -----------------------------------------------------------------


@query
def topic_counts(spark, sf_dir):
    return digest.topic_counts(fx.document_clusters(spark, sf_dir), fx.AS_OF)


@query
def top_per_topic(spark, sf_dir):
    clusters = fx.document_clusters(spark, sf_dir)
    top = digest.top_per_topic(clusters, digest.topic_counts(clusters, fx.AS_OF))
    return top.select("topic", "rank", "cluster_id", "size", rounded("score", 3))


@query
def split_summary(spark, sf_dir):
    found = digest.split_summary(fx.document_clusters(spark, sf_dir))
    return found.select("cluster_id", joined("bullets"), "entities")


@query
def tone(spark, sf_dir):
    return digest.tone(fx.document_clusters(spark, sf_dir), fx.linked_items(spark, sf_dir))


@query
def cluster_links(spark, sf_dir):
    reps = sm.rep_items(fx.document_clusters(spark, sf_dir), fx.plain_items(spark, sf_dir))
    return digest.cluster_links(reps)


def _digest(spark, sf_dir):
    return digest.digest_table(fx.document_clusters(spark, sf_dir), fx.linked_items(spark, sf_dir), fx.AS_OF)


@query
def digest_table(spark, sf_dir):
    links = F.transform("links", lambda l: F.concat_ws(" ", l["url"], l["title"]))
    return _digest(spark, sf_dir).select(
        "topic", "topic_total", "rank", "cluster_id", "size", rounded("score", 3), joined("bullets"),
        "entities", "tone", F.concat_ws("|", links).alias("links"), F.col("n_items").cast("int").alias("n_items"),
    )


@query
def digest_html(spark, sf_dir):
    counts = digest.topic_counts(fx.document_clusters(spark, sf_dir), fx.AS_OF)
    return digest.digest_html(_digest(spark, sf_dir), counts, fx.AS_OF)


@query
def write_digest(spark, sf_dir):
    counts = digest.topic_counts(fx.document_clusters(spark, sf_dir), fx.AS_OF)
    html = digest.digest_html(_digest(spark, sf_dir), counts, fx.AS_OF)
    path = digest.write_digest(html, fresh_path(spark, "report"), fx.AS_OF)
    return spark.read.text(path)


# ---- whole run --------------------------------------------------------------


def _run(spark, sf_dir) -> stages.Run:
    rows = fx.plain_items(spark, sf_dir)
    stored = fx.stored_clusters(spark, sf_dir)
    settings = stages.Settings(hours=24 * 31, keep_hours=24 * 25, report_folder=fresh_path(spark, "run-report"))
    return stages.run_stages(
        rows, stored, fx.AS_OF, fx.BOOK, settings=settings,
        entries=fx.feed_entries(spark, sf_dir), pages=fx.table(spark, sf_dir, "pages").select("url", "html"),
        vectors=fx.vectors(spark, sf_dir), anchors=fx.anchors(spark, sf_dir),
    )


@query
def run_stages(spark, sf_dir):
    report = _run(spark, sf_dir).digest
    return report.select("topic", "rank", "cluster_id", "size", rounded("score", 3), joined("bullets"), "entities", "tone")


class _Stopped(RuntimeError):
    pass


class _StopsAfter(RunLog):
    """Ends the run once a stage is finished."""

    last = "labels"

    def stage(self, name, build, *parts):
        written = super().stage(name, build, *parts)
        if name == self.last:
            raise _Stopped
        return written


@query
def run_resumed(spark, sf_dir):
    """All stages after collection, broken off once the labels are there and started again."""
    rows, none = fx.plain_items(spark, sf_dir), spark.createDataFrame([], CLUSTERS)
    root = fresh_path(spark, "run-log")
    inputs = dict(vectors=fx.vectors(spark, sf_dir), anchors=fx.anchors(spark, sf_dir))
    inputs["settings"] = stages.Settings(hours=24 * 31)
    try:
        stages.run_stages(rows, none, fx.AS_OF, fx.BOOK, log=_StopsAfter(spark, root), **inputs)
    except _Stopped:
        pass
    log = RunLog(spark, root)
    report = stages.run_stages(rows, none, fx.AS_OF, fx.BOOK, log=log, **inputs).digest
    assert log.computed == ["rollup", "clusters", "clusters-summarised", "digest"]
    links = F.transform("links", lambda l: F.concat_ws(" ", l["url"], l["title"]))
    return report.select(
        "topic", "topic_total", "rank", "cluster_id", "size", rounded("score", 3), joined("bullets"),
        "entities", "tone", F.concat_ws("|", links).alias("links"), F.col("n_items").cast("int").alias("n_items"),
    )


@query
def run_stats(spark, sf_dir):
    """Counts over the stored clusters by source instead of learned labels."""
    rows = fx.items(spark, sf_dir)
    clusters = fx.fresh_clusters(spark, sf_dir)
    labels = fx.fresh_labels(rows)
    members = rollup.cluster_members(rollup.rollup_labels(fx.as_recent(rows), labels, fx.AS_OF), labels)
    report = digest.top_per_topic(clusters, digest.topic_counts(clusters, fx.AS_OF))
    return stages.run_stats(rows, rows.withColumn("lang", F.col("true_lang")), members, clusters, report)


# ---- streams ----------------------------------------------------------------


def _drain(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there, into a table of the shared folder."""
    spark = stream.sparkSession
    path, state = fresh_path(spark, name), fresh_path(spark, f"{name}-state")
    job = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", state)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query
def stream_items(spark, sf_dir):
    """Both dialects, dealt over several micro-batches into the stored table."""
    feeds = _landed_feeds(spark, sf_dir)
    arrivals = jobs.stream_items(spark, feeds, fx.AS_OF, files_per_batch=8)
    table = fresh_path(spark, "stream-items")
    jobs.store_new_items(arrivals, table, fresh_path(spark, "stream-items-state")).awaitTermination()
    rows = jobs.stored_items(spark, table, arrivals.schema)
    return rows.select("id", "url", epoch("ts"), "title", "text")


@query
def stream_items_keyed(spark, sf_dir):
    """The same by keyed state instead of the stored table; every third item is stored already."""
    feeds = _landed_feeds(spark, sf_dir)
    arrivals = jobs.stream_items(spark, feeds, fx.AS_OF, files_per_batch=8)
    known = collect.entries_to_items(read_feed_entries(spark, feeds), fx.AS_OF).select("id", "url")
    known = known.filter(F.regexp_extract("url", "([0-9]+)$", 1).cast("long") % 3 == 0)
    table = fresh_path(spark, "stream-keyed")
    jobs.store_first_arrivals(arrivals, table, fresh_path(spark, "stream-keyed-state"), known).awaitTermination()
    rows = jobs.stored_items(spark, table, arrivals.schema)
    return rows.select("id", "url", epoch("ts"), "title", "text")


def _item_stream(spark, sf_dir) -> DataFrame:
    """The items as a stream of files, in no order of time."""
    path = fresh_path(spark, "item-files")
    fx.plain_items(spark, sf_dir).write.parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


@query
def stream_tagged(spark, sf_dir):
    rows = _drain(jobs.stream_tagged(_item_stream(spark, sf_dir), fx.BOOK), "stream-tagged")
    return rows.select("id", joined("topics"), joined("keywords"), "lang")


@query
def stream_topic_counts(spark, sf_dir):
    """The batch twin of the stream over all tagged items."""
    tagged = jobs.stream_tagged(fx.plain_items(spark, sf_dir), fx.BOOK)
    counts = jobs.stream_topic_counts(tagged)
    return counts.select(epoch("window_start"), "topic", "n")


@query
def stream_topic_counts_appended(spark, sf_dir):
    """As a stream: only windows that the watermark has passed."""
    tagged = jobs.stream_tagged(_item_stream(spark, sf_dir), fx.BOOK).withWatermark("ts", "36 hours")
    counts = jobs.stream_topic_counts(tagged.select("ts", "topics"))
    return _drain(counts, "stream-counts").select(epoch("window_start"), "topic", "n")


@query
def stream_topic_panes(spark, sf_dir):
    """Items with stored topics, most of them revised by their text; the stream is started
    again when the second half has landed, so that revisions also come before what they revise."""
    path, table, state = (fresh_path(spark, name) for name in ("revisions", "panes", "panes-state"))
    first = fx.plain_items(spark, sf_dir).select("id", "ts", "topics", F.lit(0).cast("long").alias("revision"))
    tagged = jobs.stream_tagged(fx.plain_items(spark, sf_dir), fx.BOOK)
    second = tagged.filter(F.col("id").cast("long") % 3 > 0).select("id", "ts", "topics", F.lit(1).cast("long").alias("revision"))
    both = first.unionByName(second).withColumn("part", F.pmod(F.xxhash64("id", "revision"), F.lit(2)))
    both = materialize(both, "revision-parts")
    for part in (0, 1):
        both.filter(F.col("part") == part).drop("part").write.mode("append").parquet(path)
        arrivals = spark.readStream.schema(first.schema).parquet(path)
        jobs.store_topic_panes(arrivals, table, state).awaitTermination()
    counts = jobs.window_counts(jobs.topic_panes(spark, table))
    return counts.select(epoch("window_start"), "topic", "n")


def all_queries() -> dict[str, Query]:
    return {name.rstrip("_"): fn for name, fn in QUERIES.items()}
