"""The stages as one program: collect, enrich, cluster, summarise, report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docwatch.operators.collect import entries_to_items
from docwatch.operators.digest import TOP_PER_TOPIC, digest_html, digest_table, top_per_topic, topic_counts, write_digest
from docwatch.operators.kmeans import cluster_tfidf
from docwatch.operators.language import with_language
from docwatch.operators.language_profiles import Profiles, with_profile_language
from docwatch.operators.linkage import DISTANCE, cluster_embeddings
from docwatch.operators.rollup import cluster_members, rollup_labels
from docwatch.operators.summaries import summaries_for
from docwatch.operators.tables import (
    LOOKBACK_HOURS,
    clusters_upsert,
    enrich_update,
    is_pending,
    items_insert,
    retain_recent,
    scan_pending,
    scan_recent,
    summary_update,
)
from docwatch.operators.tagging import EMBED_THRESHOLD, item_text, tag_hybrid
from docwatch.plans.run_log import NoLog
from docwatch.session import materialize
from docwatch.sources.config import Dictionary
from docwatch.sources.store import ItemStore


def collect(
    items: DataFrame, entries: DataFrame, as_of: datetime, pages: DataFrame | None = None
) -> DataFrame:
    """The items table with the new entries inserted."""
    return items_insert(items, entries_to_items(entries, as_of, pages))


def enriched_rows(
    pending: DataFrame,
    book: Dictionary,
    vectors: DataFrame | None = None,
    anchors: DataFrame | None = None,
    method: str = "hybrid",
    threshold: float = EMBED_THRESHOLD,
    min_hits: int = 1,
    keep: Sequence[str] = (),
    languages: Profiles | None = None,
) -> DataFrame:
    """``id, lang, lang_conf, topics, keywords`` of the pending items.

    Languages come from ``languages``, or from function words where there are none.
    """
    needed = dict.fromkeys(["id", "title", "text", *keep])
    if languages is None:
        guessed = with_language(pending.select(*needed), item_text())
    else:
        guessed = with_profile_language(pending.select(*needed), item_text(), languages)
    kept = [*keep, "lang", "lang_conf"]
    return tag_hybrid(guessed, book, vectors, anchors, method, threshold, min_hits, keep=kept)


def enrich(
    items: DataFrame,
    book: Dictionary,
    vectors: DataFrame | None = None,
    anchors: DataFrame | None = None,
    method: str = "hybrid",
    threshold: float = EMBED_THRESHOLD,
    limit: int | None = None,
    min_hits: int = 1,
    languages: Profiles | None = None,
) -> DataFrame:
    """The items table with language and topics set on pending rows.

    With a limit, the newest pending rows are worked on and written back by id.
    Without one, every row is either pending or done, so the two parts are put
    side by side and no text is joined back.
    """
    args = (book, vectors, anchors, method, threshold, min_hits)
    if limit is not None:
        return enrich_update(items, enriched_rows(scan_pending(items, limit), *args, languages=languages))
    fields = ("lang", "lang_conf", "topics", "keywords")
    others = [c for c in items.columns if c not in fields]
    fresh = enriched_rows(items.filter(is_pending()), *args, keep=others, languages=languages)
    typed = fresh.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in items.schema.fields])
    return items.filter(~is_pending()).unionByName(typed)


@dataclass(frozen=True)
class Clustered:
    clusters: DataFrame
    members: DataFrame


def cluster(
    items: DataFrame,
    stored: DataFrame,
    as_of: datetime,
    vectors: DataFrame | None = None,
    hours: int = LOOKBACK_HOURS,
    distance: float = DISTANCE,
    min_size: int = 3,
    log: NoLog | None = None,
) -> Clustered:
    """Group the look-back and upsert the clusters.

    TF-IDF k-means, or average linkage when ``vectors`` are given.
    """
    log = log or NoLog()
    recent = scan_recent(items, as_of, hours)

    def label() -> DataFrame:
        if vectors is None:
            return cluster_tfidf(recent)
        return cluster_embeddings(vectors.join(recent.select("id"), "id", "left_semi"), distance)

    labels = log.stage("labels", label, as_of, hours, vectors, None if vectors is None else distance)
    rolled = log.stage("rollup", lambda: rollup_labels(recent, labels, as_of, min_size=min_size, hours=hours), min_size)
    return Clustered(
        clusters_upsert(stored, rolled.drop("label")), cluster_members(rolled, labels)
    )


@dataclass(frozen=True)
class Settings:
    """What a run may be told; each is passed to the stage it names."""

    hours: int = LOOKBACK_HOURS
    keep_hours: int | None = None  # older items leave the store first; None keeps all
    enrich_limit: int | None = None
    method: str = "hybrid"
    threshold: float = EMBED_THRESHOLD
    min_hits: int = 1
    languages: Profiles | None = None  # None guesses by function words
    link_vectors: bool = False
    distance: float = DISTANCE
    min_size: int = 3
    per_topic: int = TOP_PER_TOPIC
    report_folder: str | None = None


@dataclass(frozen=True)
class Run:
    """What one run leaves behind; ``report`` is the path of the written report, if any."""

    items: DataFrame
    clusters: DataFrame
    members: DataFrame
    digest: DataFrame
    stats: DataFrame
    report: str | None = None


def summarize_shown(
    clusters: DataFrame,
    items: DataFrame,
    as_of: datetime,
    per_topic: int = TOP_PER_TOPIC,
    raw: DataFrame | None = None,
) -> DataFrame:
    """The clusters table with summaries of exactly the clusters that the report shows."""
    shown = top_per_topic(clusters, topic_counts(clusters, as_of), per_topic)
    return summary_update(clusters, summaries_for(materialize(shown.drop("rank"), "shown"), items, raw))


def run_stages(
    items: DataFrame,
    clusters: DataFrame,
    as_of: datetime,
    book: Dictionary,
    entries: DataFrame | None = None,
    pages: DataFrame | None = None,
    vectors: DataFrame | None = None,
    anchors: DataFrame | None = None,
    raw_summaries: DataFrame | None = None,
    settings: Settings = Settings(),
    log: NoLog | None = None,
) -> Run:
    """All stages in order, each leaving a snapshot in the shared folder.

    With a :class:`RunLog`, stages that an earlier start has finished are read, not computed.
    """
    s, before, log = settings, items, log or NoLog()
    log.note(items, as_of, s.keep_hours)
    stored = items if s.keep_hours is None else retain_recent(items, as_of, s.keep_hours)
    kept = stored
    if entries is not None:
        kept = log.stage("items", lambda: collect(stored, entries, as_of, pages), entries, pages)
    how = (s.method, s.threshold, s.enrich_limit, s.min_hits, s.languages)
    tagged = log.stage(
        "items-enriched", lambda: enrich(kept, book, vectors, anchors, *how), book, vectors, anchors, *how
    )
    return _grouped_and_reported(before, tagged, tagged, clusters, as_of, vectors, raw_summaries, s, log)


def _grouped_and_reported(
    before: DataFrame,
    tagged: DataFrame,
    recent: DataFrame,
    clusters: DataFrame,
    as_of: datetime,
    vectors: DataFrame | None,
    raw_summaries: DataFrame | None,
    s: Settings,
    log: NoLog,
) -> Run:
    """The stages after enrichment; ``recent`` holds the look-back at least."""
    linked = vectors if s.link_vectors else None
    grouped = cluster(recent, clusters, as_of, linked, s.hours, s.distance, s.min_size, log)
    stored = log.stage("clusters", lambda: grouped.clusters, clusters)
    summed = log.stage(
        "clusters-summarised",
        lambda: summarize_shown(stored, tagged, as_of, s.per_topic, raw_summaries),
        s.per_topic,
        raw_summaries,
    )
    report = log.stage("digest", lambda: digest_table(summed, tagged, as_of, s.per_topic))
    path = None
    if s.report_folder is not None:
        html = digest_html(report, topic_counts(summed, as_of), as_of)
        path = write_digest(html, s.report_folder, as_of)
    stats = run_stats(before, tagged, grouped.members, summed, report)
    return Run(tagged, summed, grouped.members, report, stats, path)


def run_store(
    store: ItemStore,
    clusters: DataFrame,
    as_of: datetime,
    book: Dictionary,
    entries: DataFrame | None = None,
    pages: DataFrame | None = None,
    vectors: DataFrame | None = None,
    anchors: DataFrame | None = None,
    raw_summaries: DataFrame | None = None,
    settings: Settings = Settings(),
    log: NoLog | None = None,
) -> Run:
    """:func:`run_stages` on a store: whole days go unread, new items are added, enrichment
    writes narrow changes, and grouping opens the days of the look-back only.

    A second start adds and enriches only what the first didn't, as the store tells; a log
    covers the stages from grouping on, which depend on the items of the look-back.
    """
    s, log = settings, log or NoLog()
    before = store.items(version=store.version())
    if s.keep_hours is not None:
        store.retain(as_of, s.keep_hours)
    if entries is not None:
        store.insert(entries_to_items(entries, as_of, pages))
    pending = scan_pending(store.items(), s.enrich_limit)
    args = (book, vectors, anchors, s.method, s.threshold, s.min_hits)
    store.update(enriched_rows(pending, *args, keep=["ts"], languages=s.languages))
    tagged, recent = store.items(), store.recent(as_of, s.hours)
    log.note(recent)
    return _grouped_and_reported(before, tagged, recent, clusters, as_of, vectors, raw_summaries, s, log)


def run_stats(
    before: DataFrame, items: DataFrame, members: DataFrame, clusters: DataFrame, digest: DataFrame
) -> DataFrame:
    """``stat, value``: the counts of one run, one row each."""

    def count(frame: DataFrame, name: str) -> DataFrame:
        return frame.agg(F.count("*").alias("value")).select(F.lit(name).alias("stat"), "value")

    parts = [
        count(before, "items before"),
        count(items, "items"),
        count(items.filter(F.col("lang").isNotNull()), "items with language"),
        count(items.filter(F.size("topics") > 0), "items with topics"),
        count(members, "items in clusters"),
        count(clusters, "clusters"),
        count(digest, "digest rows"),
    ]
    return reduce(DataFrame.unionByName, parts)
