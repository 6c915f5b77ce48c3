"""Scans of the items and clusters tables, and their next snapshots.

Parquet has no MERGE, so every update gives the whole next snapshot; write it
to a new path and switch readers over (never over the path being read).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docwatch.session import instant

LOOKBACK_HOURS = 36
PENDING_LIMIT = 2000


def since(as_of: datetime, hours: int = LOOKBACK_HOURS) -> Column:
    return instant(as_of) - F.expr(f"INTERVAL '{int(hours)}' HOUR")


def is_pending() -> Column:
    return F.col("lang").isNull() | F.col("topics").isNull()


def scan_pending(items: DataFrame, limit: int | None = PENDING_LIMIT) -> DataFrame:
    """The newest ``limit`` items still to enrich, in order; ``limit=None`` gives all, unordered."""
    pending = items.filter(is_pending())
    if limit is None:
        return pending
    return pending.orderBy(F.col("ts").desc(), "id").limit(limit)


def scan_recent(items: DataFrame, as_of: datetime, hours: int = LOOKBACK_HOURS) -> DataFrame:
    """``id, content, topics, ts`` of the look-back window."""
    content = F.concat(
        F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("text", F.lit(""))
    )
    recent = items.filter(F.col("ts") >= since(as_of, hours))
    return recent.select("id", content.alias("content"), "topics", "ts")


def retain_recent(items: DataFrame, as_of: datetime, hours: int = LOOKBACK_HOURS) -> DataFrame:
    """What stays in the next snapshot; ``hours=0`` empties the table."""
    if hours <= 0:
        return items.filter(F.lit(False))
    return items.filter(F.col("ts") >= since(as_of, hours))


def url_key() -> Column:
    """The url, or a key of its own for rows without one (they never collide)."""
    return F.coalesce(
        F.concat(F.lit("url "), F.col("url")), F.concat(F.lit("id "), F.col("id"))
    )


def row_digest(rows: DataFrame) -> Column:
    """A digest of the row's columns, in the order of their names."""
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in sorted(rows.columns)])))


def new_items(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows whose id and url are new, the first per id and per url.

    First is the smallest ``(ts, id)``, then the smallest digest of the row. Winners
    are found on ids, urls, times and digests alone; minima combine before each
    shuffle, so a key with a large share of the rows costs a row per partition. The
    rows themselves, with their texts, are shuffled once, by id. The id is a hash
    that covers the url, so rows with one id share their url and the two steps don't
    interfere.
    """
    marked = with_digest(incoming)
    return winning_rows(marked, winners(existing, marked))


def with_digest(incoming: DataFrame) -> DataFrame:
    return incoming.withColumn("_digest", row_digest(incoming))


def winners(existing: DataFrame, marked: DataFrame) -> DataFrame:
    """``id, _won``: the rows of :func:`new_items` by id and digest."""
    narrow = marked.select("id", url_key().alias("url_key"), F.struct("ts", "id", "_digest").alias("rank"))
    by_id = narrow.groupBy("id").agg(F.min(F.struct("rank", "url_key")).alias("first"))
    fresh = by_id.join(existing.select("id"), "id", "left_anti").select("first.*")
    taken = existing.filter(F.col("url").isNotNull()).select(url_key().alias("url_key"))
    unseen = fresh.join(taken, "url_key", "left_anti")
    first = unseen.groupBy("url_key").agg(F.min("rank").alias("rank"))
    return first.select(F.col("rank.id").alias("id"), F.col("rank._digest").alias("_won"))


def winning_rows(marked: DataFrame, won: DataFrame) -> DataFrame:
    """The rows of ``marked`` that are in ``won``, one of equal ones.

    An id is in ``won`` once; both keys of the join are named, so that its rows aren't shuffled again.
    """
    rows = marked.join(won, "id").filter(F.col("_digest") == F.col("_won"))
    return rows.dropDuplicates(["id", "_digest"]).drop("_digest", "_won")


def items_insert(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """The items table after inserting; conflicting rows change nothing."""
    added = new_items(existing, incoming).select(existing.columns)
    return existing.unionByName(added)


def enrich_update(items: DataFrame, enriched: DataFrame) -> DataFrame:
    """Set lang, lang_conf, topics and keywords of the rows in ``enriched``.

    Lists are never NULL afterwards for updated rows. Everything the update
    doesn't touch stays as it was.
    """
    fields = ("lang", "lang_conf", "topics", "keywords")
    new = enriched.select(
        "id", F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in fields]
    )
    none = F.array().cast("array<string>")

    def value(c: str) -> Column:
        if c not in fields:
            return F.col(c)
        fresh = F.col(f"_new_{c}")
        if c in ("topics", "keywords"):
            fresh = F.coalesce(fresh, none)
        kind = items.schema[c].dataType
        return F.when(F.col("_hit"), fresh.cast(kind)).otherwise(F.col(c)).alias(c)

    return items.join(new, "id", "left").select(*[value(c) for c in items.columns])


def clusters_upsert(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Insert clusters, or refresh the ones already stored.

    A refresh replaces end_ts, size and representatives, keeps the larger
    score, and leaves topic, start_ts and summary alone.
    """
    s, n = stored.alias("s"), fresh.alias("n")
    joined = s.join(n, F.col("s.cluster_id") == F.col("n.cluster_id"), "full_outer")
    replaced = ("end_ts", "size", "rep_item_ids")

    def value(c: str) -> Column:
        old, new = F.col(f"s.{c}"), F.col(f"n.{c}")
        if c in replaced:
            picked = F.when(F.col("n.cluster_id").isNotNull(), new).otherwise(old)
        elif c == "score":
            picked = F.greatest(old, new)
        elif c == "cluster_id":
            picked = F.coalesce(old, new)
        else:
            picked = F.when(F.col("s.cluster_id").isNotNull(), old).otherwise(new)
        return picked.alias(c)

    return joined.select(*[value(c) for c in stored.columns])


def summary_update(clusters: DataFrame, summaries: DataFrame) -> DataFrame:
    """Store each summary in ``summaries(cluster_id, summary)`` on its cluster."""
    new = summaries.select("cluster_id", F.col("summary").alias("_summary"))
    return clusters.join(new, "cluster_id", "left").select(
        *[
            F.coalesce("_summary", "summary").alias("summary") if c == "summary" else F.col(c)
            for c in clusters.columns
        ]
    )
