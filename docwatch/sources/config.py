"""Configuration as tables: feed addresses and the term dictionary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docwatch.functions.text import leet_form, match_form, strip
from docwatch.schema import TERMS, TERM_KINDS

# A dictionary is configuration. It travels with the function that matches it and
# every Python worker holds it, so its size is checked before it comes to the driver.
MAX_TERMS = 2_000_000


def feed_sources(rss: DataFrame, reddit: DataFrame) -> DataFrame:
    """All feed addresses, first position kept: plain feeds, then reddit ones.

    ``rss(ord, url)`` are plain feeds. ``reddit(kind, ord, url)`` are the
    flattened nested lists, kind being subs, search_rss or per_sub_search.
    """
    kind_rank = (
        F.when(F.col("kind") == "subs", 1)
        .when(F.col("kind") == "search_rss", 2)
        .otherwise(3)
    )
    merged = only_http_sources(rss).select(F.lit(0).alias("part"), "ord", "url").unionByName(
        reddit.select(kind_rank.alias("part"), "ord", "url")
    )
    return (
        merged.filter(F.col("url") != "")
        .groupBy("url")
        .agg(F.min(F.struct("part", "ord")).alias("first"))
        .select("url", "first.part", "first.ord")
    )


def is_http(url) -> F.Column:
    return F.coalesce(url.rlike(r"(?i)^https?://"), F.lit(False))


def only_http_sources(sources: DataFrame) -> DataFrame:
    """Sources with an http address, trimmed."""
    trimmed = sources.withColumn("url", strip(F.col("url")))
    return trimmed.filter(is_http(F.col("url")))


def dropped_sources(sources: DataFrame) -> DataFrame:
    """The other side of :func:`only_http_sources`, for the report."""
    trimmed = sources.withColumn("url", strip(F.col("url")))
    return trimmed.filter(~is_http(F.col("url")))


def build_terms(raw: DataFrame, topics: DataFrame) -> DataFrame:
    """Trimmed, non-empty, deduplicated terms of known topics, order kept.

    ``raw(topic, kind, ord, term)``; ``topics(topic)``.
    """
    trimmed = raw.select(
        strip(F.col("topic")).alias("topic"), "kind", "ord", strip(F.col("term")).alias("term")
    )
    return (
        trimmed.filter(F.col("term") != "")
        .groupBy("topic", "kind", "term")
        .agg(F.min("ord").alias("ord"))
        .join(topics.select("topic").distinct(), "topic", "left_semi")
        .select("topic", "kind", "ord", "term")
    )


def unknown_terms(raw: DataFrame, topics: DataFrame) -> DataFrame:
    """Entries whose topic is not declared."""
    return (
        raw.select(strip(F.col("topic")).alias("topic"), "kind", "ord", "term")
        .join(topics.select("topic").distinct(), "topic", "left_anti")
        .select("topic", "kind", "ord", "term")
    )


@dataclass(frozen=True)
class TopicTerms:
    """One topic's terms in configured order."""

    topic: str
    keywords: tuple[str, ...] = ()
    negatives: tuple[str, ...] = ()
    excludes: tuple[str, ...] = ()

    def keyword_forms(self) -> list[str]:
        return _forms(self.keywords, match_form)

    def exclude_forms(self) -> list[str]:
        return _forms(self.excludes, match_form)

    def negative_forms(self) -> list[str]:
        return _forms(self.negatives, leet_form)


def _forms(terms: Sequence[str], normal) -> list[str]:
    return list(dict.fromkeys(f for f in map(normal, terms) if f))


@dataclass(frozen=True)
class Dictionary:
    """The whole term dictionary; topics sorted by name."""

    topics: tuple[TopicTerms, ...] = field(default_factory=tuple)

    def __post_init__(self):
        if not self.topics:
            raise ValueError("at least one topic is required")

    @property
    def names(self) -> list[str]:
        return [t.topic for t in self.topics]

    @property
    def size(self) -> int:
        return sum(len(t.keywords) + len(t.negatives) + len(t.excludes) for t in self.topics)

    @classmethod
    def from_lists(
        cls, topics: Sequence[str], lists: Mapping[str, Mapping[str, Sequence[str]]]
    ) -> "Dictionary":
        """``lists[kind][topic]`` is an ordered list of terms."""

        def of(kind: str, topic: str) -> tuple[str, ...]:
            terms = (str(t).strip() for t in lists.get(kind, {}).get(topic, ()) if t is not None)
            return tuple(dict.fromkeys(t for t in terms if t))

        names = sorted({t.strip() for t in topics if t and t.strip()})
        return cls(
            tuple(
                TopicTerms(n, of("keyword", n), of("negative", n), of("exclude", n))
                for n in names
            )
        )

    @classmethod
    def from_table(cls, topics: Sequence[str], terms: DataFrame) -> "Dictionary":
        """Read a terms table (see :func:`build_terms`) of checked size."""
        rows = terms.select(TERMS.fieldNames()).limit(MAX_TERMS + 1).collect()
        if len(rows) > MAX_TERMS:
            raise ValueError(f"a dictionary holds at most {MAX_TERMS} terms")
        lists: dict[str, dict[str, list[str]]] = {kind: {} for kind in TERM_KINDS}
        for row in sorted(rows, key=lambda r: (r.kind, r.topic, r.ord, r.term)):
            lists[row.kind].setdefault(row.topic, []).append(row.term)
        return cls.from_lists(topics, lists)
