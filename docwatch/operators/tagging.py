"""Topic tagging: keywords, anchor vectors and negative terms.

Everything that depends on the text alone is computed row by row without a
shuffle. Only the vector scores come from another table; they are reduced to
short topic lists first, so the one join on ``id`` moves narrow rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docwatch.functions.terms import TopicForms, tagger
from docwatch.functions.text import (
    WORD_CLASS,
    fold_rare,
    leet_form,
    leet_text,
    match_text,
    strip,
)
from docwatch.functions.vectors import best_similarity, groups_above
from docwatch.sources.config import Dictionary, TopicTerms

# Fixed values of the matching rule.
LONG_TERM = 6
SOFT_BOUNDARIES = " -/._"
EMBED_THRESHOLD = 0.42
STRONG_MARGIN = 0.05
METHODS = ("hybrid", "keywords", "embedding")

# A dictionary of more terms is matched by one automaton, so that neither the plan
# nor the cost of a text grows with it; the result is the same.
INLINE_TERMS = 64
MAX_ANCHORS = 10_000


def item_text() -> Column:
    """Title and body as one stripped text."""
    return strip(
        F.concat(
            F.coalesce(F.col("title"), F.lit("")),
            F.lit("\n"),
            F.coalesce(F.col("text"), F.lit("")),
        )
    )


def with_match_texts(items: DataFrame) -> DataFrame:
    """Add ``match_text`` and ``leet_text``, the normalised texts of the rules.

    Column by column, so that the text is built once and crosses to Python at
    most once.
    """
    raw = items.withColumn("raw_text", item_text())
    folded = raw.withColumn("folded", fold_rare(F.col("raw_text")))
    return folded.withColumns(
        {
            "match_text": match_text(F.col("raw_text"), F.col("folded")),
            "leet_text": leet_text(F.col("raw_text"), F.col("folded")),
        }
    ).drop("raw_text", "folded")


def is_substring_term(term: str) -> bool:
    return len(term) >= LONG_TERM or any(ch in term for ch in SOFT_BOUNDARIES)


def _edge(char: str, ahead: bool) -> str:
    """A word boundary beside ``char``, spelled out for the Unicode classes."""
    if re.match(r"\w", char):
        return f"(?![{WORD_CLASS}])" if ahead else f"(?<![{WORD_CLASS}])"
    return f"(?=[{WORD_CLASS}])" if ahead else f"(?<=[{WORD_CLASS}])"


def bounded_pattern(term: str) -> str:
    quoted = re.sub(r"([^\w\s])", r"\\\1", term)
    return _edge(term[0], ahead=False) + quoted + _edge(term[-1], ahead=True)


def term_hit(text: Column, term: str) -> Column:
    """One keyword against a normalised text."""
    if is_substring_term(term):
        return text.contains(term)
    return text.contains(term) & text.rlike(bounded_pattern(term))


def any_contained(text: Column, fragments: Sequence[str]) -> Column:
    return reduce(or_, [text.contains(f) for f in fragments]) if fragments else F.lit(False)


def any_term_hit(text: Column, terms: Sequence[str]) -> Column:
    return reduce(or_, [term_hit(text, t) for t in terms]) if terms else F.lit(False)


def hit_count(text: Column, terms: Sequence[str]) -> Column:
    """How many distinct terms hit."""
    if not terms:
        return F.lit(0)
    return F.size(
        F.array_compact(F.array(*[F.when(term_hit(text, t), F.lit(1)) for t in terms]))
    )


def _collect_topics(flags: Iterable[tuple[str, Column]]) -> Column:
    """Names whose flag holds. Names come in sorted, so the result is sorted."""
    picks = [F.when(flag, F.lit(name)) for name, flag in flags]
    return F.array_compact(F.array(*picks))


def is_large(book: Dictionary) -> bool:
    return book.size > INLINE_TERMS


def all_tags(match: Column, leet: Column, book: Dictionary, min_hits: int = 1) -> Column:
    """``topics, excluded, keywords, negatives`` as one struct, by one pass over each text."""
    forms = [
        TopicForms(
            t.topic,
            tuple(t.keyword_forms()),
            tuple(not is_substring_term(f) for f in t.keyword_forms()),
            tuple(t.exclude_forms()),
            tuple(t.negative_forms()),
            tuple((f, k) for f, k in ((leet_form(k), k) for k in t.keywords) if f),
        )
        for t in book.topics
    ]
    return tagger(forms, min_hits)(match, leet)


def keyword_topics(text: Column, book: Dictionary, min_hits: int = 1) -> Column:
    if is_large(book):
        return all_tags(text, F.lit(None).cast("string"), book, min_hits)["topics"]

    def flag(t: TopicTerms) -> Column:
        terms = t.keyword_forms()
        hit = any_term_hit(text, terms) if min_hits <= 1 else hit_count(text, terms) >= min_hits
        excludes = t.exclude_forms()
        return hit & ~any_contained(text, excludes) if excludes else hit

    return _collect_topics((t.topic, flag(t)) for t in book.topics)


def excluded_topics(text: Column, book: Dictionary) -> Column:
    if is_large(book):
        return all_tags(text, F.lit(None).cast("string"), book)["excluded"]
    return _collect_topics((t.topic, any_contained(text, t.exclude_forms())) for t in book.topics)


def negative_topics(leet: Column, book: Dictionary) -> Column:
    if is_large(book):
        return all_tags(F.lit(None).cast("string"), leet, book)["negatives"]
    return _collect_topics((t.topic, any_contained(leet, t.negative_forms())) for t in book.topics)


def matched_terms(leet: Column, topics: Column, book: Dictionary) -> Column:
    """Original spelling of every hit term of the tagged topics, in order; for small dictionaries."""
    def hits(t: TopicTerms) -> Column:
        pairs = [(leet_form(k), k) for k in t.keywords]
        return F.array_compact(F.array(*[F.when(leet.contains(f), F.lit(k)) for f, k in pairs if f]))

    none = F.array().cast("array<string>")
    lists = [
        F.when(F.array_contains(topics, t.topic), hits(t)).otherwise(none)
        for t in book.topics
        if t.keywords
    ]
    return F.array_distinct(F.concat(none, *lists)) if lists else none


def with_text_tags(texts: DataFrame, book: Dictionary, min_hits: int = 1) -> DataFrame:
    """Adds ``topics, keywords, negatives`` to rows with ``match_text`` and ``leet_text``."""
    match, leet = F.col("match_text"), F.col("leet_text")
    if is_large(book):
        found = texts.withColumn("_tags", all_tags(match, leet, book, min_hits))
        return found.withColumns({c: F.col("_tags")[c] for c in ("topics", "keywords", "negatives")}).drop("_tags")
    tagged = texts.withColumn("topics", keyword_topics(match, book, min_hits))
    return tagged.withColumns({"keywords": matched_terms(leet, F.col("topics"), book), "negatives": negative_topics(leet, book)})


def tag_keywords(items: DataFrame, book: Dictionary, min_hits: int = 1) -> DataFrame:
    """``id, topics``: topics with at least ``min_hits`` keyword hits."""
    texts = with_match_texts(items.select("id", "title", "text"))
    return texts.select("id", keyword_topics(F.col("match_text"), book, min_hits).alias("topics"))


def exclude_topics(items: DataFrame, book: Dictionary) -> DataFrame:
    """``id, excluded``: topics the exclude fragments rule out."""
    texts = with_match_texts(items.select("id", "title", "text"))
    return texts.select("id", excluded_topics(F.col("match_text"), book).alias("excluded"))


def text_evidence(
    items: DataFrame, book: Dictionary, min_hits: int = 1, keep: Sequence[str] = ()
) -> DataFrame:
    """What the text alone says: ``id, topics, keywords, negatives, has_text``.

    ``keep`` names further columns of ``items`` to carry along.
    """
    needed = dict.fromkeys(["id", "title", "text", *keep])
    texts = with_match_texts(items.select(*needed))
    tagged = with_text_tags(texts, book, min_hits)
    return tagged.select(
        "id",
        "topics",
        "keywords",
        "negatives",
        (F.col("leet_text") != "").alias("has_text"),
        *[c for c in keep if c != "id"],
    )


def matched_keywords(items: DataFrame, book: Dictionary) -> DataFrame:
    """``id, keywords``: spelling of the terms found for the keyword topics."""
    return text_evidence(items, book).select("id", "keywords")


def _anchor_groups(anchors: DataFrame) -> list[tuple[str, list[list[float]]]]:
    """Anchor vectors per topic, from a configuration-sized table."""
    rows = anchors.select("topic", "vec").limit(MAX_ANCHORS + 1).collect()
    if len(rows) > MAX_ANCHORS:
        raise ValueError(f"at most {MAX_ANCHORS} anchor vectors are supported")
    groups: dict[str, list[list[float]]] = {}
    for row in sorted(rows, key=lambda r: (r.topic, r.vec)):
        groups.setdefault(row.topic, []).append(row.vec)
    return sorted(groups.items())


def with_anchor_scores(vectors: DataFrame, anchors: DataFrame) -> DataFrame:
    """``id, scores``: best cosine per topic; unit-length vectors are expected."""
    groups = _anchor_groups(anchors)
    if not groups:
        return vectors.select("id", F.create_map().cast("map<string,double>").alias("scores"))
    return vectors.select("id", best_similarity(F.col("vec"), groups).alias("scores"))


def anchor_scores(vectors: DataFrame, anchors: DataFrame) -> DataFrame:
    """``id, topic, score``, one row per item and topic."""
    scored = with_anchor_scores(vectors, anchors).select("id", F.explode_outer("scores").alias("topic", "score"))
    return scored.filter(F.col("topic").isNotNull())


def near_topics(
    vectors: DataFrame,
    anchors: DataFrame,
    threshold: float = EMBED_THRESHOLD,
    topics: Sequence[str] | None = None,
) -> DataFrame:
    """``id, near, strong`` for items that reach the threshold for any topic.

    An item with several vectors has the topics of all of them, in one row.
    """
    known = anchors if topics is None else anchors.filter(F.col("topic").isin(list(topics)))
    rows = groups_above(vectors, _anchor_groups(known), threshold, threshold + STRONG_MARGIN)

    def union(name: str) -> Column:
        return F.sort_array(F.array_distinct(F.flatten(F.collect_list(name)))).alias(name)

    return rows.groupBy("id").agg(union("near"), union("strong"))


def tag_embeddings(labels: DataFrame, near: DataFrame) -> DataFrame:
    """``id, topics`` with the near topics added to ``labels(id, topics)``."""
    return labels.join(near.select("id", "near"), "id", "left").select(
        "id",
        F.sort_array(F.array_union("topics", F.coalesce("near", F.array().cast("array<string>")))).alias(
            "topics"
        ),
    )


def drop_negatives(labels: DataFrame, negatives: DataFrame, near: DataFrame) -> DataFrame:
    """Drop labels with a negative hit unless the vector score is strong.

    ``labels(id, topics)``, ``negatives(id, negatives)``, ``near`` as given by
    :func:`near_topics`.
    """
    none = F.array().cast("array<string>")
    return (
        labels.join(negatives.select("id", "negatives"), "id", "left")
        .join(near.select("id", "strong"), "id", "left")
        .select("id", _without_weak("topics", F.coalesce("negatives", none), F.coalesce("strong", none)))
    )


def _without_weak(topics, negatives: Column, strong: Column) -> Column:
    return F.array_except(topics, F.array_except(negatives, strong)).alias("topics")


def tag_hybrid(
    items: DataFrame,
    book: Dictionary,
    vectors: DataFrame | None = None,
    anchors: DataFrame | None = None,
    method: str = "hybrid",
    threshold: float = EMBED_THRESHOLD,
    min_hits: int = 1,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``id, topics, keywords``: (keywords + vectors) minus weak negatives.

    Keywords count for every method; vectors for ``hybrid`` and ``embedding``.
    Without vectors nothing is shuffled. ``keep`` names columns to carry along.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    evidence = text_evidence(items, book, min_hits, keep)
    kept = [c for c in keep if c != "id"]
    none = F.array().cast("array<string>")
    if method == "keywords" or vectors is None or anchors is None:
        return evidence.select("id", _without_weak("topics", F.col("negatives"), none), "keywords", *kept)
    near = near_topics(vectors, anchors, threshold, book.names)
    joined = evidence.join(near, "id", "left")
    labels = F.sort_array(
        F.array_union("topics", F.when(F.col("has_text"), F.col("near")).otherwise(none))
    )
    known = joined.withColumns(
        {"near": F.coalesce("near", none), "strong": F.coalesce("strong", none)}
    ).withColumn("topics", labels)
    weak_out = _without_weak("topics", F.col("negatives"), F.col("strong"))
    return known.select("id", weak_out, "keywords", *kept)
