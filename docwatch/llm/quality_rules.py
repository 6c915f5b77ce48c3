"""Quality rules: base rules per text, and lines that too many documents of a host share.

Only DataFrame functions are used. A text is split once into words and once into
lines; line digests, not texts, are shuffled.

Defined cases: a null text is the empty text; a null source is the empty source;
a document without words fails the base rules and has no line to lose; repeated
rows are judged alike and each gets its row; an empty table gives an empty one;
columns besides ``doc_id``, ``text`` and ``source`` are never looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docwatch.llm.common import SPACE, SPACE_RUN, shift, text_of, with_may_be_in, words
from docwatch.operators.components import connected_components
from docwatch.session import discard, materialize

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
BANDS, BAND = 32, 3


@dataclass(frozen=True)
class Limits:
    """When a text fails and when a line counts as boilerplate.

    A line, however long, is boilerplate of its host if it is in more than
    ``line_documents`` different texts of the host and in more than ``line_share``
    of them. Copies of a text count once, and so do near copies (see
    :func:`near_text_groups`), so that a group of either doesn't wipe itself out.
    Texts are near copies from an estimated similarity of ``near_share``.
    A document that loses more than ``lost_share`` of its words is rejected.
    """

    min_words: int = 10
    repeat_percent: int = 20
    line_documents: int = 4
    line_share: float = 0.02
    lost_share: float = 0.5
    near_share: float = 0.65


def normal_line(line: Column) -> Column:
    """Lower case, one space between words, every number as 0."""
    spaced = F.regexp_replace(F.btrim(F.lower(line), F.lit(SPACE)), SPACE_RUN, " ")
    return F.regexp_replace(spaced, "[0-9]+", "0")


def with_text_counts(docs: DataFrame) -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``.

    Windows of five words are compared by a 64-bit digest, sorted within the row;
    nothing is shuffled. Each array is a column of its own, so that it is computed
    once and no lambda refers to an outer array.
    """
    text = text_of("text")
    rows = docs.withColumn("_w", words(text))
    rows = rows.withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""))
    rows = rows.select(
        "*",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_w", lambda x: F.xxhash64(x)).alias("_one"),
    )
    # spans of 2, 4 and 5 words from spans of 1, 2 and 4: a hash of two numbers each
    rows = rows.withColumn("_two", _joined("_one", "_one", 1))
    rows = rows.withColumn("_four", _joined("_two", "_two", 2))
    rows = rows.withColumn("_hashes", _joined("_four", "_one", 4))
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    placed = F.arrays_zip(
        F.col("_hashes").alias("h"), F.sequence(F.lit(0), F.size("_hashes") - 1).alias("at")
    )
    rows = rows.withColumn("_sorted", F.when(repeats, F.sort_array(placed)))
    following, preceding = shift(F.col("_sorted"), 1), F.concat(F.slice("_sorted", 1, 1), F.col("_sorted"))
    # the first element stands before itself, hence the test of places
    triples = F.arrays_zip(
        F.col("_sorted").alias("x"), F.slice(preceding, 1, F.size("_sorted")).alias("p"), following.alias("f")
    )
    twice = F.filter(
        triples,
        lambda t: ((t["x"]["h"] == t["p"]["h"]) & (t["x"]["at"] != t["p"]["at"]))
        | F.coalesce(t["x"]["h"] == t["f"]["h"], F.lit(False)),
    )
    rows = rows.withColumn("_at", F.when(F.col("_sorted").isNotNull(), F.sort_array(F.transform(twice, lambda t: t["x"]["at"]))))
    gaps = F.arrays_zip(F.col("_at").alias("a"), shift(F.col("_at"), 1).alias("b"))
    covered = F.aggregate(
        gaps,
        F.lit(0).cast("long"),
        lambda total, g: total + F.least(F.lit(WINDOW), F.coalesce(g["b"] - g["a"], F.lit(WINDOW))).cast("long"),
    )
    rows = rows.withColumn("n_repeat_words", F.when(F.col("_at").isNull(), F.lit(0).cast("long")).otherwise(covered))
    return rows.drop("_w", "_lines", "_one", "_two", "_four", "_hashes", "_sorted", "_at")


def _joined(spans: str, following: str, by: int) -> Column:
    """Hashes of each span together with what begins ``by`` words later."""
    n = F.greatest(F.size(following) - by, F.lit(0))
    return F.zip_with(F.slice(spans, 1, n), shift(F.col(following), by), lambda a, b: F.xxhash64(a, b))


def base_failed(limits: Limits) -> Column:
    return (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words")
    )


def text_key(text: Column) -> Column:
    return F.md5(text)


def line_table(docs: DataFrame) -> DataFrame:
    """``host, text_key, line, words``: each line of each text of a host.

    ``words`` is what the line takes of the text, over all its places and copies;
    only shares of it are used, so the number of copies doesn't matter.
    """
    text = text_of("text")
    # the rule of normal_line, on the text before it is cut: runs of space end at line ends
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]+", "0"), r"[\x20\x09\x0B-\x0D]+", " ")
    lines = docs.select(
        F.coalesce("source", F.lit("")).alias("host"),
        text_key(text).alias("text_key"),
        F.explode_outer(F.split(plain, "\n")).alias("raw"),
    )
    normal = lines.select("host", "text_key", F.btrim("raw", F.lit(" ")).alias("line")).filter("line != ''")
    spaces = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit("")))
    counted = normal.select("host", "text_key", F.xxhash64("line").alias("line"), (spaces + 1).alias("line_words"))
    return counted.groupBy("host", "text_key", "line").agg(F.sum("line_words").alias("words"))


def _may_be_in(rows: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """Nearly only the rows whose ``keys`` are in ``chosen``, and all of those."""
    return with_may_be_in(rows, chosen, keys, "_met").filter("_met").drop("_met")


def _marks(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``host, text_key, marks``: the least digest in each of 96 bins of the five-word windows.

    Only texts in ``chosen(host, text_key)``. Numbers count as 0 and case doesn't
    count, as in lines; a shorter text is one window; a bin without a window is null.
    Marks are made within the row, so that they are shuffled and no text is, and
    copies of a text are one row of a task before that.
    """
    text = text_of("text")
    rows = docs.select(F.coalesce("source", F.lit("")).alias("host"), text_key(text).alias("text_key"), text.alias("text"))
    plain = F.regexp_replace(F.lower("text"), "[0-9]+", "0")
    rows = _may_be_in(rows, chosen, ["host", "text_key"]).select("host", "text_key", words(plain).alias("_w"))
    rows = rows.select("*", F.transform("_w", lambda x: F.xxhash64(x)).alias("_one"))
    rows = rows.withColumn("_two", _joined("_one", "_one", 1))
    rows = rows.withColumn("_four", _joined("_two", "_two", 2))
    rows = rows.withColumn("_hashes", _joined("_four", "_one", 4))
    windows = F.when(F.size("_hashes") > 0, F.col("_hashes")).otherwise(F.array(F.xxhash64("_w")))
    rows = rows.select("host", "text_key", F.sort_array(windows).alias("_sorted"))
    # in ascending order the first of a bin is its least; a generated column is computed
    # once, where one that a lambda refers to is put into the lambda
    bins = F.transform("_sorted", lambda h: F.pmod(h, F.lit(BANDS * BAND)).cast("int"))
    rows = rows.select("host", "text_key", "_sorted", F.explode_outer(F.array(bins)).alias("_bins"))
    marks = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS * BAND - 1)),
        lambda i: F.get("_sorted", F.array_position("_bins", i).cast("int") - 1),
    )
    kept = rows.select("host", "text_key", marks.alias("marks")).dropDuplicates(["host", "text_key"])
    return kept.join(chosen, ["host", "text_key"], "left_semi")


def near_text_groups(docs: DataFrame, chosen: DataFrame, near_share: float) -> DataFrame:
    """``host, text_key, near_group`` of the chosen texts that have near copies in their host.

    Lines can't tell an edited copy from a page with much boilerplate: both share
    most of them. Five-word windows can, for an edited line keeps most of its own.
    Texts alike in a band of three marks are compared with the lowest of them only,
    never pairwise; the share of equal marks estimates the similarity. At a
    similarity of 0.8 its standard deviation is 0.04.
    """
    marks = materialize(_marks(docs, chosen), "marks")
    cut = [F.slice("marks", BAND * b + 1, BAND) for b in range(BANDS)]
    banded = [
        F.when(F.exists(c, lambda x: x.isNotNull()), F.struct(F.lit(b).alias("band"), F.xxhash64(c).alias("key")))
        for b, c in enumerate(cut)
    ]
    bands = marks.select("host", "text_key", F.explode(F.array_compact(F.array(*banded))).alias("at"))
    bands = materialize(bands.select("host", "text_key", "at.band", "at.key"), "bands")
    blocks = bands.groupBy("host", "band", "key").agg(F.min("text_key").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    blocks = materialize(blocks.drop("n"), "blocks")
    # most bands are of one text only
    shared = _may_be_in(bands, blocks, ["host", "band", "key"])
    pairs = shared.join(blocks, ["host", "band", "key"]).filter("text_key <> hub").select("host", "text_key", "hub").distinct()
    hubs = marks.select("host", F.col("text_key").alias("hub"), F.col("marks").alias("hub_marks"))
    met = pairs.join(marks, ["host", "text_key"]).join(hubs, ["host", "hub"])
    both = F.zip_with("marks", "hub_marks", lambda a, b: F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a == b, F.lit(False))))
    met = met.select("host", "text_key", "hub", F.array_compact(both).alias("same"))
    alike = F.size(F.filter("same", lambda x: x)) >= near_share * F.size("same")
    node = lambda key: F.concat(F.col(key), F.col("host"))  # noqa: E731  a key has 32 characters
    links = materialize(met.filter(alike).select(node("text_key").alias("u"), node("hub").alias("v")), "links")
    parts = connected_components(links)
    discard(marks, bands, blocks, links)
    return parts.select(F.substring("id", 33, 1 << 30).alias("host"), F.substring("id", 1, 32).alias("text_key"), F.col("component").alias("near_group"))


def boilerplate_lines(lines: DataFrame, docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``host, line, n_documents`` of the lines above the limits of their host.

    ``n_documents`` counts a group of near copies once, and so does the number of
    texts of a host. Only texts with a line above the limit for texts are grouped,
    for no other line can be above the limit for groups.
    """
    texts = lines.groupBy("host", "text_key").agg(F.lit(1).alias("one"))
    hosts = texts.groupBy("host").agg(F.count("*").alias("n_texts"))
    spread = lines.groupBy("host", "line").agg(F.count("*").alias("n_texts"))
    often = materialize(spread.filter(F.col("n_texts") > limits.line_documents).select("host", "line"), "often")
    there = _may_be_in(lines, often, ["host", "line"])
    hit = materialize(there.join(often, ["host", "line"]).select("host", "line", "text_key"), "often-in")
    near = materialize(near_text_groups(docs, hit.select("host", "text_key").distinct(), limits.near_share), "near")
    groups = near.groupBy("host", "near_group").agg(F.count("*").alias("n"))
    fewer = groups.groupBy("host").agg(F.sum(F.col("n") - 1).alias("again"))
    unit = F.coalesce("near_group", "text_key").alias("unit")
    units = hit.join(near, ["host", "text_key"], "left").select("host", "line", unit).distinct()
    counted = units.groupBy("host", "line").agg(F.count("*").alias("n_documents"))
    common = counted.filter(F.col("n_documents") > limits.line_documents).join(hosts, "host").join(fewer, "host", "left")
    different = F.col("n_texts") - F.coalesce("again", F.lit(0))
    return common.filter(F.col("n_documents") > limits.line_share * different).select("host", "line", "n_documents")


def depleted_texts(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``host, text_key, lost`` of texts that lose words, with the share they lose."""
    lines = materialize(line_table(docs), "lines")
    common = materialize(boilerplate_lines(lines, docs, limits).select("host", "line"), "boilerplate")
    there = _may_be_in(lines, common, ["host", "line"])
    gone = there.join(common, ["host", "line"]).groupBy("host", "text_key").agg(F.sum("words").alias("gone"))
    gone = materialize(gone.filter("gone > 0"), "gone")
    whole = _may_be_in(lines, gone, ["host", "text_key"]).groupBy("host", "text_key").agg(F.sum("words").alias("words"))
    lost = gone.join(whole, ["host", "text_key"])
    return lost.select("host", "text_key", (F.col("gone") / F.col("words")).alias("lost"))


def judge(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``doc_id``, the counts, ``base_failed, lost_share, kept``: one row per row of ``docs``."""
    lost = materialize(depleted_texts(docs, limits), "lost")
    keyed = with_text_counts(docs.select("doc_id", "text", "source")).select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("host"),
        text_key(text_of("text")).alias("text_key"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
    )
    judged = keyed.join(lost, ["host", "text_key"], "left").drop("host", "text_key")
    judged = judged.withColumn("lost_share", F.coalesce("lost", F.lit(0.0))).drop("lost")
    judged = judged.withColumn("base_failed", base_failed(limits))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("lost_share") <= limits.lost_share))


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns and whole texts.

    Only the digests of depleted texts meet the documents, in an anti join.
    """
    lost = depleted_texts(docs, limits).filter(F.col("lost") > limits.lost_share)
    gone = materialize(lost.select(F.col("host").alias("_host"), F.col("text_key").alias("_key")), "depleted")
    narrow = with_text_counts(docs.select(F.struct("*").alias("_row"), "text"))
    # the verdict as a generated column: a filter on it can't be pushed below the counts,
    # where each of their arrays would be computed again and again
    verdict = narrow.select("_row", F.explode_outer(F.array(base_failed(limits))).alias("_failed"))
    passed = verdict.filter(~F.col("_failed")).select("_row")
    host = F.coalesce(F.col("_row.source"), F.lit(""))
    key = text_key(text_of(F.col("_row.text")))
    return passed.join(gone, (host == F.col("_host")) & (key == F.col("_key")), "left_anti").select("_row.*")


def strip_lines(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``docs`` with the lines above the limits taken out of ``text``; other columns stay."""
    lines = materialize(line_table(docs), "lines")
    common = materialize(boilerplate_lines(lines, docs, limits).select("host", "line"), "boilerplate")
    hits = lines.join(common, ["host", "line"]).groupBy("host", "text_key").agg(F.collect_set("line").alias("_hits"))
    hits = materialize(hits.select(F.col("host").alias("_host"), F.col("text_key").alias("_key"), "_hits"), "hits")
    rows = docs.select(F.struct("*").alias("_row"))
    text, host = text_of(F.col("_row.text")), F.coalesce(F.col("_row.source"), F.lit(""))
    joined = rows.join(hits, (host == F.col("_host")) & (text_key(text) == F.col("_key")), "left")
    left = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains("_hits", F.xxhash64(normal_line(x))))
    stripped = F.when(F.col("_hits").isNull(), F.col("_row.text")).otherwise(F.array_join(left, "\n"))
    return joined.select(*[stripped.alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])
