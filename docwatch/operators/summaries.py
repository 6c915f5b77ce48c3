"""Cluster summaries: three bullets and a line of entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docwatch.functions.arrays import explode_rows, posexplode_rows
from docwatch.functions.text import (
    blank_to_null,
    clean_text,
    clean_unescaped,
    strip,
    text_lines,
    unescape,
    unescape_array,
)
from docwatch.operators.features import content_tokens, idf
from docwatch.operators.tables import summary_update
from docwatch.session import materialize

# Fixed values of the summary format.
TOP_CLUSTERS = 24
BULLETS = 3
BULLET_WORDS = 60
MAX_TITLES, MAX_HOSTS, MAX_ENTITIES = 3, 6, 6
BLOCK_BREAK = "\n\n---\n\n"
PLACEHOLDERS = ("No substantive content", "Source too short", "Will summarize later")
NO_ENTITIES = "—"
FAILED = "- Summarization failed\n- Summarization failed\n- Summarization failed\nEntities: —"

ENTITIES_VALUE = r"(?im)^entities\s*:\s*(.*)$"
ENTITIES_LINE = r"(?im)^entities\s*:.*$"
NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def _none() -> Column:
    return F.array().cast("array<string>")


def top_clusters(clusters: DataFrame, limit: int = TOP_CLUSTERS) -> DataFrame:
    """The best scored clusters, in order."""
    return (
        clusters.filter(F.col("size") >= 1)
        .orderBy(F.col("score").desc_nulls_last(), "cluster_id")
        .limit(limit)
    )


def rep_items(clusters: DataFrame, items: DataFrame) -> DataFrame:
    """``cluster_id, pos, id, title, url, text`` of all representatives, one join."""
    wanted = clusters.select("cluster_id", F.posexplode("rep_item_ids").alias("pos", "id"))
    return wanted.join(items.select("id", "title", "url", "text"), "id").select(
        "cluster_id", "pos", "id", "title", "url", "text"
    )


def cluster_context(reps: DataFrame, context_chars: int | None = None) -> DataFrame:
    """``cluster_id, context``: one text made of the representatives.

    ``context_chars`` cuts it for an outside model with a window; the extractive
    rule sees it whole.
    """

    def labelled(name: str, value: Column) -> Column:
        return F.when(value != "", F.concat(F.lit(name), value))

    cleaned = reps.select(
        "cluster_id",
        "pos",
        clean_text(F.col("title")).alias("title"),
        strip(F.coalesce("url", F.lit(""))).alias("url"),
        clean_text(F.col("text")).alias("text"),
    )
    block = F.concat_ws(
        "\n",
        labelled("Title: ", F.col("title")),
        labelled("URL: ", F.col("url")),
        blank_to_null(F.col("text")),
    )
    blocks = cleaned.select("cluster_id", F.struct("pos", blank_to_null(block).alias("block")).alias("part"))
    parts = F.transform(F.sort_array(F.collect_list("part")), lambda p: p["block"])
    joined = F.concat_ws(BLOCK_BREAK, parts)
    whole = joined if context_chars is None else F.left(joined, F.lit(context_chars))
    return blocks.groupBy("cluster_id").agg(whole.alias("context"))


def _context_sentences(context: Column) -> Column:
    """Sentences of titles and bodies, in order; addresses and rules left out."""
    lines = F.filter(
        text_lines(context), lambda l: ~l.startswith("URL: ") & (l != "---")
    )
    bare = F.transform(lines, lambda l: F.regexp_replace(l, r"^Title: ", ""))
    return F.flatten(F.transform(bare, lambda l: F.split(l, r"(?<=[.?!])\s+")))


def _first_words(sentence: Column) -> Column:
    return F.array_join(F.slice(F.split(sentence, " "), 1, BULLET_WORDS), " ")


def extractive_summary(contexts: DataFrame, bullets: int = BULLETS) -> DataFrame:
    """``cluster_id, raw``: the sentences with the highest mean word weight.

    A word weighs its idf over the contexts. Sentences without content words
    don't take part; equal weights go to the earlier sentence; the chosen ones
    keep their order.
    """
    found = posexplode_rows(
        contexts, ["cluster_id"], _context_sentences(F.col("context")), "sentence"
    ).filter(F.col("sentence") != "")
    sentences = materialize(
        found.withColumn("words", content_tokens(F.col("sentence"))), "sentences"
    )
    words = explode_rows(sentences, ["cluster_id", "pos"], F.col("words"), "word")
    counts = words.groupBy("cluster_id", "pos", "word").agg(F.count("*").alias("n"))
    df = counts.groupBy("word").agg(F.count_distinct("cluster_id").alias("df"))
    n_docs = contexts.agg(F.count("*")).scalar()
    weights = df.select("word", idf(F.col("df"), n_docs).alias("weight"))
    means = counts.join(weights, "word").groupBy("cluster_id", "pos").agg(
        F.round(F.sum(F.col("n") * F.col("weight")) / F.sum("n"), 9).alias("mean")
    )
    best = W.partitionBy("cluster_id").orderBy(F.col("mean").desc(), "pos")
    chosen = means.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= bullets)
    lines = chosen.join(sentences, ["cluster_id", "pos"]).select(
        "cluster_id", F.struct("pos", _first_words(F.col("sentence")).alias("text")).alias("line")
    )
    ordered = F.transform(
        F.sort_array(F.collect_list("line")), lambda l: F.concat(F.lit("- "), l["text"])
    )
    found = lines.groupBy("cluster_id").agg(F.array_join(ordered, "\n").alias("raw"))
    return contexts.select("cluster_id").join(found, "cluster_id", "left").select(
        "cluster_id", F.coalesce("raw", F.lit("")).alias("raw")
    )


def _netloc_label(url: Column) -> Column:
    """The second-level part of the host, capitalised; NULL without a host."""
    parts = F.filter(F.split(F.regexp_extract(url, NETLOC, 1), r"\."), lambda p: p != "")
    label = F.coalesce(F.try_element_at(parts, F.lit(-2)), F.get(parts, F.lit(0)))
    return F.concat(F.upper(F.left(label, F.lit(1))), F.lower(F.substr(label, F.lit(2))))


def rep_facts(reps: DataFrame) -> DataFrame:
    """``cluster_id, titles, urls``: cleaned titles and addresses in order."""
    one = F.struct("pos", clean_text(F.col("title")).alias("title"), "url")
    parts = F.sort_array(F.collect_list("rep"))
    gathered = reps.select("cluster_id", one.alias("rep")).groupBy("cluster_id").agg(parts.alias("reps"))
    return gathered.select(
        "cluster_id",
        F.filter(F.transform("reps", lambda r: r["title"]), lambda t: t != "").alias("titles"),
        F.filter(F.transform("reps", lambda r: r["url"]), lambda u: u != "").alias("urls"),
    )


def fallback_entities(titles: Column, urls: Column) -> Column:
    hosts = F.array_compact(F.transform(urls, _netloc_label))
    names = F.array_distinct(F.concat(F.slice(titles, 1, MAX_TITLES), F.slice(hosts, 1, MAX_HOSTS)))
    joined = F.array_join(F.slice(F.filter(names, lambda n: n != ""), 1, MAX_ENTITIES), ", ")
    return F.coalesce(blank_to_null(joined), F.lit(NO_ENTITIES))


def entities_fallback(reps: DataFrame) -> DataFrame:
    """``cluster_id, entities`` from titles and host names."""
    return rep_facts(reps).select(
        "cluster_id", fallback_entities(F.col("titles"), F.col("urls")).alias("entities")
    )


def _clean_array(texts: Column) -> Column:
    return F.transform(unescape_array(texts), clean_unescaped)


def _placeholders() -> Column:
    return F.array(*[F.lit(p) for p in PLACEHOLDERS])


def _pad(bullets: Column) -> Column:
    last = F.try_element_at(bullets, F.lit(-1))
    missing = F.greatest(F.lit(BULLETS) - F.size(bullets), F.lit(0))
    return F.slice(F.concat(bullets, F.array_repeat(last, missing)), 1, BULLETS)


def _render(bullets: Column, entities: Column) -> Column:
    lines = F.array_join(F.transform(bullets, lambda b: F.concat(F.lit("- "), b)), "\n")
    return F.concat(lines, F.lit("\nEntities: "), F.coalesce(blank_to_null(entities), F.lit(NO_ENTITIES)))


def _nonblank(parts: Column) -> Column:
    return F.filter(F.transform(parts, strip), lambda p: p != "")


def format_summaries(raw: DataFrame, facts: DataFrame, keep_lines: bool = False) -> DataFrame:
    """``cluster_id, summary``: exactly three bullets and one entities line.

    ``raw(cluster_id, raw)`` is any outside text; ``facts`` as given by
    :func:`rep_facts`. The text is joined to one line before bullets are looked
    for, unless ``keep_lines``. Each way of finding bullets is a column of its
    own, and the first one that applies is taken.
    """
    joined = raw.join(facts, "cluster_id", "left").select(
        "cluster_id",
        F.coalesce("raw", F.lit("")).alias("raw"),
        F.coalesce("titles", _none()).alias("titles"),
        F.coalesce("urls", _none()).alias("urls"),
    )
    if keep_lines:
        plain = joined.withColumn("plain", unescape(F.col("raw")))
        lines = F.transform(text_lines(F.col("plain")), clean_unescaped)
        whole = plain.withColumn("txt", F.array_join(F.filter(lines, lambda l: l != ""), "\n"))
    else:
        whole = joined.withColumn("txt", clean_text(F.col("raw")))
    parsed = whole.withColumns(
        {
            "entities": F.when(
                F.col("txt").rlike(ENTITIES_VALUE),
                clean_text(F.regexp_extract("txt", ENTITIES_VALUE, 1)),
            ).otherwise(fallback_entities(F.col("titles"), F.col("urls"))),
            "body": strip(F.regexp_replace("txt", ENTITIES_LINE, "")),
        }
    )
    marked = F.filter(
        text_lines(F.col("body")),
        lambda l: l.startswith("-") | l.startswith("•") | l.startswith("—"),
    )
    bare_body = strip(F.regexp_replace("body", r"^[\- •]+", ""))
    ways = parsed.withColumns(
        {
            "marked": F.transform(marked, lambda l: strip(F.regexp_replace(l, r"^[\-•]\s*", ""))),
            "inline": _nonblank(F.split(bare_body, r"\s-\s")),
            "sentences": _nonblank(F.split("body", r"(?<=[.?!])\s+")),
        }
    )
    found = (
        F.when((F.size("marked") <= 1) & (F.size("inline") >= 2), F.col("inline"))
        .when(F.size("marked") == 0, F.col("sentences"))
        .otherwise(F.col("marked"))
    )
    listed = ways.withColumn("bullets", found)
    short_of = F.greatest(F.lit(BULLETS) - F.size("bullets"), F.lit(0))
    titled = listed.withColumn(
        "bullets",
        F.concat("bullets", F.slice(F.array_except("titles", "bullets"), F.lit(1), short_of)),
    )
    nonempty = titled.withColumn("bullets", F.filter("bullets", lambda b: b != ""))
    cleaned = nonempty.withColumn("bullets", _clean_array(F.col("bullets")))
    filled = cleaned.withColumn(
        "bullets", F.when(F.size("bullets") == 0, _placeholders()).otherwise(F.col("bullets"))
    )
    return filled.select(
        "cluster_id", _render(_pad(F.col("bullets")), F.col("entities")).alias("summary")
    )


def empty_context_summary(facts: DataFrame) -> DataFrame:
    """``cluster_id, summary`` for clusters whose context is blank: titles as
    they are, or the fixed placeholders; not padded."""
    titles = F.slice("titles", 1, BULLETS)
    bullets = F.when(F.size(titles) > 0, titles).otherwise(_placeholders())
    return facts.select(
        "cluster_id",
        _render(bullets, fallback_entities(F.col("titles"), F.col("urls"))).alias("summary"),
    )


def summaries_for(
    clusters: DataFrame, items: DataFrame, raw: DataFrame | None = None, keep_lines: bool | None = None
) -> DataFrame:
    """``cluster_id, summary`` of every row of ``clusters``.

    Without ``raw`` the summaries are extractive. With it, a cluster that has
    context but no raw text gets the failure text.
    """
    clusters = materialize(clusters.select("cluster_id", "rep_item_ids"), "to-summarise")
    reps = materialize(rep_items(clusters, items), "reps")
    contexts = materialize(
        clusters.select("cluster_id").join(cluster_context(reps), "cluster_id", "left"), "contexts"
    )
    facts = (
        clusters.select("cluster_id")
        .join(rep_facts(reps), "cluster_id", "left")
        .select(
            "cluster_id",
            F.coalesce("titles", _none()).alias("titles"),
            F.coalesce("urls", _none()).alias("urls"),
        )
    )
    has_context = strip(F.coalesce("context", F.lit(""))) != ""
    if raw is None:
        texts = extractive_summary(contexts.filter(has_context))
        keep_lines = True if keep_lines is None else keep_lines
    else:
        texts = raw.select("cluster_id", "raw").filter(F.col("raw").isNotNull())
    formatted = format_summaries(texts, facts, bool(keep_lines))
    blank = empty_context_summary(facts).withColumnRenamed("summary", "blank_summary")
    return (
        contexts.join(formatted, "cluster_id", "left")
        .join(blank, "cluster_id")
        .select(
            "cluster_id",
            F.when(has_context, F.coalesce("summary", F.lit(FAILED)))
            .otherwise(F.col("blank_summary"))
            .alias("summary"),
        )
    )


def summarize(
    clusters: DataFrame, items: DataFrame, raw: DataFrame | None = None, limit: int = TOP_CLUSTERS
) -> DataFrame:
    """The clusters table with the summaries of its best clusters stored."""
    return summary_update(clusters, summaries_for(top_clusters(clusters, limit), items, raw))
