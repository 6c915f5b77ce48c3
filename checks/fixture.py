"""The test tables seen as items, entries, vectors, clusters and a dictionary."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docwatch.operators.rollup import cluster_rollup
from docwatch.sources.config import Dictionary
from docwatch.sources.tables import read_table

AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)
EARLIER = datetime(2024, 1, 30, tzinfo=timezone.utc)
EPOCH_2024 = 1_704_067_200

TOPICS = [
    "contact", "french", "german", "licensing", "secrets", "spanish",
    "topic6", "topic7", "topic8", "topic9",
]
LISTS = {
    "keyword": {
        "licensing": ["License", "MIT", "Apache"],
        "secrets": ["token ="],
        "contact": ["@"],
        "german": ["und", "nicht"],
        "french": ["les", "des", "pour"],
        "spanish": ["los", "para"],
    },
    "negative": {"licensing": ["und"], "french": ["nicht"]},
    "exclude": {"licensing": ["GNU General"], "spanish": ["pour"]},
}
BOOK = Dictionary.from_lists(TOPICS, LISTS)
LINK_DISTANCE = 0.65

# One spelling per date form that feeds use; the same moment in each, or its day.
DATE_FORMS = (
    "EEE, dd MMM yyyy HH:mm:ss '+0200'",
    "dd MMM yyyy HH:mm:ss 'GMT'",
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "EEE, d MMM yy HH:mm:ss 'GMT'",
    "d MMM yyyy H:mm:ss 'EST'",
    "yyyy-MM-dd'T'HH:mm'Z'",
    "d MMMM yyyy HH:mm:ss '+0000 (UTC)'",
    "EEE MMM d HH:mm:ss yyyy",
    "yyyy-MM-dd",
    "yyyy-MM",
    "EEEE, dd-MMM-yy HH:mm:ss 'PDT'",
    "yyyy-MM-dd'T'HH:mm:ss'+09:00'",
    "EEE, dd MMM yyyy HH:mm 'UT'",
    "yyyyMMdd'T'HHmmss'Z'",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def item_ts(number) -> F.Column:
    return F.timestamp_seconds(F.lit(EPOCH_2024) + (number * 1_601_951) % 2_592_000)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "url")
    none = F.array().cast("array<string>")
    first_line = F.split(F.col("text"), "\n", 2)[0]
    return docs.join(pages, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("src"),
        F.lit(None).cast("string").alias("chan"),
        "url",
        item_ts(F.col("doc_id")).alias("ts"),
        F.lit(None).cast("string").alias("lang"),
        F.lit(None).cast("float").alias("lang_conf"),
        F.left(first_line, F.lit(80)).alias("title"),
        "text",
        F.create_map().cast("map<string,string>").alias("entities"),
        F.when(F.col("n_chars") >= 500, F.array("lang", "source")).otherwise(none).alias("topics"),
        none.alias("keywords"),
        F.lit(None).cast("string").alias("hash_sim"),
        F.col("lang").alias("true_lang"),
    )


def plain_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items(spark, sf_dir).drop("true_lang")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("vec")
    )


def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lowest vector of each label; labels name the ten topics in order."""
    names = F.array(*[F.lit(t) for t in TOPICS])
    return (
        table(spark, sf_dir, "embeddings")
        .groupBy("label")
        .agg(F.min_by("embedding", "vec_id").alias("vec"))
        .select(F.get(names, F.col("label")).alias("topic"), F.lit(0).alias("ord"), "vec")
    )


def source_labels(rows: DataFrame) -> DataFrame:
    return rows.select("id", F.col("src").alias("label"))


def fresh_labels(rows: DataFrame) -> DataFrame:
    """As above, but ten of the twenty sources are divided by language."""
    divided = F.when(
        F.length("src") == 4, F.concat_ws("-", "src", "true_lang")
    ).otherwise(F.col("src"))
    return rows.select("id", divided.alias("label"))


def as_recent(rows: DataFrame) -> DataFrame:
    return rows.select("id", F.concat_ws(" ", "title", "text").alias("content"), "topics", "ts")


def stored_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters by source, as an earlier run would have scored them."""
    rows = items(spark, sf_dir)
    found = cluster_rollup(as_recent(rows), source_labels(rows), EARLIER)
    return found.withColumn("summary", F.concat(F.lit("- stored "), F.col("topic")))


def fresh_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = items(spark, sf_dir)
    return cluster_rollup(as_recent(rows), fresh_labels(rows), AS_OF)


def document_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cluster per document, with a summary made of its whole text."""
    docs = table(spark, sf_dir, "documents")
    n = F.col("doc_id")
    head = F.col("text")
    bullets = F.concat(F.lit("- "), F.replace(head, F.lit(". "), F.lit(".\n* ")))
    summary = (
        F.when(n % 5 == 0, F.concat(bullets, F.lit("\nEntities: "), "source"))
        .when(n % 5 == 1, F.concat(bullets, F.lit(" Entities : "), "source", F.lit(", "), "lang"))
        .when(n % 5 == 2, F.concat(F.upper(head), F.lit("!!!")))
        .when(n % 5 == 3, F.upper(F.translate(head, "ß", "")))
        .otherwise(F.lit(None).cast("string"))
    )
    return docs.select(
        n.cast("string").alias("cluster_id"),
        F.when(n % 3 == 0, F.lit("misc")).otherwise(F.col("lang")).alias("topic"),
        item_ts(n).alias("start_ts"),
        F.when(n % 11 == 0, None).otherwise(item_ts(n)).alias("end_ts"),
        (F.col("n_chars") % 97 + 1).cast("int").alias("size"),
        F.when(n % 13 == 0, None)
        .otherwise((F.col("n_chars") % 101).cast("float"))
        .alias("score"),
        summary.alias("summary"),
        F.array(*[(n + i).cast("string") for i in range(3)]).alias("rep_item_ids"),
    )


def linked_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose urls also cover the tone marks."""
    rows = plain_items(spark, sf_dir)
    marked = F.replace(F.col("url"), F.lit("example.org"), F.lit("europa.eu"))
    return rows.withColumn("url", marked)


def feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed entry per document, with the parts the rules choose from."""
    docs = table(spark, sf_dir, "documents")
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "url")
    n, ts = F.col("doc_id"), item_ts(F.col("doc_id"))
    published = F.lit(None).cast("string")
    for place, form in enumerate(DATE_FORMS):
        published = F.when(n % 20 == place, F.date_format(ts, form)).otherwise(published)
    published = F.when(n % 20 == len(DATE_FORMS), F.lit("sometime")).otherwise(published)
    first_line = F.split(F.col("text"), "\n", 2)[0]
    marked_up = F.concat(F.lit("<p>"), "text", F.lit("</p>"))
    contents = (
        F.when(n % 4 == 0, F.array(F.struct(marked_up.alias("value"))))
        .when(n % 4 == 1, F.array(F.struct(F.left("text", F.lit(20)).alias("value")), F.struct(F.col("text").alias("value"))))
        .otherwise(F.array().cast("array<struct<value:string>>"))
    )
    return docs.join(pages, "doc_id", "left").select(
        F.col("source").alias("feed_url"),
        F.when(n % 2 == 0, F.col("url")).otherwise(F.lit("")).alias("link"),
        F.when(n % 3 == 0, F.concat(F.lit("urn:doc:"), n.cast("string"))).alias("id"),
        F.array(F.struct(F.lit("").alias("href")), F.struct(F.col("url").alias("href"))).alias("links"),
        F.when(n % 7 > 0, F.left(first_line, F.lit(80))).alias("title"),
        published.alias("published"),
        F.when(n % 20 >= len(DATE_FORMS), F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).alias("updated"),
        F.lit(None).cast("string").alias("created"),
        contents.alias("content"),
        F.struct(F.when(n % 4 == 1, F.col("text")).alias("value")).alias("summary_detail"),
        F.when(n % 8 == 2, F.concat(F.lit("  "), F.col("text"))).alias("summary"),
        F.when(n % 8 == 6, F.col("text")).alias("description"),
    )


def feed_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dialect, feed, value``: one feed document per source and thousand ids."""
    docs = table(spark, sf_dir, "documents")
    n, ts = F.col("doc_id"), item_ts(F.col("doc_id"))

    def escaped(text) -> F.Column:
        for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            text = F.replace(text, F.lit(char), F.lit(entity))
        return text

    def tag(name: str, value) -> F.Column:
        return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))

    url = F.concat(F.lit("https://"), "source", F.lit(".example.org/"), n.cast("string"))
    title = escaped(F.left(F.split(F.col("text"), "\n", 2)[0], F.lit(80)))
    body = escaped(F.col("text"))
    rss = F.concat(
        F.lit("<item>"), tag("title", title), tag("link", url),
        tag("guid", F.concat(F.lit("g"), n.cast("string"))),
        tag("pubDate", F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss '+0000'")),
        tag("description", body), F.lit("</item>"),
    )
    atom = F.concat(
        F.lit("<entry>"), tag("title", title),
        F.lit('<link rel="alternate" href="'), url, F.lit('"/>'),
        F.lit('<link rel="edit" href="https://edit.example.org/"/>'),
        tag("id", F.concat(F.lit("a"), n.cast("string"))),
        tag("updated", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        tag("summary", body), F.lit("</entry>"),
    )
    is_rss = F.substring("source", -1, 1).isin(list("02468"))
    entries = docs.select(
        F.when(is_rss, "rss").otherwise("atom").alias("dialect"),
        F.concat_ws("-", "source", F.floor(n / 1000).cast("string")).alias("feed"),
        F.struct(n.alias("n"), F.when(is_rss, rss).otherwise(atom).alias("xml")).alias("entry"),
    )
    whole = F.array_join(F.transform(F.array_sort(F.collect_list("entry")), lambda e: e["xml"]), "\n")
    return entries.groupBy("dialect", "feed").agg(whole.alias("xml")).select(
        "dialect",
        "feed",
        F.when(
            F.col("dialect") == "rss",
            F.concat(F.lit('<rss version="2.0"><channel>'), "xml", F.lit("</channel></rss>")),
        )
        .otherwise(F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), "xml", F.lit("</feed>")))
        .alias("value"),
    )


def raw_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cluster_id, raw``: one outside summary per conversation turn."""
    turns = table(spark, sf_dir, "conversations")
    text, turn = F.col("text"), F.col("turn") % 7
    raw = (
        F.when(turn == 0, text)
        .when(turn == 1, F.concat(F.lit("- "), F.replace(text, F.lit(". "), F.lit("\n- ")), F.lit("\nEntities: A, B")))
        .when(turn == 2, F.replace(text, F.lit(". "), F.lit(" - ")))
        .when(turn == 3, F.lit(""))
        .when(turn == 4, F.concat(F.lit("Entities: "), text))
        .when(turn == 5, F.element_at(F.split(text, " "), 1))
        .otherwise(F.concat(F.lit("• "), text))
    )
    key = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return turns.select(key.alias("cluster_id"), raw.alias("raw"))


def turn_reps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cluster_id, pos, id, title, url, text``: two items per conversation turn."""
    turns = table(spark, sf_dir, "conversations")
    key = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    wanted = turns.select(
        key.alias("cluster_id"),
        F.posexplode(
            F.array(F.col("conv_id").cast("string"), (F.col("conv_id") + F.col("turn") + 1).cast("string"))
        ).alias("pos", "id"),
    )
    rows = plain_items(spark, sf_dir).select("id", "title", "url", "text")
    return wanted.join(rows, "id").select("cluster_id", "pos", "id", "title", "url", "text")
