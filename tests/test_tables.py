from datetime import datetime

import pytest

from docwatch.operators import quality, tables
from docwatch.session import shared_dir
from docwatch.sources import config

CLUSTER = (
    "cluster_id string, topic string, start_ts timestamp, end_ts timestamp, size int, score float,"
    " summary string, rep_item_ids array<string>"
)


def day(n):
    return datetime(2024, 1, n)


def test_cluster_upsert(spark):
    stored = spark.createDataFrame(
        [("c1", "old", day(1), day(2), 3, 9.0, "s", ["a"]), ("c2", "t", day(1), day(2), 3, None, None, ["a"])], CLUSTER
    )
    fresh = spark.createDataFrame(
        [("c1", "new", day(3), day(4), 5, 7.0, None, ["b"]), ("c3", "n", day(3), day(4), 4, 4.0, None, ["d"])], CLUSTER
    )
    once = tables.clusters_upsert(stored, fresh)
    got = {r.cluster_id: r for r in once.collect()}
    assert tuple(got["c1"]) == ("c1", "old", day(1), day(4), 5, 9.0, "s", ["b"])
    assert tuple(got["c2"]) == ("c2", "t", day(1), day(2), 3, None, None, ["a"])
    assert got["c3"].topic == "n"
    again = tables.clusters_upsert(once, fresh)
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))


def test_enrich_update_never_leaves_null_lists(spark):
    items = spark.createDataFrame(
        [("1", None, None, ["o"], ["o"]), ("2", "en", 0.5, ["p"], [])],
        "id string, lang string, lang_conf float, topics array<string>, keywords array<string>",
    )
    new = spark.createDataFrame(
        [("1", "de", 0.9, None, None)],
        "id string, lang string, lang_conf double, topics array<string>, keywords array<string>",
    )
    got = {r.id: (r.lang, r.topics, r.keywords) for r in tables.enrich_update(items, new).collect()}
    assert got == {"1": ("de", [], []), "2": ("en", ["p"], [])}


def test_windows_of_time(spark, as_of):
    items = spark.createDataFrame(
        [("in", "t", None, ["x"], datetime(2024, 1, 29, 12)), ("out", "t", "b", ["x"], datetime(2024, 1, 29, 11, 59))],
        "id string, title string, text string, topics array<string>, ts timestamp",
    )
    assert [(r.id, r.content) for r in tables.scan_recent(items, as_of).collect()] == [("in", "t ")]
    assert tables.retain_recent(items, as_of).count() == 1
    assert tables.retain_recent(items, as_of, 0).count() == 0


def test_sources_keep_first_position(spark):
    rss = spark.createDataFrame([(1, "http://a"), (2, "ftp://b"), (3, "HTTPS://c"), (4, "http://a")], "ord int, url string")
    reddit = spark.createDataFrame(
        [("per_sub_search", 1, "plain"), ("subs", 1, "s"), ("search_rss", 1, "s"), ("subs", 2, "http://a"), ("subs", 3, "")],
        "kind string, ord int, url string",
    )
    got = sorted((r.part, r.ord, r.url) for r in config.feed_sources(rss, reddit).collect())
    assert got == [(0, 1, "http://a"), (0, 3, "HTTPS://c"), (1, 1, "s"), (3, 1, "plain")]
    assert [r.url for r in config.dropped_sources(rss).collect()] == ["ftp://b"]


def test_terms_table(spark):
    raw = spark.createDataFrame(
        [("t ", "keyword", 2, " a "), ("t", "keyword", 1, "a"), ("t", "keyword", 3, "b"), ("t", "keyword", 4, " "),
         ("u", "keyword", 1, "c"), ("t", "negative", 1, "a"), ("t", "keyword", 5, None)],
        "topic string, kind string, ord int, term string",
    )
    topics = spark.createDataFrame([("t",), ("t",)], "topic string")
    terms = config.build_terms(raw, topics)
    got = sorted((r.kind, r.ord, r.term) for r in terms.collect())
    assert got == [("keyword", 1, "a"), ("keyword", 3, "b"), ("negative", 1, "a")]
    assert [r.topic for r in config.unknown_terms(raw, topics).collect()] == ["u"]
    book = config.Dictionary.from_table(["t"], terms)
    assert book.topics[0].keywords == ("a", "b") and book.topics[0].negatives == ("a",)


def test_checks_count_violations(spark):
    items = spark.createDataFrame(
        [("1", "s", "u", day(1), 1.5, {}, ["a"], []), ("1", None, "u", day(1), None, {}, None, []),
         (None, "s", None, None, -0.1, None, [], None)],
        "id string, src string, url string, ts timestamp, lang_conf float, entities map<string,string>,"
        " topics array<string>, keywords array<string>",
    )
    got = {r.rule: r.violations for r in quality.check_items(items).collect()}
    assert got == {
        "id is null": 1, "src is null": 1, "ts is null": 1, "entities is null": 1, "topics is null": 1,
        "keywords is null": 1, "lang_conf outside 0..1": 2, "id repeated": 1, "url repeated": 1,
    }


class _Session:
    """Only what the lookup of the shared folder asks of a session."""

    def __init__(self, master, setting=None):
        self.conf, self.sparkContext, self.master = self, self, master
        self.setting, self.folder = setting, None

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.setting or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, path):
        self.folder = path


def test_shared_folder_follows_the_setting():
    assert shared_dir(_Session("spark://host:7077", "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_dir(_Session("local[2]")).startswith("/")
    with pytest.raises(ValueError):
        shared_dir(_Session("spark://host:7077"))
