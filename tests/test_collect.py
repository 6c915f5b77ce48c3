import hashlib
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from docwatch.operators import collect
from docwatch.operators.tables import items_insert
from docwatch.schema import FEED_ENTRIES, ITEMS
from docwatch.sources.feeds import read_feed_entries

UTC = timezone.utc


def entries(spark, *rows):
    names = FEED_ENTRIES.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], FEED_ENTRIES)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Tue, 16 Sep 2025 17:26:05 +0900", datetime(2025, 9, 16, 8, 26, 5)),
        ("16 Sep 2025 17:26:05 GMT", datetime(2025, 9, 16, 17, 26, 5)),
        ("Tue, 16 Sep 2025 17:26 +0000", datetime(2025, 9, 16, 17, 26)),
        ("Tue, 6 Sep 2025 17:26:05", datetime(2025, 9, 6, 17, 26, 5)),
        ("2025-09-16T17:26:05Z", datetime(2025, 9, 16, 17, 26, 5)),
        ("2025-09-16T17:26:05.250+02:00", datetime(2025, 9, 16, 15, 26, 5, 250000)),
        ("2025-09-16 17:26:05", datetime(2025, 9, 16, 17, 26, 5)),
        ("2025-09-16", datetime(2025, 9, 16)),
        ("Mon, 16 Sep 24 10:00:00 GMT", datetime(2024, 9, 16, 10)),
        ("Mon, 16 Sep 85 10:00:00 GMT", datetime(1985, 9, 16, 10)),
        ("16 Sep 2024 9:05:00 GMT", datetime(2024, 9, 16, 9, 5)),
        ("2024-09-16T10:00Z", datetime(2024, 9, 16, 10)),
        ("16 September 2024 10:00:00 GMT", datetime(2024, 9, 16, 10)),
        ("Mon, 16 Sep 2024 10:00:00 +0000 (UTC)", datetime(2024, 9, 16, 10)),
        ("Mon Sep 16 10:00:00 2024", datetime(2024, 9, 16, 10)),
        ("16 Sep 2024 10:00:00 EST", datetime(2024, 9, 16, 15)),
        ("16 Jul 2024 10:00:00 PDT", datetime(2024, 7, 16, 17)),
        ("2024-09", datetime(2024, 9, 1)),
        ("31 Feb 2024 10:00:00 GMT", datetime(2024, 1, 31)),
        ("16 Foo 2024 10:00:00 GMT", datetime(2024, 1, 31)),
        ("yesterday", datetime(2024, 1, 31)),
        (None, datetime(2024, 1, 31)),
    ],
)
def test_dates(spark, as_of, text, expected):
    for zone in ("UTC", "Asia/Seoul"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        row = entries(spark, {"link": "u", "published": text, "updated": None})
        got = collect.entries_to_items(row, as_of).select(F.unix_micros("ts").alias("t")).first().t
        assert got == round(expected.replace(tzinfo=UTC).timestamp() * 1e6)
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_later_date_fields_are_fallbacks(spark, as_of):
    row = entries(spark, {"published": "bad", "updated": "2024-01-02T00:00:00Z", "created": "2024-01-03"})
    assert collect.entries_to_items(row, as_of).first().ts.day == 2


def test_url_and_id(spark, as_of):
    rows = entries(
        spark,
        {"link": "l", "id": "i", "title": "t"},
        {"link": "", "id": "i", "title": ""},
        {"link": None, "id": None, "links": [{"href": ""}, {"href": None}, {"href": "h"}]},
        {"summary": "only a summary"},
    )
    got = [(r.url, r.id) for r in collect.entries_to_items(rows, as_of).collect()]

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    assert got == [("l", sha("l|t|i")), ("i", sha("i|i")), ("h", sha("h")), (None, sha("only a summary"))]


LONG = "word " * 20


def test_body_chain(spark, as_of):
    pages = spark.createDataFrame(
        [("p", f"<html><article>{LONG} page</article></html>"), ("q", None)], "url string, html string"
    )
    rows = entries(
        spark,
        {"link": "p", "content": [{"value": LONG}, {"value": LONG + "longer"}], "summary": "s"},
        {"link": "p", "content": [{"value": "tiny"}], "summary": "s"},
        {"link": "q", "summary": "", "description": " d "},
        {"link": "r", "summary_detail": {"value": "x" * 9000}},
        {"link": "s", "content": [{"value": "a" * 40}], "summary_detail": {"value": "b" * 40}},
    )
    got = {r.url + str(i): r.text for i, r in enumerate(collect.entries_to_items(rows, as_of, pages).collect())}
    texts = sorted(got.values())
    assert sorted([LONG + "longer", LONG + " page".strip(), "d", "x" * 9000, "a" * 40]) == texts
    short = {r.text for r in collect.entries_to_items(rows, as_of, pages, body_chars=30).collect()}
    assert short == {t[:30] for t in texts}


def test_short_bodies_are_reported(spark):
    rows = spark.createDataFrame([("1", "u", "x" * 79), ("2", "v", "x" * 80), ("3", "w", None)], "id string, url string, text string")
    assert {(r.id, r.n_chars) for r in collect.short_body_report(rows).collect()} == {("1", 79), ("3", 0)}


RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>
<title>Feed</title><item><title>A &amp; B</title><link>https://a.org/1</link><guid>g1</guid>
<pubDate>Tue, 16 Sep 2025 17:26:05 +0000</pubDate><description>&lt;p&gt;short&lt;/p&gt;</description>
<content:encoded><![CDATA[<p>The whole body of the entry, with enough text.</p>]]></content:encoded></item>
<item><title>Second</title><guid>g2</guid></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>a1</id><title>T</title>
<link rel="self" href="https://b.org/self"/><link href="https://b.org/1"/>
<updated>2025-09-16T17:26:05Z</updated><summary>sum</summary></entry></feed>"""


def test_feeds_to_items(spark, as_of, tmp_path):
    (tmp_path / "rss.xml").write_text(RSS)
    (tmp_path / "atom.xml").write_text(ATOM)
    (tmp_path / "broken.xml").write_text("<rss><channel><item><title>ok</title><link>https://c.org</link></item><item><title>x")
    found = read_feed_entries(spark, str(tmp_path))
    items = {r.title: r for r in collect.entries_to_items(found, as_of).collect()}
    assert items["A & B"].url == "https://a.org/1"
    assert items["A & B"].text == "The whole body of the entry, with enough text."
    assert items["A & B"].ts.year == 2025
    assert items["Second"].url == "g2"
    assert items["T"].url == "https://b.org/1" and items["T"].text == "sum"
    assert "ok" in items


def item_rows(spark, *rows):
    base = dict.fromkeys(ITEMS.fieldNames())
    base.update(src="rss", entities={}, topics=[], keywords=[])
    full = [tuple({**base, **r}[n] for n in ITEMS.fieldNames()) for r in rows]
    return spark.createDataFrame(full, ITEMS)


def ts(hour):
    return datetime(2024, 1, 1, hour)


def test_identical_arrivals_are_one_row(spark):
    row = {"id": "1", "url": "u1", "ts": ts(1), "text": "x", "entities": {"k": "v"}}
    same = item_rows(spark, row, row, {**row, "text": "y"})
    assert items_insert(item_rows(spark), same).count() == 1
    assert items_insert(item_rows(spark), same.limit(0)).count() == 0


def test_insert_ignores_conflicts(spark):
    stored = item_rows(spark, {"id": "1", "url": "u1", "ts": ts(1), "text": "old"})
    arriving = item_rows(
        spark,
        {"id": "1", "url": "u1", "ts": ts(2), "text": "new"},
        {"id": "2", "url": "u1", "ts": ts(2)},
        {"id": "3", "url": "u3", "ts": ts(3), "text": "late"},
        {"id": "3", "url": "u3", "ts": ts(2), "text": "first"},
        {"id": "4", "url": "u3", "ts": ts(4)},
        {"id": "5", "url": None, "ts": ts(1)},
        {"id": "6", "url": None, "ts": ts(1)},
    )
    once = items_insert(stored, arriving)
    got = {r.id: r.text for r in once.collect()}
    assert got == {"1": "old", "3": "first", "5": None, "6": None}
    assert once.schema.fieldNames() == ITEMS.fieldNames()
    assert items_insert(once, arriving).count() == 4  # again changes nothing
