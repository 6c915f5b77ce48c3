from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from docwatch.operators import tables
from docwatch.plans import stages
from docwatch.session import fresh_path
from docwatch.sources.store import ConcurrentWrite, ItemStore

SF = "/root/testdata/sf0.001"
FIELDS = ["id", "url", "ts", "title", "text", "lang", "lang_conf", "topics", "keywords"]


@pytest.fixture
def rows(spark):
    return fx.plain_items(spark, SF)


@pytest.fixture
def store(spark, rows):
    made = ItemStore(spark, fresh_path(spark, "store"))
    made.insert(rows)
    return made


def seen(frame):
    return sorted(map(str, frame.select(FIELDS).collect()))


def changes(frame, lang):
    none = F.lit(None).cast("array<string>")
    return frame.select("id", "ts", F.lit(lang).alias("lang"), F.lit(0.5).cast("float").alias("lang_conf"), F.array("src").alias("topics"), none.alias("keywords"))


def test_empty_store(spark, as_of):
    empty = ItemStore(spark, fresh_path(spark, "store"))
    assert empty.version() == 0 and empty.items().count() == 0 and empty.recent(as_of).count() == 0
    assert empty.compact() == 0 and empty.vacuum() == 0
    assert empty.retain(as_of) == 1 and empty.items().count() == 0


def test_insert_follows_the_rule_of_tables(spark, store, rows):
    assert seen(store.items()) == seen(rows)
    renamed = rows.withColumn("id", F.concat(F.lit("x"), "id"))
    later = rows.withColumn("ts", F.col("ts") + F.expr("INTERVAL 2 DAYS"))
    store.insert(renamed.union(later))
    assert seen(store.items()) == seen(tables.items_insert(rows, renamed.union(later)))
    before = store.version()
    store.insert(renamed.union(later))
    assert store.version() == before + 1 and seen(store.items()) == seen(store.items(version=before))


def test_insert_reads_no_text(store, rows, monkeypatch):
    opened = []
    plain = ItemStore._read
    monkeypatch.setattr(ItemStore, "_read", lambda self, parts, kind, schema: opened.append((kind, len(parts))) or plain(self, parts, kind, schema))
    known = store.parts()
    store.insert(rows)
    # items are read for their keys only where they were just written: nothing was new
    assert [k for k, n in opened] == ["keys", "items"] and opened[1][1] == 0
    assert store.parts() == known


def test_look_back_opens_its_days_only(store, rows, as_of):
    found = store.recent(as_of)
    days = {f.split("day=")[1][:10] for f in found.inputFiles()}
    assert days == {"2024-01-29", "2024-01-30"}
    assert len({f.split("day=")[1][:10] for f in store.items().inputFiles()}) == 30
    assert seen(found) == seen(rows.filter(F.col("ts") >= F.lit(as_of - timedelta(hours=36))))
    zoned = as_of.astimezone(timezone(timedelta(hours=9)))
    assert seen(store.recent(zoned)) == seen(found)


def test_days_do_not_follow_the_session(spark, rows):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
        store = ItemStore(spark, fresh_path(spark, "store"))
        store.insert(rows.limit(20))
        wanted = {datetime.fromtimestamp(r.s, timezone.utc).date().isoformat() for r in rows.limit(20).select(F.unix_seconds("ts").alias("s")).collect()}
        assert {p.day for p in store.parts()} == wanted
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_updates_are_narrow_and_the_last_holds(store, rows):
    some = rows.filter("cast(id as int) % 3 = 0")
    held = [p for p in store.parts() if p.kind == "items"]
    store.update(changes(some, "aa"))
    store.update(changes(some.filter("cast(id as int) % 2 = 0"), "bb"))
    assert [p for p in store.parts() if p.kind == "items"] == held
    first = tables.enrich_update(rows, changes(some, "aa"))
    wanted = tables.enrich_update(first, changes(some.filter("cast(id as int) % 2 = 0"), "bb"))
    assert seen(store.items()) == seen(wanted)
    before = store.version()
    store.compact()
    assert not [p for p in store.parts() if p.kind == "changes"]
    assert seen(store.items()) == seen(wanted) == seen(store.items(version=before))
    assert store.compact() == store.version()
    folders = store.vacuum(keep=1)
    assert folders > 0 and seen(store.items()) == seen(wanted)


def test_small_folders_of_a_day_become_one(spark, rows):
    store = ItemStore(spark, fresh_path(spark, "store"))
    for part in range(3):
        store.insert(rows.filter(f"cast(id as int) % 3 = {part}"))
    assert len([p for p in store.parts() if p.kind == "items"]) > 30
    store.compact()
    assert len([p for p in store.parts() if p.kind == "items"]) == 30
    assert seen(store.items()) == seen(rows)


def test_retention_reads_one_day(store, rows, as_of, monkeypatch):
    opened = []
    plain = ItemStore._merged
    monkeypatch.setattr(ItemStore, "_merged", lambda self, parts: opened.append({p.day for p in parts}) or plain(self, parts))
    store.update(changes(rows, "aa"))
    store.retain(as_of)
    assert opened == [{"2024-01-29"}]
    kept = tables.enrich_update(rows, changes(rows, "aa")).filter(F.col("ts") >= F.lit(as_of - timedelta(hours=36)))
    assert seen(store.items()) == seen(kept)
    opened.clear()
    store.retain(datetime(2024, 1, 31), 24)  # a limit between two days reads none
    assert opened == [] and {p.day for p in store.parts()} == {"2024-01-30"}
    # what is gone may come again, without the changes it had
    store.insert(rows)
    again = {r.id: r.lang for r in store.items().collect()}
    assert len(again) == rows.count() and set(again.values()) == {None, "aa"}
    store.retain(as_of, 0)
    assert store.items().count() == 0


def test_a_broken_write_changes_nothing(store, rows, monkeypatch):
    before, number = seen(store.items()), store.version()
    overflow = rows.withColumn("id", F.concat("id", F.lit("z"))).withColumn("title", (F.lit(2**31 - 1) + F.col("id").substr(1, 1).cast("int") * 0 + 1).cast("string"))
    with pytest.raises(Exception):
        store.insert(overflow)
    assert store.version() == number and seen(store.items()) == before

    def killed(self, base, parts):
        raise KeyboardInterrupt

    monkeypatch.setattr(ItemStore, "_publish", killed)
    for step in (lambda: store.update(changes(rows, "aa")), lambda: store.retain(datetime(2024, 1, 15, 7)), lambda: store.insert(rows.withColumns({"id": F.concat("id", F.lit("y")), "url": F.lit(None).cast("string")}))):
        with pytest.raises(KeyboardInterrupt):
            step()
        assert store.version() == number and seen(store.items()) == before
    monkeypatch.undo()
    store.update(changes(rows, "cc"))
    assert {r.lang for r in store.items().collect()} == {"cc"}


def test_only_one_writer_wins(spark, store, rows):
    late = ItemStore(spark, store.root)
    base, parts = late.version(), late.parts()
    store.update(changes(rows, "aa"))
    with pytest.raises(ConcurrentWrite):
        late._publish(base, parts)
    assert {r.lang for r in late.items().collect()} == {"aa"}
    assert not [n for n in (s.getPath().getName() for s in late._listed("versions")) if n.startswith("draft")]


def test_run_on_a_store_equals_the_run_on_tables(spark, store, rows, as_of):
    clusters = fx.stored_clusters(spark, SF)
    settings = stages.Settings(hours=24 * 31, keep_hours=24 * 25)
    args = dict(entries=fx.feed_entries(spark, SF), settings=settings)
    plain = stages.run_stages(rows, clusters, as_of, fx.BOOK, **args)
    stored = stages.run_store(store, clusters, as_of, fx.BOOK, **args)
    assert seen(stored.items) == seen(plain.items)
    assert sorted(map(str, stored.members.collect())) == sorted(map(str, plain.members.collect()))
    assert sorted(map(str, stored.stats.collect())) == sorted(map(str, plain.stats.collect()))


def test_only_new_rows_are_shuffled_with_their_texts(spark, store, rows, monkeypatch):
    """Rows that are there, lose to an earlier one or come twice stay where they are read; rows without url are new."""
    from docwatch.sources import store as module

    met, worked = [], module.winning_rows
    monkeypatch.setattr(module, "winning_rows", lambda near, won: met.append((near.count(), won.count())) or worked(near, won))
    before = store.items().count()
    more = rows.filter("url is null and cast(id as long) % 5 = 0").withColumn("id", F.concat(F.lit("n"), "id"))
    later = more.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    incoming = rows.union(more).union(more).union(later)
    wanted = tables.new_items(store.items(), incoming).count()
    store.insert(incoming)
    assert store.items().count() == before + wanted and 0 < wanted <= 30
    assert met[0][1] == wanted and met[0][0] <= 2 * wanted + 2 < incoming.count()
    # texts are dealt by id and digest once, and not again for equal rows
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        marked = tables.with_digest(spark.read.schema(rows.schema).parquet(fresh(spark, incoming)))
        won = spark.read.schema("id string, _won string").parquet(fresh(spark, tables.winners(store.items().limit(0), marked)))
        plan = tables.winning_rows(marked, won)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 2


def fresh(spark, frame):
    path = fresh_path(spark, "frame")
    frame.write.parquet(path)
    return path
