"""The items table as folders by day, with versions.

Every write goes to new folders, divided by the day of ``ts``; a version is a small
file that lists the folders which count, and is put in place by one rename. A reader
of a version never sees half a write, and a run that breaks off leaves the version
before it as it was.

* ``items``: whole rows.
* ``keys``: ``id, url, ts`` of the same rows. Inserting reads these, no text.
* ``changes``: ``id`` and the fields that enrichment sets, with the number of the
  version that set them. They are merged when items are read; the last one holds.

A look-back opens the folders of its days only. Retention drops the folders of whole
days unread and rewrites the one day that the limit cuts. :func:`ItemStore.compact`
folds changes and small folders of a day into one write.

Two writers that start from one version can't both succeed: the second rename fails
and raises :class:`ConcurrentWrite`, with nothing changed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docwatch.operators.key_filter import with_may_be_in
from docwatch.operators.tables import LOOKBACK_HOURS, enrich_update, winners, winning_rows, with_digest
from docwatch.schema import ITEMS
from docwatch.session import discard, instant, materialize, put_once

FIELDS = ("lang", "lang_conf", "topics", "keywords")
CHANGES = "id string, version long, lang string, lang_conf float, topics array<string>, keywords array<string>"
KEYS = "id string, url string, ts timestamp"


class ConcurrentWrite(RuntimeError):
    """Another writer has put the next version in place."""


@dataclass(frozen=True, order=True)
class Part:
    """The folder of one write and one day."""

    kind: str
    day: str
    write: str

    @property
    def path(self) -> str:
        return f"{self.kind}/write={self.write}/day={self.day}"


class ItemStore:
    """The store below ``root``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType = ITEMS) -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    # ---- versions ----

    def version(self) -> int:
        """The number of the last version; 0 before the first write."""
        names = [s.getPath().getName() for s in self._listed("versions")]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def parts(self, version: int | None = None) -> list[Part]:
        number = self.version() if version is None else version
        if number == 0:
            return []
        rows = self.spark.read.schema("kind string, day string, write string").json(f"{self.root}/versions/{number:012d}")
        return sorted(Part(r.kind, r.day, r.write) for r in rows.collect())

    def _publish(self, base: int, parts: Iterable[Part]) -> int:
        """Put the version after ``base`` in place, unless somebody else has."""
        number = base + 1
        lines = "".join(json.dumps(asdict(p)) + "\n" for p in sorted(parts))
        if not put_once(self.spark, f"{self.root}/versions/{number:012d}", lines):
            raise ConcurrentWrite(f"version {number} was written meanwhile")
        return number

    # ---- reading ----

    def _read(self, parts: list[Part], kind: str, schema: StructType | str) -> DataFrame:
        paths = [f"{self.root}/{p.path}" for p in parts if p.kind == kind]
        empty = self.spark.createDataFrame([], schema)
        if not paths:
            return empty
        rows = self.spark.read.schema(empty.schema).option("basePath", f"{self.root}/{kind}").parquet(*paths)
        return rows.select(empty.columns)

    def _merged(self, parts: list[Part]) -> DataFrame:
        rows = self._read(parts, "items", self.schema)
        if not any(p.kind == "changes" for p in parts):
            return rows
        last = F.max_by(F.struct(*FIELDS), "version").alias("last")
        changes = self._read(parts, "changes", CHANGES).groupBy("id").agg(last).select("id", "last.*")
        return enrich_update(rows, changes)

    def items(self, since: datetime | None = None, version: int | None = None) -> DataFrame:
        """All items, or those from ``since`` on; only the folders of their days are opened."""
        parts = self.parts(version)
        if since is None:
            return self._merged(parts)
        first = _day_of(since)
        return self._merged([p for p in parts if p.day >= first]).filter(F.col("ts") >= instant(since))

    def recent(self, as_of: datetime, hours: int = LOOKBACK_HOURS) -> DataFrame:
        return self.items(as_of - timedelta(hours=hours))

    # ---- writing ----

    def _write(self, rows: DataFrame, kind: str) -> list[Part]:
        """Rows with ``ts`` or ``day`` to new folders; a day's rows are spread by their number."""
        write = uuid.uuid4().hex
        dated = rows if "day" in rows.columns else rows.withColumn("day", _day())
        path = f"{self.root}/{kind}/write={write}"
        dated.hint("rebalance", "day").write.partitionBy("day").parquet(path)
        names = [s.getPath().getName() for s in self._listed(f"{kind}/write={write}")]
        return [Part(kind, n.removeprefix("day="), write) for n in names if n.startswith("day=")]

    def _write_items(self, rows: DataFrame) -> list[Part]:
        """Items and their keys; the keys come from what was written, so both agree."""
        written = self._write(_typed(rows, self.schema), "items")
        keys = self._read(written, "items", self.schema).select("id", "url", "ts")
        return written + self._write(keys, "keys")

    def insert(self, incoming: DataFrame) -> int:
        """Add the rows whose id and url are new, by the rule of :func:`new_items`; gives the version."""
        base = self.version()
        parts = self.parts(base)
        marked = with_digest(incoming)
        won = materialize(winners(self._read(parts, "keys", KEYS), marked), "winners")
        # most rows that aren't new are left where they are read, and only others are shuffled with their texts
        chosen = won.select("id", F.col("_won").alias("_digest"))
        near = with_may_be_in(marked, chosen, ["id", "_digest"], "_met").filter("_met").drop("_met")
        version = self._publish(base, parts + self._write_items(winning_rows(near, won)))
        discard(won)
        return version

    def update(self, enriched: DataFrame) -> int:
        """Set language and topics of items; ``enriched`` has ``id, ts`` and the fields. No text is written."""
        base = self.version()
        rows = enriched.withColumn("version", F.lit(base + 1))
        dated = _typed(rows, self.spark.createDataFrame([], CHANGES).schema, _day().alias("day"))
        return self._publish(base, self.parts(base) + self._write(dated, "changes"))

    def retain(self, as_of: datetime, hours: int = LOOKBACK_HOURS) -> int:
        """Drop what is older; ``hours=0`` drops all. Reads no day but the one the limit cuts."""
        base = self.version()
        if hours <= 0:
            return self._publish(base, [])
        limit = as_of - timedelta(hours=hours)
        cut = _day_of(limit)
        parts = [p for p in self.parts(base) if p.day >= cut]
        at_cut = [p for p in parts if p.day == cut]
        if not at_cut or _utc(limit) == _start_of(cut):
            return self._publish(base, parts)
        kept = self._write_items(self._merged(at_cut).filter(F.col("ts") >= instant(limit)))
        return self._publish(base, [p for p in parts if p.day > cut] + kept)

    def compact(self, folders: int = 1) -> int:
        """Days with changes, or with more than so many folders of items, become one write."""
        base = self.version()
        parts = self.parts(base)
        days = {p.day for p in parts if p.kind == "changes"}
        days |= {d for d in {p.day for p in parts} if sum(p.day == d and p.kind == "items" for p in parts) > folders}
        if not days:
            return base
        worked = [p for p in parts if p.day in days]
        return self._publish(base, [p for p in parts if p.day not in days] + self._write_items(self._merged(worked)))

    def vacuum(self, keep: int = 2) -> int:
        """Delete versions before the last ``keep``, and folders only those name; gives how many folders went.

        Folders that no version names may belong to a writer at work, and stay.
        """
        last = self.version()
        names = sorted(int(n) for n in (s.getPath().getName() for s in self._listed("versions")) if n.isdigit())
        old = [n for n in names if n <= last - keep]
        kept = {p for n in names if n > last - keep for p in self.parts(n)}
        gone = {p for n in old for p in self.parts(n)} - kept
        for part in sorted(gone):
            self._files().delete(self._path(part.path), True)
        for number in old:
            self._files().delete(self._path(f"versions/{number:012d}"), False)
        return len(gone)

    # ---- folders ----

    def _settings(self):
        return self.spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self._settings())

    def _listed(self, name: str) -> list:
        path = self._path(name)
        return list(self._files().listStatus(path)) if self._files().exists(path) else []


def _typed(rows: DataFrame, schema: StructType, *more: Column) -> DataFrame:
    """The columns of the schema, in its types, and others."""
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *more)


def _day() -> Column:
    """The UTC day of ``ts``, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros("ts") / F.lit(86_400_000_000)).cast("int"))


def _utc(moment: datetime) -> datetime:
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)


def _day_of(moment: datetime) -> str:
    return _utc(moment).date().isoformat()


def _start_of(day: str) -> datetime:
    return datetime.combine(date.fromisoformat(day), datetime.min.time(), timezone.utc)
