"""Repeated passages, by hashing lines, paragraphs or phrases.

A text is cut into units; a unit is normalised (A-Z in lower case, single spaces)
and digested to 128 bits. Digests are grouped over all documents: the occurrence
of the smallest ``(doc_id, place)`` stays, every other is removed, and its place in
the original text is reported, so nothing about the original is lost.

A passage may stand inside a line, or across line ends that differ.
:func:`without_passages` therefore cuts a text twice, into lines and into phrases: a
phrase ends after each word whose own digest falls into a fifth of all digests, so
equal passages are cut alike wherever they stand. Phrases of one or two words aren't
compared: they are very common and tell nothing. Neighbouring repeated units are
joined to runs, and runs of ``min_words`` words go, with the short phrases between. Of
a passage, the words before its first and after its last compared phrase may stay:
five on either side on average. These units have digests of 64 bits: among ``n``
different units about ``n * n / 2 ** 65`` pairs look alike, and a run of phrases is many
units, which would all have to.

Only digests are shuffled, and texts once more where something is taken out. The
first occurrence is a minimum and so combines before the shuffle; where a digest is
as common as a third of all units, its rows meet a one-row table, and that join can
be split.

Defined cases: a null or empty text has no units; units of fewer than
``min_words`` words always stay; a null ``doc_id`` comes after every other; rows
alike in id and text share their first occurrences, which stay in each of them; an
empty table gives an empty one; columns other than ``doc_id`` and ``text`` are
carried along unseen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docwatch.llm.shingles import slices
from docwatch.session import materialize

SEPARATORS = {"line": "\n", "paragraph": "\n\n"}
MIN_WORDS = 10
BATCH_UNITS = 50_000
RUN_WORDS = 30
#: A phrase ends after a word whose md5 is below this, as hexadecimal text.
PHRASE_END = "33"
LINE, PHRASE = 0, 1


def units_of(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, place, start, length, n_words, high, low`` of the units long enough.

    ``start`` and ``length`` are in code points of the original text; ``high`` and
    ``low`` are the digest.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "place", "start", "length", "n_words", "high", "low"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                if text.is_valid:
                    rows.extend((doc_id.as_py(), *x) for x in _units(text.as_py(), SEPARATORS[unit], min_words))
                if len(rows) >= BATCH_UNITS:
                    yield _batch(rows, names, batch.schema.field("doc_id").type)
                    rows = []
            yield _batch(rows, names, batch.schema.field("doc_id").type)

    schema = f"doc_id {id_type}, place long, start long, length long, n_words long, high long, low long"
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def _units(text: str, separator: str, min_words: int) -> Iterator[tuple]:
    start = 0
    for place, raw in enumerate(text.split(separator)):
        parts = raw.encode("utf-8").lower().split()
        if len(parts) >= max(min_words, 1):
            value = xxhash.xxh3_128_digest(b" ".join(parts))
            high = int.from_bytes(value[:8], "big", signed=True)
            low = int.from_bytes(value[8:], "big", signed=True)
            yield place, start, len(raw), len(parts), high, low
        start += len(raw) + len(separator)


def _batch(rows: list[tuple], names: list[str], id_type: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    types = [id_type, *[pa.int64()] * 6]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def repeated_units(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per unit to remove: ``doc_id, place, start, length, n_words`` and
    ``keep_id, keep_start``, where the same unit stays."""
    units = materialize(units_of(docs, unit, min_words), "units")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "place", "start"))
    groups = units.groupBy("high", "low").agg(F.count("*").alias("n"), first.alias("first")).filter("n > 1")
    groups = groups.select(
        "high",
        "low",
        F.col("first.doc_id").alias("keep_id"),
        F.col("first.place").alias("keep_place"),
        F.col("first.start").alias("keep_start"),
    )
    groups = materialize(groups, "repeats")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("place") == F.col("keep_place"))
    return units.join(groups, ["high", "low"]).filter(~stays).drop("high", "low", "keep_place")


def remove_repeats(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the repeated units, and ``removed``: their places in the original text.

    A place is ``start, length`` in code points. A name ``removed`` that ``docs``
    already has gives way.
    """
    spans = repeated_units(docs, unit, min_words).select("doc_id", "place", "start", "length").distinct()
    per_doc = spans.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("spans"))
    per_doc = materialize(per_doc.withColumnRenamed("doc_id", "_id"), "spans")
    rows = docs.drop("removed").select(F.struct("*").alias("row"))
    joined = rows.join(per_doc, F.col("row.doc_id").eqNullSafe(F.col("_id")), "left")
    size = len(SEPARATORS[unit])

    @F.arrow_udf("string")
    def without(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([_cut(t, s, size) for t, s in zip(texts.to_pylist(), spans.to_pylist())], pa.string())

    text = F.col("row.text")
    shorter = F.when(F.col("spans").isNull(), text).otherwise(without(text, "spans"))
    kept = [shorter.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c != "removed"]
    return joined.select(*kept, "spans").withColumnRenamed("spans", "removed")


def _cut(text: str | None, spans: list[dict] | None, separator: int) -> str | None:
    if text is None or not spans:
        return text
    parts, at = [], 0
    for span in spans:
        parts.append(text[at : span["start"]])
        at = span["start"] + span["length"] + separator
    parts.append(text[at:])
    joined = "".join(parts)
    ended = spans[-1]["start"] + spans[-1]["length"] == len(text)
    return joined[:-separator] if ended and joined else joined


# ---- passages ------------------------------------------------------------------

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
PASSAGE_UNITS = "kind int, place long, start long, length long, n_words long, digest long"
LEAST_PHRASE = 3


def passage_units(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, kind, place, start, length, n_words, digest``: lines, and phrases that are compared.

    ``place`` counts these units of a kind in a text, without blank lines; a unit
    reaches from its first to its last word, in code points of the original text.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                for units in _cut_both(part):
                    for at in range(0, units.num_rows, BATCH_UNITS):
                        yield units.slice(at, BATCH_UNITS)

    rows = docs.filter("text is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(cut, f"doc_id {id_type}, text_hash long, {PASSAGE_UNITS}")


def _cut_both(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    texts = batch["text"].cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = bytes(data)[offsets[0] : offsets[-1]].translate(_LOWER) if data is not None else b""
    offsets = offsets - offsets[0]
    lowered = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw))
    words = pc.ascii_split_whitespace(lowered).flatten()
    words = words.filter(pc.greater(pc.binary_length(words), 0)).dictionary_encode()
    code = words.indices.to_numpy(zero_copy_only=False)
    if not len(code):
        return
    known = words.dictionary.cast(pa.large_binary()).to_pylist()
    ends_phrase = np.array([hashlib.md5(w).hexdigest()[: len(PHRASE_END)] < PHRASE_END for w in known])[code]
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in known], dtype=np.uint64)[code]
    # where words lie: bytes first, then code points and line numbers of their texts
    chars = np.frombuffer(raw, dtype=np.uint8)
    blank = _BLANK[chars]
    opens = np.zeros(len(chars) + 1, dtype=bool)
    opens[offsets] = True
    starts = np.flatnonzero(~blank & (opens[:-1] | np.concatenate([[True], blank[:-1]])))
    stops = np.flatnonzero(~blank & (opens[1:] | np.concatenate([blank[1:], [True]]))) + 1
    owner = np.searchsorted(offsets, starts, side="right") - 1
    point = np.concatenate([[0], np.cumsum((chars & 0xC0) != 0x80)])
    line = np.cumsum(chars == 10)[starts]
    first_point = point[offsets[owner]]
    start, stop = point[starts] - first_point, point[stops] - first_point
    new_text = np.concatenate([[True], owner[1:] != owner[:-1]])
    new_line = np.concatenate([[True], line[1:] != line[:-1]])
    new_phrase = np.concatenate([[True], ends_phrase[:-1]])
    for kind, opening in ((LINE, new_text | new_line), (PHRASE, new_text | new_phrase)):
        first = np.flatnonzero(opening)
        n = np.diff(np.append(first, len(code)))
        seat = (np.arange(len(code)) - np.repeat(first, n)).astype(np.uint64)
        digest = _mixed(np.add.reduceat(_mixed(hashes + (2 * seat + np.uint64(kind)) * _STEP), first) + n.astype(np.uint64))
        long_enough = n >= (LEAST_PHRASE if kind == PHRASE else 1)
        first, n, digest = first[long_enough], n[long_enough], digest[long_enough]
        who = owner[first]
        unit = np.arange(len(first))
        place = unit - np.searchsorted(who, who, side="left")
        rows = pa.array(who)
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"].take(rows),
                batch["text_hash"].take(rows),
                pa.array(np.full(len(first), kind, dtype=np.int32)),
                pa.array(place),
                pa.array(start[first]),
                pa.array(stop[first + n - 1] - start[first]),
                pa.array(n),
                pa.array(digest.view(np.int64)),
            ],
            names=["doc_id", "text_hash", "kind", "place", "start", "length", "n_words", "digest"],
        )


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated_runs(docs: DataFrame, min_words: int = RUN_WORDS) -> DataFrame:
    """``doc_id, text_hash, start, length, n_words``: runs of units that stay elsewhere, lines and phrases apart."""
    units = materialize(passage_units(docs), "passage-units")
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "place")
    groups = units.groupBy("digest").agg(F.count("*").alias("n"), F.min(key).alias("first")).filter("n > 1")
    groups = materialize(groups.select("digest", "first"), "repeats")
    gone = units.join(groups, "digest").filter(key != F.col("first")).drop("digest", "first")
    # one shuffle by text and kind serves both windows and the runs
    along = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("place")
    # rows alike in id and text have the same units twice
    once = gone.withColumn("before", F.lag("place").over(along)).filter(~F.col("place").eqNullSafe(F.col("before")))
    runs = once.withColumn("run", F.col("place") - F.row_number().over(along)).groupBy("doc_id", "text_hash", "kind", "run")
    spans = runs.agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("length")).alias("stop"), F.sum("n_words").alias("n_words")
    )
    return spans.filter(F.col("n_words") >= min_words).select(
        "doc_id", "text_hash", "start", (F.col("stop") - F.col("start")).alias("length"), "n_words"
    )


def without_passages(docs: DataFrame, min_words: int = RUN_WORDS) -> DataFrame:
    """Every row of ``docs`` without its repeated passages, with ``removed`` and ``kept``.

    ``removed`` holds ``start, length`` of what went, in code points of the original
    text, in order and apart; ``kept`` says that the whole text stays. Columns of
    ``docs`` with these names give way.
    """
    spans = repeated_runs(docs, min_words).groupBy("doc_id", "text_hash")
    spans = spans.agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("spans"))
    spans = materialize(spans.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"}), "spans")
    carried = [c for c in docs.columns if c not in ("removed", "kept")]
    rows = docs.select(F.struct(*carried).alias("row"), F.xxhash64("text").alias("hash"))
    same = F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))

    @F.arrow_udf("struct<text string, removed array<struct<start long, length long>>>")
    def taken_out(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([_taken_out(t, s) for t, s in zip(texts.to_pylist(), spans.to_pylist())], _TAKEN)

    joined = rows.join(spans, same, "left")
    cut = joined.withColumn("cut", F.when(F.col("spans").isNotNull(), taken_out(F.col("row.text"), F.col("spans"))))
    none = F.array().cast("array<struct<start:bigint,length:bigint>>")
    kept = F.col("spans").isNull()
    return cut.select(
        *[
            F.when(kept, F.col("row.text")).otherwise(F.col("cut.text")).alias(c) if c == "text" else F.col("row")[c].alias(c)
            for c in carried
        ],
        F.coalesce("cut.removed", none).alias("removed"),
        kept.alias("kept"),
    )


_TAKEN = pa.struct([("text", pa.string()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))])


def _taken_out(text: str | None, spans: list[dict] | None) -> dict | None:
    if text is None or not spans:
        return None
    joined: list[list[int]] = []
    for span in spans:
        start, stop = span["start"], span["start"] + span["length"]
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], stop)
        else:
            joined.append([start, stop])
    edges = [0, *[x for span in joined for x in span], len(text)]
    left = "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
    return {"text": left, "removed": [{"start": a, "length": b - a} for a, b in joined]}
