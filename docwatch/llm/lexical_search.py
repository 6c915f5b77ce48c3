"""Ranked lexical search: Block-Max MaxScore over shards of an inverted index.

**Index.** A task cuts its documents into shards of a bounded number of bytes. In a
shard documents are numbered in the order of their ids, and each term has a row: its
postings (document number, frequency) in blocks of 128, byte-coded as gaps, and for
each block its last document, its largest frequency and its shortest document. The
index holds every term of every row and needs no shuffle; it is a table that any
number of searches may read.

**Search.** The terms of the items, weighted by what the whole index counts, meet the
index on the term; a shard's lists then meet a lot of items in one task. For each
item the shard is gone through in windows of documents, the window with the largest
sum of block maxima first. In a window, lists in the order of their global bounds are
split at the score of the last place: those whose bounds together stay below it are
non-essential. Only essential lists bring candidates; non-essential lists are then
added from the largest bound down, and a list's blocks are decompressed only if some
candidate could still get in with the block maxima that are left. The heaps of the
shards are merged in the end, in two steps that each keep ``k`` rows an item before
they shuffle.

Scores are 64-bit integers, see :func:`impact`; bounds are scores of the largest
frequency in the shortest document, so nothing is lost by rejecting below the last
place, and equal scores are never rejected, as the smaller id wins.

Defined cases: a null text, or one without terms, is no document and an item without
terms has no rows; rows of one ``item_id`` are one item with the terms of all of
them; repeated documents are ranked one after the other; null ids come last among
equal scores; an empty table gives an empty one; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docwatch.llm.shingles import slices
from docwatch.session import materialize

BLOCK = 128
WINDOW = 512
SHARD_BYTES = 8 << 20
SHARD_ROWS = 1 << 16
LOT_TERMS = 20_000

# Bytes of A-Z become a-z; every other ASCII character that is no letter or digit becomes a space.
_ASCII = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


@dataclass(frozen=True)
class Index:
    """``lists``: a row per shard and term. ``shards``: a row per shard with its documents' ids and lengths."""

    lists: DataFrame
    shards: DataFrame


@dataclass(frozen=True)
class Collection:
    """``n`` documents with a term, ``terms`` of them in all."""

    n: int
    terms: int


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts in order, and how many each has."""
    filled = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(filled.buffers()[1], dtype=np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    raw = bytes(data)[offsets[0] : offsets[-1]] if data is not None and len(filled) else b""
    lowered = raw.translate(_ASCII)
    again = pa.LargeStringArray.from_buffers(len(filled), pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(lowered))
    split = pc.ascii_split_whitespace(again)
    flat = split.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    owner = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    kept = real.to_numpy(zero_copy_only=False)
    return flat.filter(real), np.bincount(owner[kept], minlength=len(texts))


# ---- byte codes ----------------------------------------------------------------


def byte_code(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits a byte, low bits first, the last byte of a number below 128; and the bytes of each."""
    size = np.ones(len(values), dtype=np.int64)
    for bits in (7, 14, 21, 28):
        size += values >= 1 << bits
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    for j in range(int(size.max()) if len(size) else 0):
        has = size > j
        more = size[has] > j + 1
        out[(ends - size)[has] + j] = ((values[has] >> (7 * j)) & 127) | (more * 128)
    return out, size


def byte_decode(raw: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(raw < 128)
    first = np.concatenate([[0], last[:-1] + 1])
    values = np.zeros(len(last), dtype=np.int64)
    size = last - first + 1
    for j in range(int(size.max()) if len(size) else 0):
        has = size > j
        values[has] |= (raw[first[has] + j].astype(np.int64) & 127) << (7 * j)
    return values


# ---- index ---------------------------------------------------------------------

LISTS = (
    "shard long, term string, df long, last array<int>, most array<int>, shortest array<int>, "
    "ends array<int>, postings binary"
)


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> Index:
    """The index of ``docs(doc_id, text)``, written. Shards follow how rows lie; results don't depend on it."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"{LISTS}, doc_ids array<{id_type}>, lengths array<int>"
    id_arrow: list[pa.DataType] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 33
        held: list[pa.RecordBatch] = []
        size = rows = 0
        for batch in batches:
            for part in slices(batch, "text", shard_bytes):
                own = pc.sum(pc.binary_length(part["text"])).as_py() or 0
                if held and (size + own > shard_bytes or rows + part.num_rows > SHARD_ROWS):
                    yield from _shard(held, shard)
                    held, size, rows, shard = [], 0, 0, shard + 1
                held.append(part)
                size, rows = size + own, rows + part.num_rows
        if held:
            yield from _shard(held, shard)

    table = materialize(docs.select("doc_id", "text").mapInArrow(run, schema), "index")
    lists = table.filter("term is not null").drop("doc_ids", "lengths")
    return Index(lists, table.filter("term is null").select("shard", "doc_ids", "lengths"))


def _shard(held: list[pa.RecordBatch], shard: int) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(held).combine_chunks()
    table = table.take(pc.sort_indices(table, sort_keys=[("doc_id", "ascending")], null_placement="at_end"))
    texts = table["text"].combine_chunks() if table.num_rows else table["text"]
    texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
    terms, counts = terms_of(texts)
    filled = np.flatnonzero(counts)
    lengths = counts[filled]
    if not len(filled):
        return
    ids = table["doc_id"].take(pa.array(filled)).combine_chunks()
    ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
    coded = terms.dictionary_encode()
    words = coded.dictionary.cast(pa.string())
    doc = np.repeat(np.arange(len(filled)), lengths)
    pairs, tf = np.unique(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(filled) + doc, return_counts=True)
    term, doc = pairs // len(filled), pairs % len(filled)
    df = np.bincount(term, minlength=len(words))
    starts = np.cumsum(df) - df
    rank = np.arange(len(pairs)) - starts[term]
    opens = rank % BLOCK == 0
    gap = np.where(opens, doc, doc - np.concatenate([[0], doc[:-1]]))
    raw, size = byte_code(np.column_stack([gap, tf]).ravel())
    bytes_to = np.cumsum(size)[1::2]
    block = np.flatnonzero(opens)
    closes = np.append(block[1:], len(pairs)) - 1
    per_term = -(-df // BLOCK)
    before = np.concatenate([[0], bytes_to])[starts]
    block_ends = bytes_to[closes] - np.repeat(before, per_term)
    blocks = pa.array(np.concatenate([[0], np.cumsum(per_term)]).astype(np.int32))

    def per_block(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(blocks, pa.array(values.astype(np.int32)))

    offsets = np.concatenate([before, bytes_to[-1:]]).astype(np.int32)
    names = ["shard", "term", "df", "last", "most", "shortest", "ends", "postings", "doc_ids", "lengths"]
    none_ids = pa.nulls(len(words), pa.list_(ids.type))
    columns = [
        pa.array(np.full(len(words), shard)),
        words,
        pa.array(df.astype(np.int64)),
        per_block(doc[closes]),
        per_block(np.maximum.reduceat(tf, block)),
        per_block(np.minimum.reduceat(lengths[doc], block)),
        per_block(block_ends),
        pa.BinaryArray.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes())]),
        none_ids,
        pa.nulls(len(words), pa.list_(pa.int32())),
    ]
    rows = pa.RecordBatch.from_arrays(columns, names=names)
    step = 20_000
    for at in range(0, rows.num_rows, step):
        yield rows.slice(at, step)
    whole = pa.array([0, len(ids)], pa.int32())
    about = [pa.nulls(1, c.type) for c in columns[1:8]]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([shard], pa.int64()),
            *about,
            pa.ListArray.from_arrays(whole, ids),
            pa.ListArray.from_arrays(whole, pa.array(lengths.astype(np.int32))),
        ],
        names=names,
    )


def collection(index: Index) -> Collection:
    sums = index.shards.agg(
        F.sum(F.size("lengths").cast("long")).alias("n"),
        F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x)).alias("terms"),
    ).first()
    return Collection(sums.n or 0, sums.terms or 0)


# ---- scores --------------------------------------------------------------------


def weight(df: Column, n: int) -> Column:
    return F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * df + 1))).cast("long")


def impact(w: np.ndarray | int, tf: np.ndarray, length: np.ndarray, known: Collection) -> np.ndarray:
    """What a term of weight ``w`` adds; grows with ``tf`` and falls with the document's length."""
    m = 50 + (50 * length.astype(np.int64) * known.n) // max(known.terms, 1)
    return w * ((1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 20 * m))


class List:
    """One term's postings in a shard. Blocks are decoded when asked for, once."""

    def __init__(self, row: dict, w: int, known: Collection, lengths: np.ndarray, windows: int) -> None:
        self.w, self.known, self.lengths = w, known, lengths
        self.last, self.ends = np.array(row["last"]), np.array(row["ends"])
        self.first = np.concatenate([[0], self.last[:-1] + 1])
        self.raw = np.frombuffer(row["postings"], dtype=np.uint8)
        bounds = impact(w, np.array(row["most"]), np.array(row["shortest"]), known)
        self.bound = int(bounds.max())
        self.by_window = np.zeros(windows, dtype=np.int64)
        a, b = self.first // WINDOW, self.last // WINDOW
        for j in range(int((b - a).max()) + 1):
            inside = a + j <= b
            np.maximum.at(self.by_window, (a + j)[inside], bounds[inside])
        self.decoded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self.decoded:
            values = byte_decode(self.raw[self.ends[i - 1] if i else 0 : self.ends[i]])
            docs = np.cumsum(values[0::2])
            self.decoded[i] = docs, impact(self.w, values[1::2], self.lengths[docs], self.known)
        return self.decoded[i]

    def between(self, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``start`` up to ``stop`` and what the term adds to each."""
        a = int(np.searchsorted(self.last, start))
        b = min(int(np.searchsorted(self.last, stop - 1)), len(self.last) - 1)
        parts = [self.block(i) for i in range(a, b + 1)]
        if not parts:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        docs = parts[0][0] if len(parts) == 1 else np.concatenate([p[0] for p in parts])
        adds = parts[0][1] if len(parts) == 1 else np.concatenate([p[1] for p in parts])
        lo, hi = np.searchsorted(docs, (start, stop))
        return docs[lo:hi], adds[lo:hi]


def search_shard(lists: list[List], documents: int, k: int) -> list[tuple[int, int]]:
    """The best ``k`` documents of a shard for one item: ``(number, score)``, best first."""
    lists = sorted(lists, key=lambda x: x.bound)
    bounds = np.array([x.bound for x in lists])
    below = np.cumsum(bounds)
    maxima = np.array([x.by_window for x in lists])
    sums = maxima.sum(axis=0)
    best_docs, best = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    last = 1
    for w in np.argsort(-sums, kind="stable").tolist():
        if sums[w] < last:
            break
        start, stop = w * WINDOW, min((w + 1) * WINDOW, documents)
        # bounds of the first lists together stay below the last place
        essential = int(np.searchsorted(below, last, side="left"))
        score = np.zeros(stop - start, dtype=np.int64)
        for j in range(essential, len(lists)):
            if maxima[j, w]:
                docs, adds = lists[j].between(start, stop)
                score[docs - start] += adds
        left = int(maxima[:essential, w].sum())
        alive = np.flatnonzero((score > 0) & (score + left >= last))
        for j in range(essential - 1, -1, -1):
            if not len(alive):
                break
            if maxima[j, w]:
                docs, adds = lists[j].between(start, stop)
                score[docs - start] += adds
                left -= int(maxima[j, w])
                alive = alive[score[alive] + left >= last]
        if len(alive):
            best_docs = np.concatenate([best_docs, alive + start])
            best = np.concatenate([best, score[alive]])
            if len(best) > k:
                keep = np.lexsort((best_docs, -best))[:k]
                best_docs, best = best_docs[keep], best[keep]
            if len(best) == k:
                last = max(int(best.min()), 1)
    order = np.lexsort((best_docs, -best))
    return list(zip(best_docs[order].tolist(), best[order].tolist()))


# ---- search --------------------------------------------------------------------


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term``, each term once an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                terms, counts = terms_of(part["text"])
                owner = part["item_id"].take(pa.array(np.repeat(np.arange(len(counts)), counts)))
                yield pa.RecordBatch.from_arrays([owner, terms.cast(pa.string())], names=["item_id", "term"])

    id_type = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(run, f"item_id {id_type}, term string").distinct()


def search(index: Index, items: DataFrame, k: int = 50) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each row of ``items(item_id, text)``."""
    known = collection(index)
    asked = materialize(item_terms(items), "item-terms")
    # the terms of the index that are asked for; every other list stays unread past its name
    found = index.lists.join(asked.select("term").distinct(), "term", "left_semi")
    found = materialize(found, "asked-lists")
    weights = found.groupBy("term").agg(F.sum("df").alias("df")).select("term", weight(F.col("df"), known.n).alias("w"))
    lots = max(1, -(-asked.count() // LOT_TERMS))
    lot = F.pmod(F.xxhash64("item_id"), F.lit(lots)).alias("lot")
    weighted = asked.join(weights.filter("w > 0"), "term").select(lot, "term", "w", "item_id")
    wanted = materialize(weighted.groupBy("lot", "term", "w").agg(F.collect_list(F.struct("item_id")).alias("items")), "weighted")
    lists = found.join(wanted, "term").drop("term", "df")
    every_lot = F.explode(F.sequence(F.lit(0), F.lit(lots - 1)).cast("array<bigint>")).alias("lot")
    shards = index.shards.select("shard", "doc_ids", "lengths", every_lot)
    item_type = items.schema["item_id"].dataType.simpleString()
    doc_type = index.shards.schema["doc_ids"].dataType.elementType.simpleString()

    def run(key: tuple, lists: pa.Table, shard: pa.Table) -> pa.Table:
        rows = []
        doc_ids = shard["doc_ids"][0].values
        lengths = shard["lengths"][0].values.to_numpy(zero_copy_only=False)
        windows = -(-len(lengths) // WINDOW)
        by_item: dict = {}
        for row in lists.to_pylist():
            one = List(row, row["w"], known, lengths, windows)
            for item in row["items"]:
                by_item.setdefault(item["item_id"], []).append(one)
        for item, own in by_item.items():
            rows.extend((item, number, score) for number, score in search_shard(own, len(lengths), k))
        numbers = pa.array([r[1] for r in rows], pa.int64())
        return pa.table(
            {
                "item_id": pa.array([r[0] for r in rows], lists.schema.field("items").type.value_type.field(0).type),
                "doc_id": doc_ids.take(numbers),
                "score": pa.array([r[2] for r in rows], pa.int64()),
                "shard": pa.array([shard["shard"][0].as_py()] * len(rows), pa.int64()),
            }
        )

    heaps = (
        lists.groupBy("shard", "lot")
        .cogroup(shards.groupBy("shard", "lot"))
        .applyInArrow(run, f"item_id {item_type}, doc_id {doc_type}, score long, shard long")
    )
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = F.pmod(F.xxhash64("shard"), F.lit(64))
    nearly = heaps.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", some).orderBy(*order)))
    nearly = nearly.filter(F.col("rank") <= k).select("item_id", "doc_id", "score")
    ranked = nearly.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
