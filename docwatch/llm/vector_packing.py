"""Best-fit packing by residual vectors: tokens, documents and attention cost.

A document is its token ids and a closing id. Only documents longer than a sequence
are cut, into whole sequences, with what is over as the first piece. The other
pieces, longest first, go to a sequence that has room for them in every capacity:

* ``tokens``, the length of a sequence;
* ``documents``, how many pieces it may hold;
* ``cost``, the sum of squared piece lengths, which is what attention inside the
  pieces costs.

Among those with room, ``rule="residual"`` takes the sequence whose capacities left
over, each as a share of the whole and times its weight, have the smallest norm;
``rule="dot"`` takes the largest weighted dot product of the piece's demand with what
is left. A new sequence is opened where none has room.

Texts are read once, where they lie, for a narrow table of pieces; this table is
dealt evenly to as few tasks as hold ``lot`` pieces each, so that a task fills
thousands of sequences and only its last ones stay open. Equal lengths are placed a
round at a time: a round scores all open sequences at once and gives each of the best
one piece.

Defined cases: a null or empty text is its closing id alone; repeated rows are packed
once each; a null ``doc_id`` is carried; a text of any length is cut; an empty table
gives an empty one; other columns aren't read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from docwatch.llm.packing import Encoder
from docwatch.llm.shingles import slices
from docwatch.session import materialize

PART_BITS = 33


@dataclass(frozen=True)
class Capacities:
    """What a sequence holds; ``weights`` are those of tokens, documents and cost."""

    tokens: int = 1024
    documents: int = 1024
    cost: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 0.02, 0.02)
    rule: str = "residual"

    def __post_init__(self) -> None:
        if self.rule not in ("residual", "dot"):
            raise ValueError("rule must be residual or dot")
        if self.cost < self.tokens**2 or self.documents < 1:
            raise ValueError("a piece of a whole sequence must fit")


def pieces(docs: DataFrame, make_encoder: Callable[[], Encoder], end_id: int = 2, tokens: int = 1024, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece, and with ``with_ids`` its ids as little-endian bytes."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make_encoder()
        for batch in batches:
            for part in slices(batch, "text"):
                yield _cut(part, encode, end_id, tokens, with_ids)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _cut(batch: pa.RecordBatch, encode: Encoder, end_id: int, tokens: int, with_ids: bool) -> pa.RecordBatch:
    ids, counts = encode(pc.fill_null(batch["text"], ""))
    ends = np.cumsum(counts)
    closed = np.insert(ids.astype("<u4"), ends, end_id)
    sizes = counts + 1
    first = np.where(sizes % tokens, sizes % tokens, np.minimum(sizes, tokens))
    n = 1 + (sizes - first) // tokens
    row = np.repeat(np.arange(len(sizes)), n)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    length = np.where(piece == 0, first[row], tokens)
    start = np.where(piece == 0, 0, first[row] + (piece - 1) * tokens)
    at = (np.cumsum(sizes) - sizes)[row] + start
    raw = memoryview(closed.tobytes())
    bounds = [(a * 4, b * 4) for a, b in zip(at.tolist(), (at + length).tolist())]
    columns = [
        batch["doc_id"].take(pa.array(row)),
        pa.array(piece.astype(np.int32)),
        pa.array(start.astype(np.int64)),
        pa.array(length.astype(np.int64)),
        pa.array([zlib.crc32(raw[a:b]) for a, b in bounds], pa.int64()),
    ]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if with_ids:
        columns.append(pa.array([bytes(raw[a:b]) for a, b in bounds], pa.binary()))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names=names)


class Bins:
    """Open sequences as columns: what is left of each capacity."""

    def __init__(self, capacities: Capacities) -> None:
        self.whole = np.array([capacities.tokens, capacities.documents, capacities.cost], dtype=np.int64)
        self.weights = np.array(capacities.weights)
        self.rule = capacities.rule
        self.left = np.zeros((0, 3), dtype=np.int64)
        self.name = np.zeros(0, dtype=np.int64)
        self.opened = 0

    def place(self, length: int, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset for each of ``count`` pieces of one length."""
        demand = np.array([length, 1, length * length], dtype=np.int64)
        names, offsets = [], []
        while count:
            room = np.flatnonzero((self.left >= demand).all(axis=1))
            if len(room) == 0:
                self._open(self._needed(demand, count))
                continue
            order = room[np.argsort(self._score(room, demand), kind="stable")[:count]]
            names.append(self.name[order])
            offsets.append(self.whole[0] - self.left[order, 0])
            self.left[order] -= demand
            count -= len(order)
        return np.concatenate(names), np.concatenate(offsets)

    def _score(self, room: np.ndarray, demand: np.ndarray) -> np.ndarray:
        left, need = self.left[room] / self.whole, demand / self.whole
        if self.rule == "dot":
            return -(left * need) @ self.weights
        return ((left - need) ** 2) @ self.weights

    def _needed(self, demand: np.ndarray, count: int) -> int:
        return -(-count // int((self.whole // demand).min()))

    def _open(self, n: int) -> None:
        self.left = np.concatenate([self.left, np.tile(self.whole, (n, 1))])
        self.name = np.concatenate([self.name, self.opened + np.arange(n)])
        self.opened += n

    def forget_full(self, shortest: int) -> None:
        """Drop the sequences that no piece to come can fit."""
        open_ = (self.left >= np.array([shortest, 1, shortest * shortest])).all(axis=1)
        self.left, self.name = self.left[open_], self.name[open_]


def best_fit(lengths: np.ndarray, capacities: Capacities) -> tuple[np.ndarray, np.ndarray]:
    """Sequence (from 0) and offset of each piece, the longest placed first."""
    bins = Bins(capacities)
    order = np.argsort(-lengths, kind="stable")
    sizes, firsts, counts = np.unique(-lengths[order], return_index=True, return_counts=True)
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    shortest = int(lengths.min()) if len(lengths) else 0
    for size, first, count in zip((-sizes).tolist(), firsts.tolist(), counts.tolist()):
        rows = order[first : first + count]
        sequence[rows], offset[rows] = bins.place(size, count)
        bins.forget_full(shortest)
    return sequence, offset


def pack_pieces(rows: DataFrame, capacities: Capacities = Capacities(), lot: int = 200_000) -> DataFrame:
    """``rows`` with ``sequence_id`` and ``offset``; ``rows`` has ``length`` and is written.

    A task holds about ``lot`` narrow rows.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        sequence, offset = best_fit(table["length"].to_numpy().astype(np.int64), capacities)
        first = TaskContext.get().partitionId() << PART_BITS
        placed = table.append_column("sequence_id", pa.array(sequence + first)).append_column("offset", pa.array(offset))
        yield from placed.to_batches(max_chunksize=50_000)

    tasks = max(1, -(-rows.count() // lot))
    return rows.repartition(tasks).mapInArrow(run, schema)


def pack(docs: DataFrame, make_encoder: Callable[[], Encoder], capacities: Capacities = Capacities(), end_id: int = 2, lot: int = 200_000) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return pack_pieces(materialize(pieces(docs, make_encoder, end_id, capacities.tokens), "pieces"), capacities, lot)
