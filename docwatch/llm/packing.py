"""Hierarchical packing of documents into windows of several context sizes.

A document becomes its token ids and a closing id. Whole windows of the longest
tier are cut off at once; what is left is routed to the tier of its length. Each
tier is packed from the longest down: the gap of a window is filled from shorter
tiers, the best fit first, and where nothing fits a longer piece is cut. What
remains of a task's input at its end is cut at the tiers and, below the shortest,
at its halves, so nothing is padded.

Every task packs its own rows: no shuffle, no group. Tokens wait in a pool of a
bounded size. Sequences of a pool are dealt to step groups of equal length and
near equal attention cost.

Defined cases: a null or empty text is its closing id alone; a text of any length
is cut; repeated rows are packed once each; an empty table gives an empty one;
other columns aren't read. Ids are those of ``tokenizers`` for the same file.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = (1024, 512, 256, 128)
POOL_TOKENS = 1 << 21
STEP_TOKENS = 1 << 14
# Text held as ids at a time; a byte takes some 20 bytes of arrays.
SLICE_BYTES = 4 << 20
END_ID = 0
PART_BITS = 33

Encoder = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


# ---- ids -----------------------------------------------------------------------


def byte_bpe_encoder(ranks_path: str, pattern: str, special: dict[str, int]) -> Encoder:
    """Ids of many texts: each distinct word of a batch is encoded once.

    A token begins wherever a space stands before a character that isn't white
    space, whatever is around, so a text may be cut there. Texts with other runs of
    white space at a space, or with a special token, are encoded whole.
    """
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    whole = r" \s| $" + "".join(f"|{_escaped(s)}" for s in special)

    def ids_of(text: str) -> np.ndarray:
        return coder.encode_to_numpy(text, allowed_special="all")

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring_regex(texts, whole).to_numpy(zero_copy_only=False)
        # \s of the search is ASCII only; other white space at a space goes the slow way too
        odd |= pc.match_substring_regex(texts, r" [\x{1c}-\x{1f}\x{85}\p{Z}]").to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts)
        pieces = pc.split_pattern(plain, " ")
        firsts = pieces.offsets.to_numpy()
        coded = pieces.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        place = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        opening = np.zeros(len(place), dtype=bool)
        opening[firsts[:-1] - firsts[0]] = True
        # words with the space before them, then the words that open a text
        spaced = [coder.encode_ordinary(" " + w) if w else [] for w in words]
        opens = np.unique(place[opening])
        bare = [coder.encode_ordinary(words[i]) for i in opens]
        place[opening] = len(words) + np.searchsorted(opens, place[opening])
        sizes = np.fromiter((len(x) for x in spaced + bare), dtype=np.int64, count=len(words) + len(bare))
        table = np.fromiter((i for x in spaced + bare for i in x), dtype=np.uint32, count=int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        flat, lengths = _gather(table, starts[place], sizes[place])
        per_text = np.add.reduceat(np.append(lengths, 0), firsts[:-1] - firsts[0]) if len(texts) else lengths
        if not odd.any():
            return flat, per_text
        ends = np.cumsum(per_text)
        parts, counts = [], per_text.copy()
        for i in range(len(texts)):
            ids = ids_of(texts[i].as_py()) if odd[i] else flat[ends[i] - per_text[i] : ends[i]]
            parts.append(ids)
            counts[i] = len(ids)
        return np.concatenate(parts).astype(np.uint32), counts

    return encode


def _escaped(text: str) -> str:
    return "".join(c if c.isalnum() else f"\\{c}" for c in text)


def _gather(table: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``table[s : s + n]`` of every start and size, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) - np.repeat(ends - sizes, sizes) + np.repeat(starts, sizes)
    return table[at], sizes


# ---- packing -------------------------------------------------------------------


@dataclass
class Piece:
    doc: int
    start: int
    ids: np.ndarray


@dataclass
class Window:
    tier: int
    pieces: list[Piece] = field(default_factory=list)
    length: int = 0

    def put(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.length += len(piece.ids)

    @property
    def cost(self) -> int:
        """Attention inside each piece."""
        return sum(len(p.ids) ** 2 for p in self.pieces)


class Shelves:
    """Waiting pieces by length, with the lengths in use as a bitmap."""

    def __init__(self) -> None:
        self.by_length: dict[int, list[Piece]] = {}
        self.used = 0

    def add(self, piece: Piece) -> None:
        n = len(piece.ids)
        self.by_length.setdefault(n, []).append(piece)
        self.used |= 1 << n

    def take(self, n: int) -> Piece:
        shelf = self.by_length[n]
        piece = shelf.pop()
        if not shelf:
            self.used &= ~(1 << n)
        return piece

    def longest(self, at_most: int) -> int:
        """The largest length in use up to the given one, or 0."""
        return max((self.used & ((2 << at_most) - 1)).bit_length() - 1, 0)

    def shortest_above(self, n: int) -> int:
        """The smallest length in use above the given one, or 0."""
        rest = self.used >> (n + 1)
        return n + 1 + ((rest & -rest).bit_length() - 1) if rest else 0


def pack_tiers(shelves: Shelves, tiers: tuple[int, ...], last: bool) -> Iterator[Window]:
    """Windows of full length from the waiting pieces, long tiers first.

    Unless ``last``, what can't fill a window stays on the shelves; otherwise the
    rest is cut at the tiers and below them.
    """
    for tier in tiers:
        floor = tier // 2 if tier != tiers[-1] else 0
        while (n := shelves.longest(tier)) > floor:
            window = Window(tier)
            window.put(shelves.take(n))
            if not _fill(window, shelves):
                for piece in window.pieces:
                    shelves.add(piece)
                break
            yield window
    if last:
        yield from _remains(shelves, tiers)


def _fill(window: Window, shelves: Shelves) -> bool:
    while (gap := window.tier - window.length) > 0:
        fit = shelves.longest(gap)
        if fit == 0:
            longer = shelves.shortest_above(gap)
            if not longer:
                return False
            piece = shelves.take(longer)
            window.put(Piece(piece.doc, piece.start, piece.ids[:gap]))
            shelves.add(Piece(piece.doc, piece.start + gap, piece.ids[gap:]))
        else:
            window.put(shelves.take(fit))
    return True


def _remains(shelves: Shelves, tiers: tuple[int, ...]) -> Iterator[Window]:
    """The last pieces, of fewer ids than the tiers hold together."""
    sizes = list(tiers)
    while sizes[-1] > 1:
        sizes.append(sizes[-1] // 2)
    for size in sizes:
        while sum(n * len(x) for n, x in shelves.by_length.items()) >= size:
            window = Window(size)
            while window.length < size:
                n = shelves.longest(tiers[0])
                piece = shelves.take(n)
                room = size - window.length
                window.put(Piece(piece.doc, piece.start, piece.ids[:room]))
                if n > room:
                    shelves.add(Piece(piece.doc, piece.start + room, piece.ids[room:]))
            yield window


def balanced_groups(windows: list[Window], step_tokens: int) -> list[int]:
    """A step group for each window: equal lengths, near equal attention cost.

    Windows of a tier are dealt in order of cost, back and forth, so that every
    group gets as many of each tier as any other, or one less.
    """
    groups = max(1, round(sum(w.tier for w in windows) / step_tokens))
    order = sorted(range(len(windows)), key=lambda i: (-windows[i].tier, -windows[i].cost, i))
    dealt = [0] * len(windows)
    for turn, i in enumerate(order):
        lap, seat = divmod(turn, groups)
        dealt[i] = seat if lap % 2 == 0 else groups - 1 - seat
    return dealt


OUTPUT = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "tier int, sequence_length int, step_group long"
)


def pack(docs: DataFrame, make_encoder: Callable[[], Encoder], with_ids: bool = False, tiers=TIERS,
         pool_tokens: int = POOL_TOKENS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece; ``with_ids`` adds the ids themselves as little-endian bytes.

    ``tier`` is the window the sequence was packed for, ``sequence_length`` what it
    holds; the two are equal.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, {OUTPUT}" + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make_encoder()
        first_id = TaskContext.get().partitionId() << PART_BITS
        packer = _Packer(tiers, pool_tokens, step_tokens, first_id)
        for batch in batches:
            for part in _bounded(batch):
                yield from _rows(packer.add(part, encode), with_ids)
        yield from _rows(packer.flush(True), with_ids)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _bounded(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of at most so many bytes of text, or single rows."""
    sizes = np.nan_to_num(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False)).astype(np.int64)
    lots = np.cumsum(sizes) // most
    cuts = np.flatnonzero(np.diff(lots)) + 1 if len(lots) else np.zeros(0, dtype=np.int64)
    for a, b in zip([0, *cuts], [*cuts, len(sizes)]):
        if b > a:
            yield batch.slice(a, b - a)


class _Packer:
    def __init__(self, tiers, pool_tokens: int, step_tokens: int, first_id: int) -> None:
        self.tiers, self.pool_tokens, self.step_tokens = tiers, pool_tokens, step_tokens
        self.next_id, self.next_group = first_id, first_id
        self.shelves, self.windows, self.pending = Shelves(), [], 0
        self.docs: dict[int, tuple] = {}
        self.next_doc = 0

    def add(self, batch: pa.RecordBatch, encode: Encoder) -> Iterator[tuple]:
        ids, counts = encode(pc.fill_null(batch["text"], ""))
        ends = np.cumsum(counts)
        longest = self.tiers[0]
        for doc_id, end, n in zip(batch["doc_id"].to_pylist(), ends.tolist(), counts.tolist()):
            own = np.append(ids[end - n : end], np.uint32(END_ID))
            doc, self.next_doc = self.next_doc, self.next_doc + 1
            self.docs[doc] = (doc_id, len(own))
            whole = len(own) // longest * longest
            for at in range(0, whole, longest):
                window = Window(longest)
                window.put(Piece(doc, at, own[at : at + longest]))
                self.windows.append(window)
            if whole < len(own):
                self.shelves.add(Piece(doc, whole, own[whole:]))
            self.pending += len(own)
            if self.pending >= self.pool_tokens:
                yield from self.flush(False)

    def flush(self, last: bool) -> Iterator[tuple]:
        """``doc_id, piece, doc_tokens, sequence, offset, window, group`` of all finished windows."""
        windows = self.windows + list(pack_tiers(self.shelves, self.tiers, last))
        self.windows, self.pending = [], 0
        for window, group in zip(windows, balanced_groups(windows, self.step_tokens)):
            offset = 0
            for piece in window.pieces:
                doc_id, n = self.docs[piece.doc]
                yield doc_id, piece, n, self.next_id, offset, window, self.next_group + group
                offset += len(piece.ids)
            self.next_id += 1
        self.next_group += max(1, round(sum(w.tier for w in windows) / self.step_tokens))
        waiting = {p.doc for shelf in self.shelves.by_length.values() for p in shelf}
        self.docs = {doc: self.docs[doc] for doc in waiting}


def _rows(placed: Iterator[tuple], with_ids: bool, most: int = 20_000) -> Iterator[pa.RecordBatch]:
    lot: list[tuple] = []
    for row in placed:
        lot.append(row)
        if len(lot) == most:
            yield _batch(lot, with_ids)
            lot = []
    if lot:
        yield _batch(lot, with_ids)


def _batch(lot: list[tuple], with_ids: bool) -> pa.RecordBatch:
    raw = [x[1].ids.astype("<u4").tobytes() for x in lot]
    columns = {
        "doc_id": pa.array([x[0] for x in lot]),
        "start": pa.array([x[1].start for x in lot], pa.int64()),
        "length": pa.array([len(x[1].ids) for x in lot], pa.int64()),
        "ids_crc32": pa.array([zlib.crc32(r) for r in raw], pa.int64()),
        "doc_tokens": pa.array([x[2] for x in lot], pa.int64()),
        "sequence_id": pa.array([x[3] for x in lot], pa.int64()),
        "offset": pa.array([x[4] for x in lot], pa.int64()),
        "tier": pa.array([x[5].tier for x in lot], pa.int32()),
        "sequence_length": pa.array([x[5].length for x in lot], pa.int32()),
        "step_group": pa.array([x[6] for x in lot], pa.int64()),
    }
    if columns["doc_id"].type == pa.null():
        columns["doc_id"] = columns["doc_id"].cast(pa.int64())
    if with_ids:
        columns["ids"] = pa.array(raw, pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def public_encoder(ranks_path: str | None = None) -> Callable[[], Encoder]:
    """The encoder of the public 50k byte-level vocabulary, loaded by each task."""

    def make() -> Encoder:
        import public_tokenizers

        path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        return byte_bpe_encoder(path, public_tokenizers.PATTERN, {"<|endoftext|>": 50256})

    return make
