"""A hashed maximum-entropy language model with a class-factored softmax.

``P(word | before) = P(class | before) * P(word | class)``.

* Counts of all training words give the unigram base.
* Classes come from the company words keep: each frequent word and each word ending
  has a sketch of its neighbours (random signs, summed over all training text);
  k-means on those few sketches gives the classes. Rare and unknown words go by
  their ending.
* The class factor is a softmax over hashed features of what stands before: the
  previous word, the one before it (skip), both together, the pair of the last two
  classes, and the class before these.
* The word factor is a softmax over all words of the class: a word's log count, plus
  hashed weights of the previous word and of the one before it (skip), both by word.
  The words of a class share ``slots`` of weights: its most frequent ones have their
  own, others of ``lookup`` are dealt to ``shared`` slots by hash, and one slot is for
  the rest and the unknown word. So its normaliser is a sum over slots, and exact.
* The weights of both are trained together by gradient steps on
  virtual shards: a text's shard follows from its hash, the number of shards from the
  counted training tokens, and the order within a shard from the hash too. In each
  round every shard steps through its texts from common weights, and the mean of the
  changes is the next round's start. How rows lie in files, partitions and batches
  therefore changes nothing, and a shard learns from as many tokens at any input size.

What travels to tasks is of fixed size: weights, ``lookup`` frequent words, a class
per ending. Counts of rarer words stay in a table and meet the texts in a join.

Defined cases: a null text is the empty text, a single end token; words may be of any
length; a null ``doc_id`` is the empty string for the split; repeated rows are texts
of their own, and count twice in training; without training text every count is 0
and the model is uniform over one unknown word per class; an empty table gives an
empty one; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docwatch.llm.shingles import slices
from docwatch.session import materialize

END = np.int64(-1)
# The slot of a class for words outside the lookup and the unknown word.
REST = 0
# Parts of 1 in which shards send what their weights moved by.
UNITS = 1e7
ROW_BITS = 33
# Text held as arrays at a time; a token takes some 150 bytes of them.
SLICE_BYTES = 3 << 20


@dataclass(frozen=True)
class Shape:
    """Sizes of everything that doesn't grow with the corpus."""

    classes: int = 32
    lookup: int = 1 << 18
    clustered: int = 1 << 15
    endings: int = 1 << 10
    ending_bytes: int = 2
    neighbours: int = 1 << 10
    sketch: int = 16
    buckets: int = 1 << 14
    slots: int = 32
    shared: int = 8
    word_buckets: int = 1 << 10
    rounds: int = 2
    shard_tokens: int = 1 << 22
    step: float = 0.1
    batch: int = 4096
    seed: int = 11

    @property
    def rows(self) -> int:
        """Rows of weights: hashed features, pairs of classes, single classes."""
        return self.buckets + self.classes**2 + self.classes

    @property
    def word_rows(self) -> int:
        """Rows of weights of the word factor: hashed features of each class."""
        return self.classes * self.word_buckets


# ---- tokens --------------------------------------------------------------------


@dataclass
class Tokens:
    """Tokens of some texts: distinct words, and which of them stands where."""

    hashes: np.ndarray  # of the distinct words, then of the end
    endings: np.ndarray
    place: np.ndarray  # index into the distinct words, end of text included
    counts: np.ndarray  # tokens per text


def _digests(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    each = words.to_numpy(zero_copy_only=False)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, each), dtype=np.uint64, count=len(each))


def tokens_of(texts: pa.Array, shape: Shape) -> Tokens:
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = split.flatten()
    filled = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))[filled]
    coded = flat.dictionary_encode()
    words = coded.dictionary.cast(pa.binary())
    hashes = np.empty(len(words) + 1, dtype=np.int64)
    endings = np.empty(len(words) + 1, dtype=np.int64)
    hashes[:-1] = (_digests(words) ^ np.uint64(1 << 63)).view(np.int64)
    # many words share an ending
    ends = pc.binary_slice(words, -shape.ending_bytes).dictionary_encode()
    endings[:-1] = (_digests(ends.dictionary) % np.uint64(shape.endings))[ends.indices.to_numpy(zero_copy_only=False)]
    hashes[-1], endings[-1] = END, 0
    counts = np.bincount(owner, minlength=len(texts)) + 1
    place = np.full(int(counts.sum()), len(words), dtype=np.int64)
    is_word = np.ones(len(place), dtype=bool)
    is_word[np.cumsum(counts) - 1] = False
    place[is_word] = coded.indices.to_numpy(zero_copy_only=False)[filled]
    return Tokens(hashes, endings, place, counts)


def _training_batches(batches: Iterator[pa.RecordBatch], shape: Shape) -> Iterator[Tokens]:
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            if len(part):
                yield tokens_of(part["text"], shape)


def _doc_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.lit(""))


def split_held_out(docs: DataFrame) -> DataFrame:
    """``doc_id, text, held_out``."""
    return docs.select("doc_id", "text", (F.crc32(_doc_key().cast("binary")) % 5 == 1).alias("held_out"))


# ---- counts --------------------------------------------------------------------


def count_words(training: DataFrame, shape: Shape) -> DataFrame:
    """``word, ending, c`` of every training token; written."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens in _training_batches(batches, shape):
            c = np.bincount(tokens.place, minlength=len(tokens.hashes))
            seen = c > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[seen]) for x in (tokens.hashes, tokens.endings, c)], names=["word", "ending", "c"]
            )

    partial = training.select("text").mapInArrow(count, "word long, ending long, c long")
    return materialize(partial.groupBy("word").agg(F.min("ending").alias("ending"), F.sum("c").alias("c")), "words")


@dataclass
class Lookup:
    """The most frequent words, sorted by hash, with their ending, count and rank."""

    words: np.ndarray
    endings: np.ndarray
    counts: np.ndarray
    ranks: np.ndarray

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        if not len(self.words):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, -1)


def lookup_of(words: DataFrame, shape: Shape) -> Lookup:
    """The words above a count: as many as fit ``shape.lookup`` if the cut is an eighth power of 2."""
    level = F.floor(F.log2("c") * 8).cast("int")
    sizes = {r.level: r.n for r in words.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}
    cut, held = max(sizes, default=0) + 1, 0
    while sizes and cut > min(sizes) and held + sizes.get(cut - 1, 0) <= shape.lookup:
        cut -= 1
        held += sizes.get(cut, 0)
    top = _arrays(words.filter(level >= cut).select("word", "ending", "c"))
    ranks = np.empty(len(top["word"]), dtype=np.int64)
    ranks[np.lexsort((top["word"], -top["c"]))] = np.arange(len(ranks))
    order = np.argsort(top["word"])
    return Lookup(top["word"][order], top["ending"][order], top["c"][order], ranks[order])


def _arrays(rows: DataFrame) -> dict[str, np.ndarray]:
    """The columns of a table of bounded size."""
    table = rows.toArrow()
    return {c: table[c].to_numpy() for c in table.column_names}


# ---- classes -------------------------------------------------------------------


def _neighbour_sums(training: DataFrame, lookup: Lookup, shape: Shape) -> np.ndarray:
    """Per frequent word and per ending the summed sketch of its neighbours, and a count."""
    units = shape.clustered + shape.endings
    signs = np.random.default_rng(shape.seed).choice([-1.0, 1.0], (shape.neighbours + 1, shape.sketch))
    signs[-1] = 0.0
    shared = training.sparkSession.sparkContext.broadcast(lookup)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((units, shape.sketch + 1))
        for tokens in _training_batches(batches, shape):
            at = shared.value.find(tokens.hashes)
            rank = np.where(at >= 0, shared.value.ranks[at] if len(shared.value.ranks) else 0, 1 << 60)
            near = np.where(rank < shape.neighbours, rank, shape.neighbours)
            near[-1] = shape.neighbours  # the end says nothing
            context = near[tokens.place]
            before, after = np.roll(context, 1), np.roll(context, -1)
            before[0] = after[-1] = shape.neighbours
            for owners in (
                np.where(rank < shape.clustered, rank, units)[tokens.place],
                np.where(rank < shape.clustered, units, shape.clustered + tokens.endings)[tokens.place],
            ):
                for side in (before, after):
                    use = (owners < units) & (side < shape.neighbours)
                    pair = owners[use] * shape.neighbours + side[use]
                    pairs, n = np.unique(pair, return_counts=True)
                    unit, context_of = np.divmod(pairs, shape.neighbours)
                    values = np.column_stack([signs[context_of] * n[:, None], n])
                    starts = np.flatnonzero(np.diff(unit, prepend=-1))
                    if len(starts):
                        total[unit[starts]] += np.add.reduceat(values, starts, axis=0)
        used = np.flatnonzero(total[:, -1])
        lists = pa.FixedSizeListArray.from_arrays(pa.array(total[used].astype(np.int64).ravel()), shape.sketch + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), lists.cast(pa.list_(pa.int64()))], names=["unit", "sums"]
        )

    rows = training.select("text").mapInArrow(sums, "unit long, sums array<long>")
    columns = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(shape.sketch + 1)]
    table = _arrays(rows.groupBy("unit").agg(*columns))
    unit = table.pop("unit").astype(np.int64)
    out = np.zeros((units, shape.sketch + 1))
    for i, column in enumerate(table.values()):
        out[unit, i] = column
    return out


def cluster(sums: np.ndarray, shape: Shape) -> np.ndarray:
    """A class per unit: k-means on the directions of the sketches, heavy units first."""
    weight = sums[:, -1]
    vectors = sums[:, :-1] / np.maximum(weight, 1.0)[:, None]
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    used = np.flatnonzero(weight > 0)
    labels = np.zeros(len(sums), dtype=np.int64)
    if not len(used):
        return labels
    x, w = vectors[used], np.sqrt(weight[used])
    centres = [x[np.argmax(w)]]
    far = 1.0 - x @ centres[0]
    while len(centres) < min(shape.classes, len(used)):
        centres.append(x[np.argmax(far * w)])
        far = np.minimum(far, 1.0 - x @ centres[-1])
    middle = np.array(centres)
    for _ in range(25):
        own = np.argmax(x @ middle.T, axis=1)
        for k in range(len(middle)):
            mean = (x[own == k] * w[own == k, None]).sum(axis=0)
            norm = np.linalg.norm(mean)
            middle[k] = mean / norm if norm > 0 else middle[k]
    labels[used] = np.argmax(x @ middle.T, axis=1)
    return labels


# ---- model ---------------------------------------------------------------------


@dataclass
class Model:
    """Everything a task needs; its size depends on the shape alone."""

    shape: Shape
    lookup: Lookup
    word_class: np.ndarray  # by place in the lookup
    ending_class: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    weights: np.ndarray
    word_slot: np.ndarray  # by place in the lookup
    slot_mass: np.ndarray  # smoothed tokens of each slot of each class
    word_weights: np.ndarray

    @property
    def n_tokens(self) -> int:
        return int(self.class_tokens.sum())

    @property
    def n_words(self) -> int:
        return int(self.class_words.sum())

    def class_sizes(self) -> np.ndarray:
        """Smoothed tokens of each class, one unknown word included."""
        return self.class_tokens + 0.5 * (self.class_words + 1)

    def classes_of(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Place in the lookup (or -1) and class of each distinct word."""
        at = self.lookup.find(tokens.hashes)
        known = self.word_class[at] if len(self.word_class) else np.zeros(len(at), dtype=np.int64)
        return at, np.where(at >= 0, known, self.ending_class[tokens.endings])

    def slots_of(self, at: np.ndarray) -> np.ndarray:
        """Slot of each distinct word within its class."""
        known = self.word_slot[at] if len(self.word_slot) else np.zeros(len(at), dtype=np.int64)
        return np.where(at >= 0, known, REST)

    def features(self, tokens: Tokens, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of weights that are active before each token: of the class factor, of the word factor."""
        shape = self.shape
        mixed = (tokens.hashes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
        n = len(tokens.place)
        first = np.cumsum(tokens.counts) - tokens.counts
        words, kinds = np.zeros(n + 3, dtype=np.uint64), np.zeros(n + 3, dtype=np.int64)
        words[3:], kinds[3:] = mixed[tokens.place], classes[tokens.place]
        since = np.arange(n) - np.repeat(first, tokens.counts)
        one = np.where(since >= 1, words[2:-1], np.uint64(1))
        two = np.where(since >= 2, words[1:-2], np.uint64(2))
        both = (one * np.uint64(31) + two) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(24)
        hashed = [one, two * np.uint64(7) + np.uint64(3), both]
        rows = np.empty((n, len(hashed) + 2), dtype=np.int32)
        for j, h in enumerate(hashed):
            rows[:, j] = h % np.uint64(shape.buckets)
        last, before, third = (np.where(since >= b, kinds[3 - b : n + 3 - b], 0) for b in (1, 2, 3))
        rows[:, -2] = shape.buckets + last * shape.classes + before
        rows[:, -1] = shape.buckets + shape.classes**2 + third
        own = (classes[tokens.place] * shape.word_buckets).astype(np.int32)
        word_rows = np.empty((n, 2), dtype=np.int32)
        for j, h in enumerate(hashed[:2]):
            word_rows[:, j] = own + (h % np.uint64(shape.word_buckets)).astype(np.int32)
        return rows, word_rows

    def class_probabilities(self, features: np.ndarray, weights: np.ndarray) -> np.ndarray:
        logits = weights.take(features[:, 0], axis=0)
        for j in range(1, features.shape[1]):
            logits += weights.take(features[:, j], axis=0)
        # weights are far from the range where exp overflows
        np.clip(logits, -60.0, 60.0, out=logits)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def slot_probabilities(self, kind: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Shares of the slots of each token's class, of all its words together 1."""
        odds = weights.take(rows[:, 0], axis=0)
        for j in range(1, rows.shape[1]):
            odds += weights.take(rows[:, j], axis=0)
        np.clip(odds, -30.0, 30.0, out=odds)
        np.exp(odds, out=odds)
        odds *= self.slot_shares.take(kind, axis=0)
        odds /= odds.sum(axis=1, keepdims=True)
        return odds

    @cached_property
    def slot_shares(self) -> np.ndarray:
        return (self.slot_mass / self.class_sizes()[:, None]).astype(np.float32)

    def examples(self, tokens: Tokens) -> list[np.ndarray]:
        """Active rows before each token, its class, rows of its word factor, and its slot."""
        at, classes = self.classes_of(tokens)
        rows, word_rows = self.features(tokens, classes)
        return [rows, classes[tokens.place], word_rows, self.slots_of(at)[tokens.place]]


class Descent:
    """Weights under gradient steps, with a step size per row."""

    def __init__(self, weights: np.ndarray, step: float):
        self.start = weights
        self.weights = weights.copy()
        self.scale = np.full(len(weights), 1e-4, dtype=np.float32)
        self.position = np.zeros(len(weights), dtype=np.int64)
        self.step = step

    def take(self, rows: np.ndarray, slope: np.ndarray) -> None:
        met = np.zeros(len(self.weights), dtype=bool)
        met[rows.ravel()] = True
        touched = np.flatnonzero(met)
        self.position[touched] = np.arange(len(touched))
        place = self.position[rows.ravel()]
        sums = np.empty((slope.shape[1], len(touched)), dtype=np.float32)
        for k, column in enumerate(np.repeat(slope.T, rows.shape[1], axis=1)):
            sums[k] = np.bincount(place, column, len(touched))
        self.scale[touched] += np.square(sums).mean(axis=0)
        self.weights[touched] -= (self.step * sums / np.sqrt(self.scale[touched])).T

    def changes(self, factor: int) -> pa.RecordBatch:
        """``factor, row, moved`` of the rows that were met, in whole units that add up alike in any order."""
        moved = np.rint((self.weights - self.start).astype(np.float64) * UNITS).astype(np.int64)
        used = np.flatnonzero(np.abs(moved).max(axis=1) > 0)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(moved[used].ravel()), moved.shape[1])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(used), factor, dtype=np.int32)), pa.array(used), lists.cast(pa.list_(pa.int64()))],
            names=["factor", "row", "moved"],
        )


class Learner:
    """Gradient steps of one shard, each over ``shape.batch`` tokens whatever batches they came in."""

    def __init__(self, model: Model):
        self.model = model
        self.classes = Descent(model.weights, model.shape.step)
        self.words = Descent(model.word_weights, model.shape.step)
        self.waiting: list[np.ndarray] = []

    def take(self, tokens: Tokens) -> None:
        found = self.model.examples(tokens)
        if self.waiting:
            found = [np.concatenate(x) for x in zip(self.waiting, found)]
        size = self.model.shape.batch
        whole = len(found[0]) // size * size
        for at in range(0, whole, size):
            self._step(*(x[at : at + size] for x in found))
        self.waiting = [x[whole:] for x in found]

    def changes(self) -> Iterator[pa.RecordBatch]:
        """``factor, row, moved`` of the rows that the shard has met."""
        if self.waiting and len(self.waiting[0]):
            self._step(*self.waiting)
        yield self.classes.changes(0)
        yield self.words.changes(1)

    def _step(self, rows: np.ndarray, kind: np.ndarray, word_rows: np.ndarray, slot: np.ndarray) -> None:
        """One step of both factors."""
        each = np.arange(len(kind))
        slope = self.model.class_probabilities(rows, self.classes.weights)
        slope[each, kind] -= 1.0
        self.classes.take(rows, slope)
        slope = self.model.slot_probabilities(kind, word_rows, self.words.weights)
        slope[each, slot] -= 1.0
        self.words.take(word_rows, slope)


MAX_SHARD_PARTITIONS = 4096


def sharded(share: DataFrame, tokens: int, shape: Shape) -> DataFrame:
    """``shard, text``: each shard whole and in the order of its rows' hashes.

    A shard is a partition of its own; beyond ``MAX_SHARD_PARTITIONS`` a partition
    holds several, one after another.
    """
    shards = max(1, -(-tokens // shape.shard_tokens))
    parts = min(shards, MAX_SHARD_PARTITIONS)
    key = _doc_key()
    mark = F.xxhash64(key, "text")
    rows = share.select(
        F.pmod(mark, F.lit(shards)).cast("int").alias("shard"), mark.alias("mark"), key.alias("key"), "text"
    )
    dealt = rows.repartitionById(parts, F.pmod("shard", F.lit(parts)).cast("int"))
    return dealt.sortWithinPartitions("shard", "mark", "key", "text").select("shard", "text")


def _shard_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of the batches that belong to one shard, in order."""
    for batch in batches:
        shard = batch["shard"].to_numpy()
        cuts = (np.flatnonzero(np.diff(shard)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(shard)]):
            if b > a:
                yield int(shard[a]), batch.slice(a, b - a)


def _train_round(model: Model, share: DataFrame, tokens: int) -> None:
    """Move the weights by the mean of what every shard makes of them with its texts."""
    shape = model.shape
    shared = share.sparkSession.sparkContext.broadcast(model)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, learner = None, None
        for shard, run in _shard_runs(batches):
            if shard != current:
                if learner:
                    yield from learner.changes()
                current, learner = shard, Learner(shared.value)
            for found in _training_batches([run], shape):
                learner.take(found)
        if learner:
            yield from learner.changes()

    changes = sharded(share, tokens, shape).mapInArrow(step, "factor int, row long, moved array<long>")
    width = max(shape.classes, shape.slots)
    sums = [F.sum(F.get("moved", F.lit(i))).alias(f"m{i}") for i in range(width)]
    # a row's mean is over the shards that met it
    table = _arrays(changes.groupBy("factor", "row").agg(F.count("*").alias("n"), *sums))
    for factor, weights in enumerate((model.weights, model.word_weights)):
        own = table["factor"] == factor
        row, n = table["row"][own].astype(np.int64), table["n"][own] * UNITS
        for k in range(weights.shape[1]):
            weights[row, k] += (table[f"m{k}"][own] / n).astype(np.float32)


def _slots(lookup: Lookup, word_class: np.ndarray, class_sizes: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """The slot of each word of the lookup in its class, and the smoothed tokens of each slot."""
    order = np.lexsort((lookup.ranks, word_class))
    first = np.searchsorted(word_class[order], np.arange(shape.classes))
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order)) - first[word_class[order]]
    own = shape.slots - 1 - shape.shared
    dealt = 1 + own + lookup.words % shape.shared
    slot = np.where(place < own, 1 + place, dealt)
    cells = np.bincount(word_class * shape.slots + slot, lookup.counts + 0.5, shape.classes * shape.slots)
    mass = cells.reshape(shape.classes, shape.slots)
    mass[:, REST] = class_sizes - mass.sum(axis=1)
    return slot, mass


def fit(split: DataFrame, shape: Shape = Shape()) -> tuple[Model, DataFrame]:
    """The model, and the table of all training words with counts."""
    training = split.filter("not held_out")
    words = count_words(training, shape)
    lookup = lookup_of(words, shape)
    labels = cluster(_neighbour_sums(training, lookup, shape), shape)
    ending_class = labels[shape.clustered :]
    frequent = lookup.ranks < shape.clustered
    word_class = ending_class[lookup.endings]
    word_class[frequent] = labels[lookup.ranks[frequent]]
    # all words by the class of their ending, then the frequent ones moved to their own
    by_ending = _arrays(words.groupBy("ending").agg(F.sum("c").alias("c"), F.count("*").alias("n")))
    own = ending_class[by_ending["ending"].astype(np.int64)]
    tokens = np.bincount(own, by_ending["c"], shape.classes)
    distinct = np.bincount(own, by_ending["n"], shape.classes)
    for classes, sign in ((ending_class[lookup.endings[frequent]], -1), (word_class[frequent], 1)):
        tokens += sign * np.bincount(classes, lookup.counts[frequent], shape.classes)
        distinct += sign * np.bincount(classes, minlength=shape.classes)
    weights = np.zeros((shape.rows, shape.classes), dtype=np.float32)
    slot, mass = _slots(lookup, word_class, tokens + 0.5 * (distinct + 1), shape)
    word_weights = np.zeros((shape.word_rows, shape.slots), dtype=np.float32)
    model = Model(shape, lookup, word_class, ending_class, tokens, distinct, weights, slot, mass, word_weights)
    # by id and text, so that copies of one text are dealt to all rounds
    lot = F.pmod(F.xxhash64(F.lit("round"), _doc_key(), "text"), F.lit(shape.rounds))
    for turn in range(shape.rounds):
        _train_round(model, training.filter(lot == turn), -(-model.n_tokens // shape.rounds))
    return model, words


SCORED = (
    "row long, held_out boolean, n_tokens long, known long, base double, model double, rare array<long>, times array<long>"
)


def _scored(split: DataFrame, model: Model) -> DataFrame:
    """Per text all that needs no rare word's count, and its rare words; written.

    ``base`` and ``model`` lack the log10 of (count + 0.5) of the rare words.
    """
    shape = model.shape
    shared = split.sparkSession.sparkContext.broadcast(model)
    id_type = split.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        row = TaskContext.get().partitionId() << ROW_BITS
        per_slot = -np.log10(np.maximum(own.slot_mass, 0.5))
        per_token = -np.log10(own.n_tokens + 0.5 * (own.n_words + 1))
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                tokens = tokens_of(part["text"], shape)
                at, classes = own.classes_of(tokens)
                counts = own.lookup.counts[at] if len(own.lookup.counts) else np.zeros(len(at))
                log_count = np.where(at >= 0, np.log10(counts + 0.5), 0.0)[tokens.place]
                kind, slot = classes[tokens.place], own.slots_of(at)[tokens.place]
                rows, word_rows = own.features(tokens, classes)
                chosen = np.empty(len(kind))
                for a in range(0, len(kind), shape.batch):
                    part_of = slice(a, a + shape.batch)
                    p = own.class_probabilities(rows[part_of], own.weights)
                    q = own.slot_probabilities(kind[part_of], word_rows[part_of], own.word_weights)
                    each = np.arange(len(p))
                    chosen[part_of] = np.maximum(p[each, kind[part_of]], 1e-30) * np.maximum(
                        q[each, slot[part_of]].astype(np.float64), 1e-30
                    )
                word = np.log10(chosen) + per_slot[kind, slot] + log_count
                first = np.cumsum(tokens.counts) - tokens.counts
                rare, times = _rare_words(tokens, at)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array(row + np.arange(len(part))),
                        part["held_out"],
                        pa.array(tokens.counts.astype(np.int64)),
                        pa.array(np.add.reduceat((at >= 0)[tokens.place].astype(np.int64), first)),
                        pa.array(np.add.reduceat(log_count, first) + tokens.counts * per_token),
                        pa.array(np.add.reduceat(word, first)),
                        rare,
                        times,
                    ],
                    names=["doc_id", "row", "held_out", "n_tokens", "known", "base", "model", "rare", "times"],
                )
                row += len(part)

    return materialize(split.mapInArrow(score, f"doc_id {id_type}, {SCORED}"), "scored")


def _rare_words(tokens: Tokens, at: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """For each text its words outside the lookup, and how often each occurs."""
    texts = np.repeat(np.arange(len(tokens.counts)), tokens.counts)
    out = (at < 0)[tokens.place]
    pair, times = np.unique(texts[out] * len(tokens.hashes) + tokens.place[out], return_counts=True)
    owner, word = np.divmod(pair, len(tokens.hashes))
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(tokens.counts)))]).astype(np.int32)
    lists = (tokens.hashes[word], times.astype(np.int64))
    return tuple(pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in lists)


def score_texts(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: one row per row.

    Both scores are log10 probabilities of the whole text with its end token; the
    base is the smoothed unigram model.
    """
    split = split_held_out(docs)
    model, words = fit(split, shape)
    scored = _scored(split, model)
    rare = scored.select("row", F.explode_outer(F.arrays_zip("rare", "times")).alias("x")).select(
        "row", F.col("x.rare").alias("word"), F.col("x.times").alias("times")
    )
    met = rare.filter("word is not null").join(words.select("word", "c"), "word", "left")
    log_count = F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    late = met.groupBy("row").agg(
        F.sum(F.col("times") * log_count).alias("late"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("late_known"),
    )
    joined = scored.drop("rare", "times").join(late, "row", "left")
    late_sum = F.coalesce("late", F.lit(0.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("late_known", F.lit(0))).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + late_sum).alias("base_score"),
        (F.col("model") + late_sum).alias("score"),
    )
