"""Near duplicates by b-bit MinHash.

1. A document's set of word shingles gives 512 minima. Bands of six minima are
   hashed into keys; of each minimum only its two low bits are kept, packed as bit
   planes. Documents with equal sets are one node from here on.
2. Documents that share a band key are candidates. In every band the members are
   compared with one of them first, the one that meets most others over all bands;
   the share of equal low bits, corrected for those that agree by chance, estimates
   the similarity, and only pairs well below the limit are left out. What remains is
   confirmed on the full sets.
3. Confirmed links give components. Members of a band that are in different
   components then meet each other, too: their bit planes are compared in blocks
   inside the tasks; where they may reach the limit the full sets are fetched and
   compared, and a task sends on a spanning forest of what it links. So every pair
   that shares a band is either inside a component or was tested.

Two sets of similarity 0.8 share none of the 42 bands with probability 3e-6, and
miss the estimate's margin with 2e-6.

Defined cases: null and empty texts have an empty set and are linked with nothing;
a text with fewer words than a shingle has its whole sequence as one; rows that
repeat a ``doc_id`` are one document, linked by any of its texts; a row with a
null ``doc_id`` is never linked: it is kept unless its set has a document with an
id; an empty table gives an empty one; other columns are carried along unseen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docwatch.llm.shingles import shingle_sets, slices
from docwatch.operators.components import connected_components
from docwatch.session import materialize


@dataclass(frozen=True)
class MinHash:
    """``width`` words per shingle, links from ``percent`` on."""

    width: int = 5
    percent: int = 80
    minima: int = 512
    rows: int = 6
    bands: int = 42
    margin: float = 0.1
    seed: int = 20240131
    hub_rows: int = 500
    block_rows: int = 1024


LOW_BITS = 2


def _family(config: MinHash) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(config.seed)
    factors = draw.integers(0, 1 << 32, config.minima, dtype=np.uint32) | np.uint32(1)
    return factors, draw.integers(0, 1 << 32, config.minima, dtype=np.uint32)


def minima(values: np.ndarray, factors: np.ndarray, offsets: np.ndarray, step: int = 4096) -> np.ndarray:
    """The smallest image of the set under each function of the family."""
    short = (values >> np.uint64(32)).astype(np.uint32)
    lowest = np.full(len(factors), np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(short), step):
        images = short[at : at + step, None] * factors + offsets
        images ^= images >> np.uint32(15)
        np.minimum(lowest, images.min(axis=0), out=lowest)
    return lowest


def band_keys(signatures: np.ndarray, config: MinHash) -> np.ndarray:
    """A 64-bit key per row and band."""
    keys = np.zeros((len(signatures), config.bands), dtype=np.uint64)
    for band in range(config.bands):
        value = np.full(len(signatures), band + 1, dtype=np.uint64)
        for column in range(band * config.rows, (band + 1) * config.rows):
            value = (value ^ signatures[:, column].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        keys[:, band] = value
    return keys.view(np.int64)


def bit_planes(signatures: np.ndarray) -> np.ndarray:
    """The low bits of all minima, one plane of 64-bit words after the other."""
    planes = [np.packbits((signatures >> np.uint32(b)) & np.uint32(1), axis=1) for b in range(LOW_BITS)]
    return np.ascontiguousarray(np.concatenate(planes, axis=1)).view(np.int64)


def _digest(values: np.ndarray) -> tuple[int, int]:
    raw = xxhash.xxh3_128_digest(values.tobytes())
    return int.from_bytes(raw[:8], "big", signed=True), int.from_bytes(raw[8:], "big", signed=True)


def _lists(table: np.ndarray) -> pa.Array:
    ends = np.arange(len(table) + 1, dtype=np.int32) * table.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(table.ravel()))


SKETCH = "n_shingles long, high long, low long, planes array<long>, bands array<long>"


def sketches_of(docs: DataFrame, config: MinHash) -> DataFrame:
    """``doc_id, n_shingles, high, low, planes, bands`` of every row; written.

    ``high, low`` is a digest of the set; without shingles all but ``n_shingles``
    are null.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = _family(config)
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, digests, rows = [], [], []
                for values in shingle_sets(part["text"], config.width):
                    sizes.append(len(values))
                    digests.append(_digest(values) if len(values) else (None, None))
                    rows.append(minima(values, *family))
                signatures = np.stack(rows)
                empty = pa.array(np.array(sizes) == 0)
                columns = [
                    part["doc_id"],
                    pa.array(sizes, pa.int64()),
                    pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()),
                ]
                for table in (bit_planes(signatures), band_keys(signatures, config)):
                    full = _lists(table)
                    columns.append(pa.compute.if_else(empty, pa.scalar(None, full.type), full))
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "n_shingles", "high", "low", "planes", "bands"]
                )

    return materialize(docs.select("doc_id", "text").mapInArrow(sketch, f"doc_id {id_type}, {SKETCH}"), "sketches")


# ---- candidates ----------------------------------------------------------------


def estimate(a: Column, b: Column, config: MinHash) -> Column:
    """Similarity from the share of equal low bits, less what agrees by chance."""
    words = config.minima // 64
    apart = [
        F.bit_count(
            F.get(a, F.lit(w)).bitwiseXOR(F.get(b, F.lit(w))).bitwiseOR(
                F.get(a, F.lit(words + w)).bitwiseXOR(F.get(b, F.lit(words + w)))
            )
        )
        for w in range(words)
    ]
    equal = 1.0 - sum(apart[1:], apart[0]) / config.minima
    chance = 2.0**-LOW_BITS
    return (equal - chance) / (1.0 - chance)


def promising(pairs: DataFrame, sets: DataFrame, config: MinHash) -> DataFrame:
    """The pairs ``u, v`` whose sizes and low bits allow the limit."""
    narrow = sets.select("node", "n_shingles", "planes")
    left = narrow.select(F.col("node").alias("u"), F.col("n_shingles").alias("nu"), F.col("planes").alias("pu"))
    right = narrow.select(F.col("node").alias("v"), F.col("n_shingles").alias("nv"), F.col("planes").alias("pv"))
    both = pairs.join(left, "u").join(right, "v")
    near = both.filter(100 * F.least("nu", "nv") >= config.percent * F.greatest("nu", "nv"))
    return near.filter(estimate(F.col("pu"), F.col("pv"), config) >= config.percent / 100 - config.margin).select("u", "v")


def equal_bits(one: np.ndarray, others: np.ndarray, config: MinHash) -> np.ndarray:
    """The estimate for one row of planes against many."""
    words = config.minima // 64
    apart = (one[:words] ^ others[:, :words]) | (one[words:] ^ others[:, words:])
    equal = 1.0 - np.bitwise_count(apart).sum(axis=1) / config.minima
    chance = 2.0**-LOW_BITS
    return (equal - chance) / (1.0 - chance)


def _lots(rows: DataFrame, sets: DataFrame, config: MinHash) -> DataFrame:
    """``rows(key, n, node, component)`` with sizes and bit planes, a lot ``key, a, b`` per two blocks.

    A key with many rows is cut into blocks of about ``block_rows``; each two blocks
    of a key meet in one lot.
    """
    blocks = F.ceil(F.col("n") / config.block_rows).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    placed = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    lots = placed.select(
        "key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "node", "component"
    )
    return lots.join(sets.select("node", "n_shingles", "high", "low", "planes").hint("merge"), "node")


def _by_lot(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work(table of a lot)`` gives a batch; lots stream by in order, one is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            starts = _starts(table)
            for begin, end in zip(starts[:-1], starts[1:]):
                if end - begin > 1:
                    yield from work(table.slice(begin, end - begin)).to_batches()
            held = table.slice(starts[-1]).combine_chunks()
        if held is not None and len(held) > 1:
            yield from work(held).to_batches()

    dealt = rows.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")
    return dealt.mapInArrow(run, schema)


def _starts(table: pa.Table) -> np.ndarray:
    """Where each lot begins; the last one may go on in the next batch."""
    columns = np.stack([table[c].to_numpy() for c in ("key", "a", "b")])
    return np.concatenate([[0], np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1]).astype(int)


def _planes(lot: pa.Table) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in lot["planes"].chunks]).reshape(len(lot), -1)


def _partners(i: int, groups: np.ndarray, lot: dict[str, np.ndarray], config: MinHash) -> np.ndarray:
    """Rows after ``i``, of other groups and of the other block if the lot has two, that may reach the limit."""
    rest = slice(i + 1, None)
    size = lot["n_shingles"]
    fits = groups[rest] != groups[i]
    fits &= 100 * np.minimum(size[rest], size[i]) >= config.percent * np.maximum(size[rest], size[i])
    if lot["a"][0] != lot["b"][0]:
        fits &= lot["own"][rest] != lot["own"][i]
    near = np.flatnonzero(fits)
    if len(near):
        near = near[equal_bits(lot["planes"][i], lot["planes"][rest][near], config) >= config.percent / 100 - config.margin]
    return near + i + 1


def _columns(lot: pa.Table) -> dict[str, np.ndarray]:
    names = ("a", "b", "own", "n_shingles", "component")
    return {c: lot[c].to_numpy() for c in names} | {"planes": _planes(lot)}


def block_links(rows: DataFrame, texts: DataFrame, sets: DataFrame, config: MinHash) -> DataFrame:
    """``u, v`` links between different components that share a key.

    ``rows(key, n, node, component)``. A first pass over the bit planes leaves the
    rows that have some partner in their lot; only their texts are fetched. The second
    confirms on full sets and passes over pairs that its links connect already, so a
    lot sends on a spanning forest, never its pairs.
    """

    def hopeful(lot: pa.Table) -> pa.Table:
        columns = _columns(lot)
        mark = np.zeros(len(lot), dtype=bool)
        for i in range(len(lot) - 1):
            near = _partners(i, columns["component"], columns, config)
            mark[near] = True
            mark[i] |= len(near) > 0
        return lot.filter(pa.array(mark))

    def link(lot: pa.Table) -> pa.Table:
        sets_ = [x for part in lot["text"].chunks for x in shingle_sets(part, config.width)]
        # another text of a repeated id isn't the set that the row stands for
        true = [_digest(x) == d for x, d in zip(sets_, zip(lot["high"].to_pylist(), lot["low"].to_pylist()))]
        lot, sets_ = lot.filter(pa.array(true)), [x for x, t in zip(sets_, true) if t]
        u: list[int] = []
        v: list[int] = []
        if len(lot) > 1:
            columns, groups = _columns(lot), lot["component"].to_numpy().copy()
            for i in range(len(lot) - 1):
                for j in _partners(i, groups, columns, config).tolist():
                    if groups[i] == groups[j]:
                        continue
                    common = len(np.intersect1d(sets_[i], sets_[j], assume_unique=True))
                    if 100 * common >= config.percent * (len(sets_[i]) + len(sets_[j]) - common):
                        u.append(i)
                        v.append(j)
                        groups[groups == groups[j]] = groups[i]
        return pa.table({"u": lot["node"].take(pa.array(u, pa.int64())), "v": lot["node"].take(pa.array(v, pa.int64()))})

    lots = _lots(rows, sets, config)
    near = materialize(_by_lot(lots, hopeful, lots.schema), "hopeful")
    kind = sets.schema["node"].dataType.simpleString()
    full = near.hint("merge").join(texts, "node")
    return materialize(_by_lot(full, link, f"u {kind}, v {kind}"), "links")


def confirmed(pairs: DataFrame, texts: DataFrame, sets: DataFrame, config: MinHash) -> DataFrame:
    """The pairs ``u, v`` that reach the limit on their full sets.

    ``texts(node, text)`` holds all that may be asked for. Texts of ``v`` stream past the set of ``u``; a ``u`` with very many partners is
    salted, so no task holds more than ``hub_rows`` of them.
    """
    pairs = materialize(pairs, "pairs")
    salts = pairs.groupBy("u").agg(F.ceil(F.count("*") / config.hub_rows).cast("int").alias("salts"))
    salts = materialize(salts, "salts")
    salted = pairs.join(salts, "u").select("u", "v", F.pmod(F.xxhash64("v"), F.col("salts")).cast("int").alias("salt"))
    hubs = salts.select("u", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    roles = hubs.select(F.col("u").alias("node"), "u", "salt", F.lit(0).alias("role")).union(
        salted.select(F.col("v").alias("node"), "u", "salt", F.lit(1).alias("role"))
    )
    keyed = materialize(roles.join(sets.select("node", "high", "low"), "node"), "roles")
    # a merge join: neither side is bounded
    rows = keyed.hint("merge").join(texts, "node").repartition("u", "salt").sortWithinPartitions("u", "salt", "role")
    node = texts.schema["node"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set = None, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            for part in slices(batch, "text"):
                found: tuple[list, list] = ([], [])
                keys = zip(*(part[c].to_pylist() for c in ("u", "salt", "role", "node", "high", "low")))
                for (u, salt, role, v, high, low), values in zip(keys, shingle_sets(part["text"], config.width)):
                    if _digest(values) != (high, low):
                        continue  # another text of a repeated id
                    if role == 0:
                        hub, hub_set = (u, salt), values
                    elif hub == (u, salt):
                        common = len(np.intersect1d(hub_set, values, assume_unique=True))
                        if 100 * common >= config.percent * (len(hub_set) + len(values) - common):
                            found[0].append(u)
                            found[1].append(v)
                kind = part.schema.field("u").type
                yield pa.RecordBatch.from_arrays([pa.array(f, kind) for f in found], names=["u", "v"])

    return materialize(rows.mapInArrow(compare, f"u {node}, v {node}"), "links")


def near_components(docs: DataFrame, config: MinHash = MinHash()) -> tuple[DataFrame, DataFrame]:
    """The sketches, and ``high, low, node, component`` of every distinct set."""
    sketches = sketches_of(docs, config)
    known = sketches.filter("n_shingles > 0 and doc_id is not null")
    sets = known.groupBy("high", "low").agg(
        F.min("doc_id").alias("node"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("planes").alias("planes"),
        F.first("bands").alias("bands"),
    )
    sets = materialize(sets, "sets")
    banded = sets.select(F.explode_outer("bands").alias("key"), "node")
    shared = banded.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = materialize(banded.join(materialize(shared, "shared"), "key"), "members")
    # most others first: the original of many copies meets more of them than any copy does
    met = materialize(members.groupBy("node").agg(F.sum("n").alias("met")), "met")
    ranked = members.join(met, "node").groupBy("key").agg(F.min(F.struct((-F.col("met")).alias("less"), "node")).alias("h"))
    hubs = materialize(ranked.select("key", F.col("h.node").alias("hub")), "hubs")
    named = docs.filter("doc_id is not null").select(F.col("doc_id").alias("node"), "text")
    # all that may be compared, so that whole texts of the corpus are shuffled once
    texts = materialize(named.join(met.select("node").hint("merge"), "node", "left_semi"), "texts")

    first = members.join(hubs, "key").filter("hub <> node")
    first = first.select(F.col("hub").alias("u"), F.col("node").alias("v")).distinct()
    links = confirmed(promising(first, sets, config), texts, sets, config)
    parts = materialize(connected_components(links), "parts")

    placed = members.join(parts, F.col("node") == F.col("id"), "left").select(
        "key", "n", "node", F.coalesce("component", "node").alias("component")
    )
    placed = materialize(placed, "placed")
    mixed = placed.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b")
    open_rows = materialize(placed.join(materialize(mixed.select("key"), "mixed"), "key"), "open")
    more = block_links(open_rows, texts, sets, config)
    parts = materialize(connected_components(links.union(more)), "parts")
    nodes = sets.select("high", "low", "node").join(parts, F.col("node") == F.col("id"), "left")
    return sketches, materialize(
        nodes.select("high", "low", "node", F.coalesce("component", "node").alias("component")), "nodes"
    )


def near_groups(docs: DataFrame, config: MinHash = MinHash()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per row of ``docs``."""
    sketches, nodes = near_components(docs, config)
    rows = sketches.select("doc_id", "n_shingles", "high", "low")
    grouped = rows.join(nodes, ["high", "low"], "left")
    component = F.coalesce("component", "doc_id")
    return grouped.select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )


def drop_near_copies(docs: DataFrame, config: MinHash = MinHash()) -> DataFrame:
    """``docs`` without the documents that are near copies of a smaller id; all columns."""
    gone = near_groups(docs, config).filter("not kept")
    ids = materialize(gone.filter("doc_id is not null").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    rows = docs.select(F.struct("*").alias("row"))
    named = rows.join(ids, F.col("row.doc_id") == F.col("_gone"), "left_anti").filter("row.doc_id is not null")
    return named.union(rows.filter("row.doc_id is null")).select("row.*")
