"""Exact duplicates by an exchange of compressed fingerprints.

1. Every row gets the SHA-256 of its text without white space; the row's 60-bit
   fingerprint is the head of it. The narrow table is written once, with the
   number of the partition that made each row.
2. A partition sends each owner (a range of fingerprints) its distinct
   fingerprints, sorted, as one Golomb-coded string, so a group of copies costs a
   partition a few bits. The owner answers each partition with a bitmap: which of
   these fingerprints another partition holds too.
3. Rows whose bit is set, or whose fingerprint the partition itself holds twice,
   are suspects. Only suspects' texts are grouped, by their bytes; equal texts
   combine before the shuffle, so a hot group costs one text per partition.

Defined cases: a null text is the empty text, and all texts of white space only
are equal; a null ``doc_id`` comes after every other; of rows that repeat a
``doc_id`` with equal texts, :func:`drop_copies` leaves one; an empty table gives
an empty one; other columns are carried along unseen.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docwatch.llm.common import SPACE, text_of, with_may_be_in
from docwatch.session import materialize

FINGERPRINT_BITS = 60


# ---- Golomb coding -----------------------------------------------------------


def golomb_encode(sorted_values: np.ndarray) -> bytes:
    """Sorted distinct 64-bit integers as Golomb-Rice coded gaps.

    Layout: count (8 bytes), first value (8 bytes), bits of a remainder (1 byte), all
    quotients in unary (a run of 0 ended by a 1), then all remainders.
    """
    values = np.asarray(sorted_values, dtype=np.int64)
    n = len(values)
    if n == 0:
        return b""
    gaps = np.diff(values)
    mean = int(gaps.mean()) if n > 1 else 0
    k = max(0, mean.bit_length() - 1)
    quotients = gaps >> k
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if n > 1 else 0, dtype=np.uint8)
    unary[ends] = 1
    shifts = np.arange(k - 1, -1, -1, dtype=np.int64)
    rest = ((gaps[:, None] >> shifts) & 1).astype(np.uint8).ravel()
    head = n.to_bytes(8, "little") + int(values[0]).to_bytes(8, "little") + bytes([k])
    return head + len(unary).to_bytes(8, "little") + np.packbits(unary).tobytes() + np.packbits(rest).tobytes()


def golomb_decode(coded: bytes) -> np.ndarray:
    if not coded:
        return np.zeros(0, dtype=np.int64)
    n, first, k = int.from_bytes(coded[:8], "little"), int.from_bytes(coded[8:16], "little"), coded[16]
    n_unary = int.from_bytes(coded[17:25], "little")
    body = np.frombuffer(coded, dtype=np.uint8, offset=25)
    cut = (n_unary + 7) // 8
    ends = np.flatnonzero(np.unpackbits(body[:cut], count=n_unary))
    quotients = np.diff(ends, prepend=-1) - 1
    bits = np.unpackbits(body[cut:], count=(n - 1) * k).reshape(n - 1, k).astype(np.int64)
    rest = bits @ (np.int64(1) << np.arange(k - 1, -1, -1, dtype=np.int64)) if k else np.zeros(n - 1, dtype=np.int64)
    return first + np.concatenate([[0], np.cumsum((quotients << k) + rest)]).astype(np.int64)


# ---- the exchange ------------------------------------------------------------


def squeezed(text: Column) -> Column:
    """The text without its white space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")


def digest(text: Column) -> Column:
    return F.sha2(squeezed(text), 256)


def fingerprint(sha: Column) -> Column:
    return F.conv(F.substring(sha, 1, FINGERPRINT_BITS // 4), 16, 10).cast("long")


def prints_of(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, sha, fp, part`` of every row, written."""
    text = text_of("text")
    narrow = docs.select(
        "doc_id", F.length(text).cast("long").alias("n_chars"), digest(text).alias("sha")
    ).select("*", fingerprint(F.col("sha")).alias("fp"), F.spark_partition_id().alias("part"))
    return materialize(narrow, "prints")


def _sender(owners: int):
    def send(table: pa.Table) -> pa.Table:
        values = np.unique(table["fp"].to_numpy())
        edges = (np.arange(1, owners, dtype=object) << FINGERPRINT_BITS) // owners
        cuts = np.concatenate([[0], np.searchsorted(values, edges.astype(np.int64)), [len(values)]])
        filled = [o for o in range(owners) if cuts[o] < cuts[o + 1]]
        return pa.table(
            {
                "part": pa.array([table["part"][0].as_py()] * len(filled), pa.int32()),
                "owner": pa.array(filled, pa.int32()),
                "coded": pa.array([golomb_encode(values[cuts[o] : cuts[o + 1]]) for o in filled], pa.binary()),
            }
        )

    return send


def _answer(table: pa.Table) -> pa.Table:
    """For each sender a bitmap of its fingerprints that another sender has too."""
    sent = [golomb_decode(x) for x in table["coded"].to_pylist()]
    values, counts = np.unique(np.concatenate(sent), return_counts=True)
    shared = values[counts > 1]
    bitmaps = [np.packbits(np.isin(x, shared, assume_unique=True)).tobytes() for x in sent]
    return pa.table({"part": table["part"], "owner": table["owner"], "bitmap": pa.array(bitmaps, pa.binary())})


def _mark(prints: pa.Table, bitmaps: pa.Table, owners: int) -> pa.Table:
    fps = prints["fp"].to_numpy()
    values, place, counts = np.unique(fps, return_inverse=True, return_counts=True)
    edges = (np.arange(1, owners, dtype=object) << FINGERPRINT_BITS) // owners
    cuts = np.concatenate([[0], np.searchsorted(values, edges.astype(np.int64)), [len(values)]])
    suspect = counts > 1
    for owner, bitmap in zip(bitmaps["owner"].to_pylist(), bitmaps["bitmap"].to_pylist()):
        span = slice(cuts[owner], cuts[owner + 1])
        bits = np.unpackbits(np.frombuffer(bitmap, dtype=np.uint8), count=cuts[owner + 1] - cuts[owner])
        suspect[span] |= bits.astype(bool)
    marked = prints.select(["doc_id", "n_chars", "sha", "fp"])
    return marked.append_column("suspect", pa.array(suspect[place.ravel()]))


def mark_suspects(prints: DataFrame, owners: int) -> DataFrame:
    """``prints`` with ``suspect``: whether another row may have the same text.

    A group is what one partition of the input made, or what one owner received;
    both stay bounded if owners grow with the partitions.
    """
    sent = prints.select("part", "fp").groupBy("part").applyInArrow(
        _sender(owners), "part int, owner int, coded binary"
    )
    answers = sent.groupBy("owner").applyInArrow(_answer, "part int, owner int, bitmap binary")
    doc_id = prints.schema["doc_id"].dataType.simpleString()
    return prints.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        lambda a, b: _mark(a, b, owners),
        f"doc_id {doc_id}, n_chars long, sha string, fp long, suspect boolean",
    )


# ---- verification ------------------------------------------------------------


def _best() -> Column:
    """Most code points, then the smallest id, nulls last."""
    return F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))


def assign_copies(docs: DataFrame, owners: int | None = None) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: one row per row of ``docs``."""
    spark = docs.sparkSession
    owners = owners or int(spark.conf.get("spark.sql.shuffle.partitions"))
    marked = materialize(mark_suspects(prints_of(docs), owners), "marked")
    hot = materialize(marked.filter("suspect").select("fp").distinct(), "suspects")
    text = text_of("text")
    texts = docs.select("doc_id", F.length(text).cast("long").alias("n_chars"), squeezed(text).alias("bytes"))
    suspects = texts.withColumn("fp", fingerprint(F.sha2("bytes", 256))).join(hot, "fp", "left_semi")
    groups = suspects.groupBy("fp", "bytes").agg(F.count("*").alias("group_size"), _best().alias("best"))
    groups = materialize(
        groups.select(F.sha2("bytes", 256).alias("sha"), "group_size", F.col("best.doc_id").alias("keep_id")),
        "groups",
    )
    grouped = marked.filter("suspect").join(groups, "sha", "left")
    alone = marked.filter("not suspect").select(
        "sha", "doc_id", F.lit(1).cast("long").alias("group_size"), F.col("doc_id").alias("keep_id")
    )
    rows = grouped.select("sha", "doc_id", "group_size", "keep_id").union(alone)
    return rows.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, owners: int | None = None) -> DataFrame:
    """The kept rows of ``docs``, all columns; rows that repeat a kept id with its text leave one.

    What goes is few rows as a rule: only rows whose id may be in the narrow list of
    what goes are shuffled to meet it in an anti join, the others stay where they are read.
    """
    found = materialize(assign_copies(docs, owners).filter("group_size > 1"), "copies")
    key = ["doc_id", "text_sha256"]
    gone = found.filter("not kept").select(*key).distinct()
    again = found.filter("kept").groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").select(*key)

    def meets(other: DataFrame) -> Column:
        return F.col("_id").eqNullSafe(other["doc_id"]) & (F.col("_sha") == other["text_sha256"])

    gone, again = materialize(gone, "gone"), materialize(again, "again")
    ids = gone.select("doc_id").union(again.select("doc_id"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id")
    rows = with_may_be_in(rows, ids, ["doc_id"], "_met").select("row", F.col("doc_id").alias("_id"), "_met")
    untouched = rows.filter(~F.col("_met")).select("row.*")
    rows = rows.filter("_met").select("row", "_id", digest(text_of(F.col("row.text"))).alias("_sha"))
    left = rows.join(gone, meets(gone), "left_anti")
    if again.isEmpty():  # the usual case: no kept id is repeated
        return untouched.union(left.select("row.*"))
    single = left.join(again, meets(again), "left_anti").select("row.*")
    longest = F.min(F.struct((-F.length(text_of(F.col("row.text")))).alias("less"), "row"))
    one = left.join(again, meets(again), "left_semi").groupBy("_id", "_sha").agg(longest.alias("best"))
    return untouched.union(single).union(one.select("best.row.*"))
