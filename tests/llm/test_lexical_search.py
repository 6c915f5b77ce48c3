"""Ranked search against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docwatch.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=50):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n, whole = len(counts), sum(x[2] for x in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, c, size in counts:
            m = 50 + (50 * size * n) // whole
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in wanted if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if no else i, -s) for r, (s, no, i) in enumerate(sorted(scored)[:k])]
    return Counter(out)


def ours(docs, items, k=50, shard_bytes=ls.SHARD_BYTES):
    found = ls.search(ls.build_index(docs, shard_bytes), items, k).collect()
    return Counter((r.item_id, r.rank, r.doc_id, r.score) for r in found)


ITEMS = "item_id long, text string, rank string, score string, doc_id string, term string"


def items_table(spark, rows):
    return spark.createDataFrame([(*r, "r", "s", "d", "t") for r in rows], ITEMS)


@pytest.mark.parametrize("shard_bytes", [ls.SHARD_BYTES, 2000])
def test_awkward(spark, awkward, nothing, shard_bytes):
    items = [(1, "W1 w2 w3 second LINE"), (2, ""), (3, None), (4, "one"), (5, "naïve 漢字 x é"), (1, "more"), (None, "w5 w5"),
             (7, "nowhere-at-all"), (8, "w9"), (8, "w9")]
    table = items_table(spark, items)
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    got = ours(awkward, table, shard_bytes=shard_bytes)
    assert got == plain(docs, items)
    assert ours(nothing, table) == Counter()
    assert ours(awkward, table.limit(0)) == Counter()


def test_many_shards_and_ties(spark):
    draw = random.Random(5)
    vocabulary = [f"t{int(draw.paretovariate(0.6))}" for _ in range(4000)]
    docs = [(i, " ".join(draw.choices(vocabulary, k=draw.choice([3, 8, 30, 120])))) for i in range(1500)]
    docs += [(10_000 + i, docs[3][1]) for i in range(700)]  # a third are copies, all tied
    items = [(i, " ".join(draw.choices(vocabulary, k=15))) for i in range(12)] + [(99, docs[3][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    table = items_table(spark, items)
    index = ls.build_index(frame, 20_000)
    assert index.shards.count() > 6
    wanted = plain(docs, items)
    got = Counter((r.item_id, r.rank, r.doc_id, r.score) for r in ls.search(index, table).collect())
    assert got == wanted
    assert {(r.item_id, r.rank, r.doc_id) for r in ls.search(index, table, 3).collect()} == {x[:3] for x in wanted if x[1] <= 3}


def test_lots_of_items(spark, few, monkeypatch):
    monkeypatch.setattr(ls, "LOT_TERMS", 100)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert ours(few, items) == plain([(r.doc_id, r.text) for r in few.collect()], [(r.item_id, r.text) for r in items.collect()])


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, (1 << 31) - 1), max_size=200))
def test_byte_code_round_trip(values):
    raw, size = ls.byte_code(np.array(values, dtype=np.int64))
    assert len(raw) == size.sum()
    assert ls.byte_decode(raw).tolist() == values


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), max_size=8))
def test_terms(texts):
    array = pa.array([None if t is None else t.encode("utf-8", "replace").decode() for t in texts], pa.string())
    found, counts = ls.terms_of(array)
    wanted = [terms(t) for t in array.to_pylist()]
    assert counts.tolist() == [len(x) for x in wanted]
    assert found.to_pylist() == [x for own in wanted for x in own]


def test_blocks_are_left_unread():
    """Common terms are non-essential once rare ones fill the heap; most of their blocks stay coded."""
    draw = np.random.default_rng(2)
    n = 20_000
    lengths = draw.integers(20, 60, size=n)
    known = ls.Collection(n, int(lengths.sum()))

    def one(docs, tf):
        opens = np.arange(len(docs)) % ls.BLOCK == 0
        gap = np.where(opens, docs, docs - np.concatenate([[0], docs[:-1]]))
        raw, size = ls.byte_code(np.column_stack([gap, tf]).ravel())
        block = np.flatnonzero(opens)
        closes = np.append(block[1:], len(docs)) - 1
        row = {
            "last": docs[closes], "ends": np.cumsum(size)[1::2][closes], "postings": raw.tobytes(),
            "most": np.maximum.reduceat(tf, block), "shortest": np.minimum.reduceat(lengths[docs], block),
        }
        w = int(1000 * np.log((2 * n + 2) / (2 * len(docs) + 1)))
        return ls.List(row, w, known, lengths, -(-n // ls.WINDOW)), dict(zip(docs.tolist(), ls.impact(w, tf, lengths[docs], known).tolist()))

    rare = np.sort(draw.choice(n // 10, size=80, replace=False))
    built = [one(rare, np.full(80, 3))]
    for share in (2, 3, 4):
        docs = np.sort(draw.choice(n, size=n // share, replace=False))
        built.append(one(docs, draw.integers(1, 3, size=len(docs))))
    lists = [b[0] for b in built]
    got = ls.search_shard(lists, n, 50)
    score = Counter()
    for _, adds in built:
        score.update(adds)
    assert got == [(d, s) for d, s in sorted(score.items(), key=lambda x: (-x[1], x[0]))[:50]]
    decoded, blocks = (sum(f(x) for x in lists[1:]) for f in (lambda x: len(x.decoded), lambda x: len(x.last)))
    assert decoded < blocks / 4
