"""Vector best fit: round trips, capacities, and how full sequences are."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docwatch.llm import packing, vector_packing as vp


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("table", ["awkward", "few"])
def test_round_trip(request, tokenizer, table):
    docs = request.getfixturevalue(table)
    rows = vp.pack(docs, packing.public_encoder()).collect()
    wanted = Counter()
    for row in docs.collect():
        ids = np.array([*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(min(first, len(ids)), len(ids) + 1, 1024)]
        for j, (a, b) in enumerate(zip(cuts, cuts[1:])):
            wanted[(row.doc_id, j, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r.length for r in rows)
    assert len(sequences) <= max(-(-total // 1024) * 1.02, -(-total // 1024) + 1)


def test_ids_are_returned(awkward, tokenizer):
    rows = vp.pieces(awkward.filter("doc_id = 4"), packing.public_encoder(), with_ids=True).orderBy("piece").collect()
    ids = np.concatenate([np.frombuffer(r.ids, dtype="<u4") for r in rows])
    text = awkward.filter("doc_id = 4").first().text
    assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
    assert [r.length for r in rows[1:]] == [1024] * (len(rows) - 1)


def test_nothing(nothing):
    assert vp.pack(nothing, packing.public_encoder()).count() == 0


@pytest.mark.parametrize("rule", ["residual", "dot"])
@settings(max_examples=60, deadline=None)
@given(lengths=st.lists(st.integers(1, 64), min_size=1, max_size=120), documents=st.integers(1, 9), spare=st.integers(0, 2000))
def test_no_capacity_is_exceeded(rule, lengths, documents, spare):
    most = vp.Capacities(tokens=64, documents=documents, cost=64 * 64 + spare, rule=rule)
    sequence, offset = vp.best_fit(np.array(lengths), most)
    own = defaultdict(list)
    for s, o, n in zip(sequence.tolist(), offset.tolist(), lengths):
        own[s].append((o, n))
    for pieces in own.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0, *[n for _, n in pieces[:-1]]]).tolist()
        assert sum(n for _, n in pieces) <= 64 and len(pieces) <= documents
        assert sum(n * n for _, n in pieces) <= most.cost
    assert sorted(own) == list(range(len(own)))


def test_tight_cost_and_documents():
    lengths = np.array([8] * 100)
    by_documents = vp.Capacities(tokens=64, documents=4, cost=64 * 64)
    assert vp.best_fit(lengths, by_documents)[0].max() + 1 == 25
    short = vp.Capacities(tokens=16, documents=100, cost=16 * 16)
    assert vp.best_fit(lengths, short)[0].max() + 1 == 50


@pytest.mark.parametrize("rule, bound", [("residual", 1.005), ("dot", 1.03)])
def test_few_sequences(rule, bound):
    draw = random.Random(3)
    lengths = np.array([min(1024, int(draw.paretovariate(0.9) * 30)) for _ in range(20_000)])
    sequence, _ = vp.best_fit(lengths, vp.Capacities(rule=rule))
    least = max(-(-int(lengths.sum()) // 1024), int((lengths > 512).sum()))
    assert sequence.max() + 1 <= least * bound


def test_impossible_capacities_are_refused():
    for wrong in (dict(cost=1000), dict(documents=0), dict(rule="first")):
        with pytest.raises(ValueError):
            vp.Capacities(**wrong)


def test_lots(spark, few):
    """Rows are dealt evenly over tasks; ids of sequences stay unique and nothing is lost."""
    whole = vp.pack(few, packing.public_encoder())
    split = vp.pack(few, packing.public_encoder(), lot=50)
    key = lambda t: Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in t.collect())
    assert key(whole) == key(split)
    fill = split.groupBy("sequence_id").agg({"length": "sum", "offset": "max"}).collect()
    assert max(r["sum(length)"] for r in fill) <= 1024
