"""What a Python task holds and does per batch of texts."""

import tracemalloc

import pyarrow as pa

from docwatch.llm import maxent_lm, packing


def test_packing_holds_ids_of_few_texts_at_a_time():
    batch = pa.record_batch({"doc_id": list(range(4000)), "text": [f"word{i % 7} of some text" + f" word{i % 7} of some text" * 200 for i in range(4000)]})
    encode = packing.public_encoder()()
    assert batch["text"].nbytes > 12 << 20

    def pack(**sizes):
        packer = packing._Packer(packing.TIERS, 1 << 19, packing.STEP_TOKENS, 0)
        rows = []
        for part in packing._bounded(batch, **sizes):
            rows += [r for lot in packing._rows(packer.add(part, encode), False) for r in lot.to_pylist()]
        return rows + [r for lot in packing._rows(packer.flush(True), False) for r in lot.to_pylist()]

    assert pack() == pack(most=1 << 18) == pack(most=1 << 24)
    packer = packing._Packer(packing.TIERS, 1 << 19, packing.STEP_TOKENS, 0)
    tracemalloc.start()
    for part in packing._bounded(batch):
        for _ in packing._rows(packer.add(part, encode), False):
            pass
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 100 << 20


def test_an_ending_is_hashed_once(monkeypatch):
    words = [f"{i}ing" for i in range(5000)] + [f"{i}er" for i in range(5000)]
    shape = maxent_lm.Shape()
    calls, digest = [], maxent_lm.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(maxent_lm.xxhash, "xxh3_64_intdigest", lambda word: calls.append(word) or digest(word))
    found = maxent_lm.tokens_of(pa.array([" ".join(words)]), shape)
    assert len(calls) == 10_000 + 2
    assert found.hashes[:-1].tolist() == [digest(w) - (1 << 63) for w in words]
    assert found.endings[:-1].tolist() == [digest(w[-2:]) % shape.endings for w in words]
