"""Word shingles of whole texts as sets of 64-bit numbers, batch by batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

MIX = np.uint64(0x9E3779B97F4A7C15)
SHIFT = np.uint64(29)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z in lower case, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = split.flatten()
    filled = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    counts = np.bincount(owner[filled], minlength=len(texts))
    coded = flat.dictionary_encode()
    known = np.fromiter(
        (xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()),
        dtype=np.uint64,
        count=len(coded.dictionary),
    )
    hashes = known[coded.indices.to_numpy(zero_copy_only=False)] if len(known) else np.zeros(0, np.uint64)
    return hashes[filled], counts


def _combined(parts: np.ndarray) -> np.ndarray:
    """One number per row of ``parts``, which holds a word's hash in each column."""
    value = np.zeros(len(parts), dtype=np.uint64)
    for j in range(parts.shape[1]):
        value = (value ^ parts[:, j]) * MIX
        value ^= value >> SHIFT
    return value


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text.

    A text with fewer words than ``width`` has its whole sequence as one shingle;
    without words the set is empty.
    """
    hashes, counts = word_hashes(texts)
    at = 0
    windows = np.lib.stride_tricks.sliding_window_view(hashes, width) if len(hashes) >= width else None
    for n in counts.tolist():
        if n >= width:
            yield np.unique(_combined(windows[at : at + n - width + 1]))
        elif n:
            yield _combined(hashes[None, at : at + n])
        else:
            yield np.zeros(0, dtype=np.uint64)
        at += n


def slices(batch: pa.RecordBatch, column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most so many bytes of text, or single rows."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    lots = np.cumsum(sizes) // most
    cuts = (np.flatnonzero(np.diff(lots)) + 1).tolist() if len(lots) else []
    for a, b in zip([0, *cuts], [*cuts, len(sizes)]):
        if b > a:
            yield batch.slice(a, b - a)
