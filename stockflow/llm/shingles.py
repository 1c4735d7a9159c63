"""Word shingles of texts as arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SHINGLE_WORDS = 5
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64
)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of a common integer hash)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def text_slices(texts: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The UTF-8 bytes of texts (NULL: empty), slice by slice, and where each text ends."""
    texts = texts.cast(pa.large_string()).fill_null("")
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(edges, edges[start] + slice_bytes, "right")) - 1)
        yield data[edges[start] : edges[stop]], edges[start : stop + 1] - edges[start]
        start = stop


def _words(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word of all texts, and the word offsets of each text."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(edges), np.int64)
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begins_text = edges[:-1][edges[:-1] < len(data)]
    first[begins_text] = solid[begins_text]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    ends_text = edges[1:][edges[1:] > 0] - 1
    last[ends_text] = solid[ends_text]
    begins, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    # every stretch from one word's start to the next; what follows the word is cut off
    places = np.empty(2 * len(begins) + 1, np.int64)
    places[0:-1:2], places[1::2], places[-1] = begins, ends, len(data)
    runs = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), 2 * len(begins), [None, pa.py_buffer(places), pa.py_buffer(data)]
    )
    words = runs.take(pa.array(np.arange(0, 2 * len(begins), 2))).dictionary_encode()
    digest = xxhash.xxh3_64_intdigest
    hashes = np.array([digest(word) for word in words.dictionary.to_pylist()], np.uint64)
    return hashes[words.indices.to_numpy()], np.searchsorted(begins, edges)


def shingle_hashes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of each text in order, with repeats, and their offsets.

    A text of fewer words than a shingle has one shingle of all its words; one without
    words has none.
    """
    words, offsets = _words(data, edges)
    n = np.diff(offsets)
    counts = np.where(n >= SHINGLE_WORDS, n - SHINGLE_WORDS + 1, np.minimum(n, 1))
    shingle_edges = np.concatenate([[0], np.cumsum(counts)])
    if not shingle_edges[-1]:
        return np.zeros(0, np.uint64), shingle_edges
    places = np.repeat(offsets[:-1] - shingle_edges[:-1], counts) + np.arange(shingle_edges[-1])
    left = np.repeat(offsets[1:], counts) - places  # words from here to the end of the text
    total = np.zeros(len(places), np.uint64)
    for i in range(SHINGLE_WORDS):
        there = np.where(left > i, words[np.minimum(places + i, len(words) - 1)], np.uint64(0))
        total = mixed(total + there * _FACTORS[i]) if i % 2 else total + there * _FACTORS[i]
    return mixed(total), shingle_edges
