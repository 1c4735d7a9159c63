"""Words of many texts at once, found in their UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 bytes lie in one of the closed ranges."""
    found = np.zeros(256, bool)
    for first, last in ranges:
        found[first : last + 1] = True
    return found


# after lower-casing; every byte of a character beyond ASCII belongs to a word
LETTERS = byte_class((0x61, 0x7A), (0x80, 0xFF))
LETTERS_AND_DIGITS = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def runs_of(data: np.ndarray, edges: np.ndarray, inside: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The maximal runs of bytes of the class ``inside``, never across texts.

    Returns the different runs, the number of each run's value among them, and the offsets
    of each text's runs. ``edges`` are the offsets of the texts in ``data``.
    """
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64), np.zeros(len(edges), np.int64)
    solid = inside[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    starts = edges[:-1][edges[:-1] < len(data)]
    first[starts] = solid[starts]
    ends = edges[1:][edges[1:] > 0] - 1
    last[ends] = solid[ends]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    # stretches from one run's start to its end, and from there to the next run
    places = np.empty(2 * len(begin) + 1, np.int64)
    places[0:-1:2], places[1::2], places[-1] = begin, end, len(data)
    stretches = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), 2 * len(begin), [None, pa.py_buffer(places), pa.py_buffer(data)]
    )
    values = stretches.take(pa.array(np.arange(0, 2 * len(begin), 2))).dictionary_encode()
    return values.dictionary, values.indices.to_numpy().astype(np.int64), np.searchsorted(begin, edges)
