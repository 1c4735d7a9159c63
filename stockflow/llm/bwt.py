"""Burrows-Wheeler transforms of shards of strings, merged by interleave refinement.

A shard's suffixes are sorted once, alone, by their first eight symbols. Merging starts with the shards' suffixes one
shard after the other and refines that interleaving: stepping every suffix to the one that
is a character longer, and dealing them stably by that character, turns an order by the
first h characters into one by h + 1. No suffix is compared with one of another shard.
Where a step draws new borders, suffixes on both sides share h characters and no more: the
borders after h steps are the common-prefix intervals of length h.

Only suffixes that end a window are refined, and only intervals with two or more of them are
carried on: a suffix alone in its interval stays alone when it grows. So a merge costs a step per character for what is shared, and
little for what is not.
"""

from __future__ import annotations

import numpy as np

SHARD_BYTES = 1 << 20


def _words(symbols: np.ndarray, left: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight symbols from each place as one big-endian number, zero behind a string's end."""
    view = np.ndarray((len(symbols) - 7,), ">u8", symbols.data, strides=(1,))
    there = np.minimum(at, len(view) - 1)
    found = view[there].astype(np.uint64)
    room = np.clip(left, 0, 8).astype(np.uint64)
    shift = (np.uint64(8) - room) * np.uint64(8)
    cleared = np.where(room == 0, np.uint64(0), found >> np.minimum(shift, np.uint64(63)) << np.minimum(shift, np.uint64(63)))
    return np.where(room == 0, np.uint64(0), cleared)


def suffix_order(symbols: np.ndarray, left: np.ndarray, n: int) -> np.ndarray:
    """All n places in the order of the first eight symbols there, then of place: the order
    of a transform with bounded context. Refinement carries suffixes by number, so it needs
    no more from a shard.

    ``left`` is how many symbols a suffix has before its string's end; ``symbols`` has
    eight more places behind the n.
    """
    return np.argsort(_words(symbols, left, np.arange(n)), kind="stable")


def repeated_windows(strings: list[bytes], owners: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For the strings joined with one place between them: the smallest owner among all
    strings that hold the ``window`` bytes from a place on. Also where each string starts.

    Where no window starts the result is the string's own owner.
    """
    lengths = np.array([len(one) for one in strings], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    n = int(starts[-1])
    # a string ends with symbol 0; UTF-8 has no bytes over 0xF4, so one more still fits
    joined = np.frombuffer(b"\xff".join([*strings, b""]), np.uint8)
    symbols = np.zeros(n + 8, np.uint8)
    symbols[:n] = joined + np.uint8(1)
    owner = np.repeat(owners, lengths + 1)
    left = np.repeat(starts[1:], lengths + 1) - 1 - np.arange(n)

    # shards: whole strings up to a size; a transform and a step table for each
    shard_of = starts[:-1] // SHARD_BYTES
    edges = [*starts[np.flatnonzero(np.diff(shard_of, prepend=-1))].tolist(), n]
    place = np.empty(n, np.int32)  # the place of each suffix, shard by shard, in order
    for a, b in zip(edges, edges[1:], strict=False):
        place[a:b] = a + suffix_order(symbols[a : b + 8], left[a:b], b - a)
    rank = np.empty(n, np.int32)
    rank[place] = np.arange(n, dtype=np.int32)
    before = np.where(place > 0, place - 1, 0)
    transform = np.where(place > 0, symbols[before], 0).astype(np.uint8)  # the symbol before each suffix
    step = rank[before]  # the suffix that is longer by that symbol

    # a suffix with less than a window before it ends none: it would leave at its string's start
    ends_one = np.arange(n) - np.repeat(starts[:-1], lengths + 1) >= window
    suffix = np.flatnonzero(ends_one[place]).astype(np.int32)
    block = np.zeros(len(suffix), np.int32)
    for _ in range(window):
        symbol = transform[suffix]
        grows = symbol != 0
        suffix, block, symbol = suffix[grows], block[grows], symbol[grows]
        order = np.argsort(symbol, kind="stable")
        suffix, block, symbol = step[suffix[order]], block[order], symbol[order]
        border = np.ones(len(suffix) + 1, bool)
        border[1:-1] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        shared = ~(border[:-1] & border[1:])
        block = np.cumsum(border[:-1], dtype=np.int32)[shared]
        suffix = suffix[shared]
        if not len(suffix):
            break
    smallest = owner.copy()
    if len(suffix):
        found = place[suffix]
        first = np.flatnonzero(np.diff(block, prepend=-1))
        least = np.minimum.reduceat(owner[found], first)
        smallest[found] = np.repeat(least, np.diff(np.append(first, len(found))))
    return smallest, starts
