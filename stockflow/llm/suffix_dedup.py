"""Suffix-array dedup: removes every byte covered by a 50-byte string that also starts in a
document with a smaller doc_id. Strings are judged on the input, overlaps count.

All texts cannot be in one suffix array, so the suffixes are dealt out first, without loss:

1. The window at every byte has an anchor: of the 20-byte strings in it, the first with the
   smallest hash. Equal windows have equal anchors at equal places. Consecutive windows with
   the same anchor are a run, some 65 bytes of text.
2. Runs make chunks; a chunk ends where an anchor's hash says so. A chunk that a smaller
   document holds as well (by a 128-bit hash) is removed whole: that settles most copies.
3. What is left is settled by anchors: only runs whose anchor occurs in two different chunks
   can hold a repeated window. They go to the group of their anchor; a run of an anchor in
   very many chunks goes window by window, to the groups of the windows.
4. In a group, Burrows-Wheeler transforms of shards of runs are merged by interleave
   refinement (``bwt``), which gives the intervals of equal 50-byte prefixes and so the
   smallest doc_id of each window.
5. Answers return to the documents as bits per window.

Documents are worked on in batches of a bounded size, which are dealt out once. Messages
between batches and groups are packed arrays; a batch says of an anchor only one chunk and
how many, so an anchor that a third of all documents hold stays small.

Defined cases: a NULL text is empty; a document with a NULL doc_id is left alone and settles
nothing; rows with equal doc_id are documents of their own that do not touch each other; an
empty table gives no rows. ``deduplicated`` removes whole characters only: one that is
partly outside a removed run stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.llm.bwt import repeated_windows
from stockflow.llm.common import releasing_group, releasing_pair, ship_package
from stockflow.llm.shingles import mixed, text_slices

WINDOW = 50
ANCHOR = 20
CHUNK_RUNS = 16  # runs per chunk, on average
BATCH_BYTES = 12 << 20
# arrays over the bytes of so much text stay in a core's cache
SLICE_BYTES = 256 << 10
GROUPS_PER_BATCH = 4
# an anchor in so many chunks sends windows instead of runs
BUSY_CHUNKS = 2000

_SPAN = WINDOW - ANCHOR + 1  # anchors a window can choose from


# -- one batch of documents ---------------------------------------------------------------


@dataclass
class Runs:
    """Runs of windows with the same anchor, in order, of the texts of one slice."""

    data: np.ndarray
    first: np.ndarray  # start of the first window
    last: np.ndarray  # start of the last window
    anchor: np.ndarray  # hash of the anchor
    text: np.ndarray  # which text of the slice
    chunk: np.ndarray  # number of the chunk, from 0
    digests: list[bytes]  # of each chunk
    chunk_text: np.ndarray


def runs_of(data: np.ndarray, edges: np.ndarray, wanted: np.ndarray) -> Runs | None:
    """The runs of the wanted texts."""
    if len(data) < WINDOW:
        return None
    size = np.diff(edges)
    windows = np.where(wanted, np.maximum(size - WINDOW + 1, 0), 0)
    if not windows.any():
        return None
    n = len(data) - ANCHOR + 1
    word = np.ndarray((len(data) - 7,), "<u8", data.data, strides=(1,))
    tail = np.ndarray((len(data) - 3,), "<u4", data.data, strides=(1,))
    hashes = mixed(
        word[:n] * np.uint64(0x9E3779B97F4A7C15)
        + word[8 : n + 8] * np.uint64(0xC2B2AE3D27D4EB4F)
        + tail[16 : n + 16] * np.uint64(0x165667B19E3779F9)
    )
    # hash above, place below: the smallest is the first with the smallest hash
    least = (hashes & ~np.uint64(0xFFFFFFFF)) | np.arange(n, dtype=np.uint64)
    width = 1
    while width < _SPAN:
        step = min(width, _SPAN - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    offsets = np.concatenate([[0], np.cumsum(windows)])
    start = np.arange(offsets[-1]) + np.repeat(edges[:-1] - offsets[:-1], windows)
    chosen = least[start]
    opens = np.zeros(len(start), bool)
    np.not_equal(chosen[1:], chosen[:-1], out=opens[1:])
    opens[offsets[:-1][windows > 0]] = True
    begins = np.flatnonzero(opens)
    first, last = start[begins], start[np.append(begins[1:], len(start)) - 1]
    anchor = hashes[(chosen[begins] & np.uint64(0xFFFFFFFF)).astype(np.int64)]
    text = np.searchsorted(offsets, begins, "right") - 1
    opens = (np.diff(text, prepend=-1) != 0) | ((anchor >> np.uint64(8)) % np.uint64(CHUNK_RUNS) == 0)
    chunk = np.cumsum(opens) - 1
    heads = np.flatnonzero(opens)
    tails = np.append(heads[1:], len(first)) - 1
    raw, digest = memoryview(data), xxhash.xxh3_128_digest
    digests = [digest(raw[a : b + WINDOW]) for a, b in zip(first[heads].tolist(), last[tails].tolist(), strict=True)]
    return Runs(data, first, last, anchor, text, chunk, digests, text[heads])


@dataclass
class Batch:
    """The runs of all texts of a batch, the texts in order of doc_id and content."""

    table: pa.Table
    doc_ids: list
    slices: list[tuple[int, np.ndarray, np.ndarray, Runs | None]]  # first text, bytes, edges, runs

    @classmethod
    def of(cls, table: pa.Table) -> Batch:
        ids = table.column("doc_id").to_pylist()
        texts = table.column("text").to_pylist()
        order = sorted(
            range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, hashlib.md5((texts[i] or "").encode()).digest())
        )
        table = table.take(pa.array(order, pa.int64()))
        doc_ids = [ids[i] for i in order]
        del texts
        column, slices, at = table.column("text").combine_chunks(), [], 0
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
        for data, edges in text_slices(column, SLICE_BYTES):
            wanted = np.array([doc_ids[at + i] is not None for i in range(len(edges) - 1)], bool)
            slices.append((at, data, edges, runs_of(data, edges, wanted)))
            at += len(edges) - 1
        return cls(table, doc_ids, slices)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The different anchors, in order; a chunk of each (a number of 48 bits), and in
        how many different chunks they are."""
        some = [runs for *_, runs in self.slices if runs is not None]
        if not some:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        short = [np.frombuffer(b"".join(runs.digests), "<u8")[::2] >> np.uint64(16) for runs in some]
        anchor = np.concatenate([runs.anchor for runs in some])
        chunk = np.concatenate([one[runs.chunk] for one, runs in zip(short, some, strict=True)])
        order = np.lexsort((chunk, anchor))
        anchor, chunk = anchor[order], chunk[order]
        new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        new_pair = new_anchor | np.concatenate([[True], chunk[1:] != chunk[:-1]])
        heads = np.flatnonzero(new_anchor)
        return anchor[heads], chunk[heads], np.add.reduceat(new_pair.astype(np.int64), heads)

    def chunks(self) -> dict[bytes, int]:
        """The different chunks, each with its smallest doc_id here."""
        found: dict[bytes, int] = {}
        for at, _, _, runs in self.slices:
            if runs is not None:
                for digest, text in zip(runs.digests, runs.chunk_text.tolist(), strict=True):
                    found.setdefault(digest, self.doc_ids[at + text])
        return found


def _groups(values: np.ndarray, n_groups: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts values group by group, and where each group starts in it."""
    group = (mixed(values) % np.uint64(n_groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    return order, np.searchsorted(group[order], np.arange(n_groups + 1))


def _chunk_numbers(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8")[::2]


_ASK_DDL = "target long, batch long, anchors binary, near binary, counts binary, chunks binary, owners binary"
_ASK = pa.schema([("target", pa.int64()), ("batch", pa.int64())] + [(n, pa.binary()) for n in ("anchors", "near", "counts", "chunks", "owners")])


def _ask(n_groups: int):
    """A batch asks each group about its anchors and chunks."""

    def run(table: pa.Table) -> pa.Table:
        batch, rows = Batch.of(table), []
        number = table.column("batch")[0].as_py()
        anchor, near, counts = batch.anchors()
        digests = batch.chunks()
        keys = list(digests)
        owners = np.array(list(digests.values()), np.int64)
        order, edges = _groups(anchor, n_groups)
        chunk_order, chunk_edges = _groups(_chunk_numbers(keys), n_groups)
        for g in range(n_groups):
            own = order[edges[g] : edges[g + 1]]
            own_chunks = chunk_order[chunk_edges[g] : chunk_edges[g + 1]]
            if len(own) or len(own_chunks):
                rows.append(
                    (
                        g,
                        number,
                        (anchor[own] >> np.uint64(32)).astype("<u4").tobytes(),
                        near[own].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes(),
                        np.minimum(counts[own], 65535).astype("<u2").tobytes(),
                        b"".join([keys[i] for i in own_chunks.tolist()]),
                        owners[own_chunks].astype("<i8").tobytes(),
                    )
                )
        return _table(rows, _ASK)

    return run


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)


_TELL_DDL = "target long, sender long, kind int, anchors binary, chunks binary"
_TELL = pa.schema([("target", pa.int64()), ("sender", pa.int64()), ("kind", pa.int32()), ("anchors", pa.binary()), ("chunks", pa.binary())])
_FACTS, _WINDOWS = 0, 1


def _tell(table: pa.Table) -> pa.Table:
    """A group tells each batch which anchors are in two chunks or more (1; 2 if in very
    many), and which chunks a smaller document elsewhere holds."""
    group = table.column("target")[0].as_py()
    batches = table.column("batch").to_pylist()
    parts = {name: table.column(name).to_pylist() for name in ("anchors", "near", "counts", "chunks", "owners")}
    sizes = [len(one) // 4 for one in parts["anchors"]]
    anchor = np.frombuffer(b"".join(parts["anchors"]), "<u4")
    near = np.zeros((len(anchor), 8), np.uint8)
    near[:, :6] = np.frombuffer(b"".join(parts["near"]), np.uint8).reshape(-1, 6)
    near = near.view("<u8")[:, 0]
    counts = np.frombuffer(b"".join(parts["counts"]), "<u2").astype(np.int64)
    flags = np.zeros(len(anchor), np.uint8)
    if len(anchor):
        order = np.argsort(anchor, kind="stable")
        heads = np.flatnonzero(np.diff(anchor[order].astype(np.int64), prepend=-1))
        spread = np.diff(np.append(heads, len(order)))
        low, high = np.minimum.reduceat(near[order], heads), np.maximum.reduceat(near[order], heads)
        most, total = np.maximum.reduceat(counts[order], heads), np.add.reduceat(counts[order], heads)
        found = ((low != high) | (most > 1)).astype(np.uint8)
        found[(found > 0) & (total > BUSY_CHUNKS)] = 2
        flags[order] = np.repeat(found, spread)
    smallest: dict[bytes, int] = {}
    digests = [[one[i : i + 16] for i in range(0, len(one), 16)] for one in parts["chunks"]]
    owners = [np.frombuffer(one, "<i8").tolist() for one in parts["owners"]]
    for keys, ids in zip(digests, owners, strict=True):
        for key, doc_id in zip(keys, ids, strict=True):
            if smallest.setdefault(key, doc_id) > doc_id:
                smallest[key] = doc_id
    rows, at = [], 0
    for batch, size, keys, ids in zip(batches, sizes, digests, owners, strict=True):
        held = np.array([smallest[key] < doc_id for key, doc_id in zip(keys, ids, strict=True)], bool)
        rows.append((batch, group, _FACTS, flags[at : at + size].tobytes(), np.packbits(held).tobytes()))
        at += size
    return _table(rows, _TELL)


@dataclass
class Questions:
    """Different strings whose windows a batch cannot settle alone, in a fixed order, and the
    places where they stand, slice by slice."""

    texts: list[bytes]
    sizes: np.ndarray  # windows of each string
    owners: np.ndarray  # the smallest doc_id that holds it here
    routes: np.ndarray  # equal windows must meet: by their anchor, or by their own bytes
    which: np.ndarray  # the string at each place
    start: np.ndarray
    doc_id: np.ndarray
    edges: np.ndarray  # the first place of each slice


class Settled:
    """A batch with what the groups told it about anchors and chunks."""

    def __init__(self, batch: Batch, told: pa.Table, n_groups: int):
        self.batch = batch
        facts = {}
        if told.num_rows:
            for sender, kind, anchors, chunks in zip(
                *[told.column(n).to_pylist() for n in ("sender", "kind", "anchors", "chunks")], strict=True
            ):
                if kind == _FACTS:
                    facts[sender] = (anchors, chunks)
        some = [runs.anchor for *_, runs in batch.slices if runs is not None]
        # those of ``Batch.anchors``, which were sent in this order
        anchor, which = np.unique(np.concatenate(some), return_inverse=True) if some else (np.zeros(0, np.uint64), None)
        order, edges = _groups(anchor, n_groups)
        flags = np.zeros(len(anchor), np.uint8)
        self.smallest = batch.chunks()
        keys = list(self.smallest)
        chunk_order, chunk_edges = _groups(_chunk_numbers(keys), n_groups)
        held = np.zeros(len(keys), bool)
        for g, (anchors, chunks) in facts.items():
            flags[order[edges[g] : edges[g + 1]]] = np.frombuffer(anchors, np.uint8)
            own = chunk_order[chunk_edges[g] : chunk_edges[g + 1]]
            held[own] = np.unpackbits(np.frombuffer(chunks, np.uint8), count=len(own)).astype(bool)
        self._elsewhere = dict(zip(keys, held.tolist(), strict=True))
        # what was told of each run's anchor, slice by slice
        edges = np.cumsum([len(one) for one in some])[:-1]
        told_of = iter(np.split(flags[which], edges) if some else ())
        self._flags = [None if runs is None else next(told_of) for *_, runs in batch.slices]

    def removed_chunks(self, at: int, runs: Runs) -> np.ndarray:
        """Which chunks of a slice a smaller document holds."""
        doc_ids = self.batch.doc_ids
        return np.array(
            [
                self._elsewhere[digest] or self.smallest[digest] < doc_ids[at + text]
                for digest, text in zip(runs.digests, runs.chunk_text.tolist(), strict=True)
            ],
            bool,
        )

    def questions(self) -> Questions:
        """The open strings, each different one once, in a fixed order."""
        number: dict[bytes, int] = {}
        which: list[int] = []
        columns = {name: [] for name in ("kind", "start", "doc_id", "anchor")}
        edges = [0]
        known = np.array([0 if doc_id is None else doc_id for doc_id in self.batch.doc_ids], np.int64)
        for (at, data, _, runs), flag in zip(self.batch.slices, self._flags, strict=True):
            if runs is not None:
                open_ = np.flatnonzero(~self.removed_chunks(at, runs)[runs.chunk] & (flag > 0))
                kind, first, last = flag[open_], runs.first[open_], runs.last[open_]
                # a whole run, or each of its windows
                spans = np.where(kind == 1, 1, last - first + 1)
                run = np.repeat(np.arange(len(open_)), spans)
                start = first[run] + np.arange(len(run)) - np.repeat(np.cumsum(spans) - spans, spans)
                end = np.where(kind[run] == 1, last[run], start) + WINDOW
                raw = data.tobytes()
                which += [number.setdefault(raw[a:b], len(number)) for a, b in zip(start.tolist(), end.tolist(), strict=True)]
                columns["kind"].append(kind[run])
                columns["start"].append(start)
                columns["doc_id"].append(known[at + runs.text[open_]][run])
                columns["anchor"].append(runs.anchor[open_][run])
            edges.append(len(which))
        kinds = {"kind": np.uint8, "start": np.int64, "doc_id": np.int64, "anchor": np.uint64}
        found = {name: np.concatenate([np.zeros(0, kinds[name]), *parts]) for name, parts in columns.items()}
        places, texts = np.array(which, np.int64), list(number)
        # numbers rise, and texts come in order of doc_id: the first place has the smallest
        first = np.flatnonzero(np.diff(np.maximum.accumulate(places), prepend=-1))
        routes = found["anchor"][first]
        for i in np.flatnonzero(found["kind"][first] != 1).tolist():
            routes[i] = xxhash.xxh3_64_intdigest(texts[i])
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) - WINDOW + 1
        return Questions(
            texts, sizes, found["doc_id"][first], routes, places, found["start"], found["doc_id"], np.array(edges)
        )


def _by_group(questions: Questions, n_groups: int) -> Iterator[tuple[int, np.ndarray]]:
    """The numbers of the strings of each group that has some."""
    order, edges = _groups(questions.routes ^ np.uint64(0x5851F42D4C957F2D), n_groups)
    for g in np.flatnonzero(np.diff(edges)).tolist():
        yield g, order[edges[g] : edges[g + 1]]


def _spread_out(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each begin on, ``size`` of them, one after the other."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


_OPEN_DDL = "target long, batch long, sizes binary, texts binary, owners binary"
_OPEN = pa.schema([("target", pa.int64()), ("batch", pa.int64())] + [(n, pa.binary()) for n in ("sizes", "texts", "owners")])


def _open(n_groups: int):
    """A batch sends its open strings to the groups that settle them."""

    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _table([], _OPEN)
        number = texts.column("batch")[0].as_py()
        questions, rows = Settled(Batch.of(texts), told, n_groups).questions(), []
        for g, own in _by_group(questions, n_groups):
            sizes = (questions.sizes[own] + WINDOW - 1).astype(np.uint8)
            owners = questions.owners[own].astype("<i8")
            rows.append((g, number, sizes.tobytes(), b"".join([questions.texts[i] for i in own.tolist()]), owners.tobytes()))
        return _table(rows, _OPEN)

    return run


def _settle(table: pa.Table) -> pa.Table:
    """A group finds the smallest document of every window of its strings."""
    group = table.column("target")[0].as_py()
    number: dict[bytes, int] = {}
    which: list[int] = []
    columns = [table.column(n).to_pylist() for n in ("batch", "sizes", "texts", "owners")]
    for sizes, texts in zip(*columns[1:3], strict=True):
        ends = np.cumsum(np.frombuffer(sizes, np.uint8), dtype=np.int64).tolist()
        which += [number.setdefault(texts[a:b], len(number)) for a, b in zip([0, *ends], ends, strict=False)]
    strings, asked = list(number), np.array(which, np.int64)
    owners = np.frombuffer(b"".join(columns[3]), "<i8")
    smallest_here = np.full(len(strings), np.iinfo(np.int64).max)
    np.minimum.at(smallest_here, asked, owners)
    smallest, starts = repeated_windows(strings, smallest_here, WINDOW)
    rows, at = [], 0
    for batch, sizes in zip(*columns[:2], strict=True):
        windows = np.frombuffer(sizes, np.uint8).astype(np.int64) - WINDOW + 1
        own = slice(at, at + len(windows))
        bits = smallest[_spread_out(starts[asked[own]], windows)] < np.repeat(owners[own], windows)
        rows.append((batch, group, _WINDOWS, np.packbits(bits).tobytes(), None))
        at += len(windows)
    return _table(rows, _TELL)


def _finish(n_groups: int, report):
    """A batch marks the removed bytes of its documents and reports on them."""

    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        settled = Settled(Batch.of(texts), told, n_groups)
        answers = {}
        if told.num_rows:
            for sender, kind, bits in zip(*[told.column(n).to_pylist() for n in ("sender", "kind", "anchors")], strict=True):
                if kind == _WINDOWS:
                    answers[sender] = bits
        batch = settled.batch
        # +1 where removed bytes begin, -1 behind their end
        marks = [np.zeros(len(data) + 1, np.int32) for _, data, _, _ in batch.slices]
        for no, (at, _, _, runs) in enumerate(batch.slices):
            if runs is not None:
                gone = settled.removed_chunks(at, runs)[runs.chunk]
                np.add.at(marks[no], runs.first[gone], 1)
                np.add.at(marks[no], runs.last[gone] + WINDOW, -1)
        questions = settled.questions()
        # the repeated windows of each string: how many, where they begin among all, their offsets
        told_bits, asked = [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
        for g, own in _by_group(questions, n_groups):
            size = int(questions.sizes[own].sum())
            told_bits.append(np.unpackbits(np.frombuffer(answers[g], np.uint8), count=size))
            asked.append(own)
        order = np.concatenate(asked)
        hits = np.flatnonzero(np.concatenate(told_bits))
        ends = np.cumsum(questions.sizes[order])
        upto = np.searchsorted(hits, ends)
        repeats, begins = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        repeats[order] = np.diff(upto, prepend=0)
        begins[order] = upto - repeats[order]
        offsets = (hits - np.repeat(ends - questions.sizes[order], repeats[order])).astype(np.uint8)
        for mark, a, b in zip(marks, questions.edges[:-1].tolist(), questions.edges[1:].tolist(), strict=True):
            which, start = questions.which[a:b], questions.start[a:b]
            # the smaller document here holds the whole string
            whole = questions.doc_id[a:b] > questions.owners[which]
            np.add.at(mark, start[whole], 1)
            np.add.at(mark, start[whole] + questions.sizes[which[whole]] - 1 + WINDOW, -1)
            which, start = which[~whole], start[~whole]
            repeated = np.repeat(start, repeats[which]) + offsets[_spread_out(begins[which], repeats[which])]
            np.add.at(mark, repeated, 1)
            np.add.at(mark, repeated + WINDOW, -1)
        found = []
        for (at, data, edges, _), mark in zip(batch.slices, marks, strict=True):
            gone = np.cumsum(mark[:-1]) > 0
            for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
                found.append(report(at + i, data[a:b], gone[a:b]))
        return pa.Table.from_batches([report.batch(batch.table, found)])

    return run


class Digests:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    names = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def __call__(self, place: int, data: np.ndarray, gone: np.ndarray) -> tuple:
        n_gone = int(gone.sum())
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(len(gone) > 0 and gone[0])
        kept = data[~gone] if n_gone else data
        return len(data), n_gone, spans, hashlib.sha256(kept.tobytes()).hexdigest()

    def batch(self, table: pa.Table, found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)]
        ids = pa.array(table.column("doc_id").to_pylist(), pa.int64())
        return pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", *self.names])


class Texts:
    """The documents with what is left of their texts; those with nothing left go."""

    def __init__(self, names: list[str]):
        self._names = names

    def __call__(self, place: int, data: np.ndarray, gone: np.ndarray) -> str | None:
        if not gone.any():
            return None
        # continuation bytes follow their character's first: a character goes if all of it does
        first = (data & 0xC0) != 0x80
        number = np.cumsum(first) - 1
        stays = np.bincount(number, ~gone, number[-1] + 1) > 0
        return data[stays[number]].tobytes().decode()

    def batch(self, table: pa.Table, found: list) -> pa.RecordBatch:
        old = table.column("text").to_pylist()
        changed = np.array([text is not None for text in found], bool)
        texts = [o if text is None else text for o, text in zip(old, found, strict=True)]
        kept = pa.array([text != "" or not c for text, c in zip(texts, changed.tolist(), strict=True)])
        columns = []
        for name in self._names:
            column = table.column(name).combine_chunks()
            if name == "text":
                column = pa.array(texts, column.type)
            elif name == "n_chars":
                sizes = [len(t) if c else o for t, c, o in zip(texts, changed.tolist(), column.to_pylist(), strict=True)]
                column = pa.array(sizes, column.type)
            columns.append(column)
        return pa.RecordBatch.from_arrays(columns, names=self._names).filter(kept)


def _run(docs: DataFrame, report, schema) -> DataFrame:
    spark = docs.sparkSession
    ship_package(spark)
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_batches = max(1, -(-total // BATCH_BYTES))
    n_groups = GROUPS_PER_BATCH * n_batches
    batched = docs.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_batches)))
    # one shuffle of the texts, read by all three passes over them
    texts = batched.groupBy("batch")
    asked = texts.applyInArrow(releasing_group(_ask(n_groups)), _ASK_DDL)
    told = asked.groupBy("target").applyInArrow(releasing_group(_tell), _TELL_DDL)
    opened = texts.cogroup(told.groupBy("target")).applyInArrow(releasing_pair(_open(n_groups)), _OPEN_DDL)
    windows = opened.groupBy("target").applyInArrow(releasing_group(_settle), _TELL_DDL)
    answers = told.unionByName(windows)
    return texts.cogroup(answers.groupBy("target")).applyInArrow(releasing_pair(_finish(n_groups, report)), schema)


def removed_spans(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return _run(rows, Digests(), Digests.ddl)


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents without repeated strings, ``n_chars`` counted again; same columns.

    A document of which nothing is left goes.
    """
    names = docs.columns
    own = docs.withColumnsRenamed({name: f"__{name}" for name in names if name.lower() == "batch"})
    schema = T.StructType(own.schema.fields)
    return _run(own, Texts(own.columns), schema).toDF(*names)
