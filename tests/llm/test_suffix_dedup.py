"""Removed bytes against a table of all 50-byte strings."""

import hashlib
import random

import numpy as np
import pytest

from stockflow.llm import bwt, suffix_dedup
from stockflow.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.helpers import documents, odd_documents

W = suffix_dedup.WINDOW


def removed(rows):
    """A mask of removed bytes per row."""
    smallest: dict[bytes, int] = {}
    texts = [(row[0], (row[1] or "").encode()) for row in rows]
    for doc_id, text in texts:
        if doc_id is not None:
            for i in range(len(text) - W + 1):
                window = text[i : i + W]
                smallest[window] = min(smallest.get(window, doc_id), doc_id)
    masks = []
    for doc_id, text in texts:
        mask = np.zeros(len(text), bool)
        if doc_id is not None:
            for i in range(len(text) - W + 1):
                if smallest[text[i : i + W]] < doc_id:
                    mask[i : i + W] = True
        masks.append(mask)
    return masks


def digest(row, mask):
    data = np.frombuffer((row[1] or "").encode(), np.uint8)
    spans = int((np.diff(mask.astype(int), prepend=0) == 1).sum())
    return row[0], len(data), int(mask.sum()), spans, hashlib.sha256(data[~mask].tobytes()).hexdigest()


def in_order(found):
    return sorted(found, key=repr)


@pytest.mark.parametrize("batch_bytes", [3_000, 1 << 20])
def test_odd_documents(spark, monkeypatch, batch_bytes):
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", batch_bytes)
    rows = odd_documents()
    found = suffix_dedup.removed_spans(documents(spark).selectExpr("*", "1 as batch", "'x' as target"))
    assert in_order(tuple(r) for r in found.collect()) == in_order(map(digest, rows, removed(rows)))


def test_busy_anchors_send_windows(spark, monkeypatch):
    """The same result when every shared anchor counts as busy. The limit is read where the
    group runs, so the pieces are called here one after the other."""
    monkeypatch.setattr(suffix_dedup, "BUSY_CHUNKS", 0)
    import pyarrow as pa

    rows = odd_documents(3)
    table = pa.table(
        {"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows], "batch": [i % 3 for i in range(len(rows))]}
    )
    parts = [table.filter(pa.compute.equal(table["batch"], i)) for i in range(3)]

    def by(name, tables):
        whole = pa.concat_tables(tables)
        return {v: whole.filter(pa.compute.equal(whole[name], v)) for v in set(whole[name].to_pylist())}

    none = suffix_dedup._TELL.empty_table()
    told = by("target", [suffix_dedup._tell(t) for t in by("target", [suffix_dedup._ask(4)(p) for p in parts]).values()])
    opened = [suffix_dedup._open(4)(p, told.get(i, none)) for i, p in enumerate(parts)]
    windows = [suffix_dedup._settle(t) for t in by("target", opened).values()]
    answers = by("target", [*told.values(), *windows])
    found = [suffix_dedup._finish(4, suffix_dedup.Digests())(p, answers.get(i, none)) for i, p in enumerate(parts)]
    got = [tuple(r.values()) for r in pa.concat_tables(found).to_pylist()]
    assert in_order(got) == in_order(map(digest, rows, removed(rows)))


def test_all_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op2_suffix_dedup"](spark, SMALL).collect()
    assert in_order(tuple(r) for r in found) == in_order(map(digest, rows, removed(rows)))


def test_texts_lose_whole_characters_only(spark):
    rows = odd_documents()
    kept = suffix_dedup.deduplicated(documents(spark))
    assert kept.columns == documents(spark).columns
    expected = []
    for row, mask in zip(rows, removed(rows), strict=True):
        text, at, left = row[1] or "", 0, []
        for char in text:
            size = len(char.encode())
            if not mask[at : at + size].all():
                left.append(char)
            at += size
        if not mask.any():
            expected.append(row)
        elif left:
            expected.append((row[0], "".join(left), *row[2:4], len(left)))
    assert in_order(tuple(r) for r in kept.collect()) == in_order(expected)


def test_no_documents(spark):
    assert suffix_dedup.removed_spans(documents(spark, [])).count() == 0
    assert suffix_dedup.deduplicated(documents(spark, [])).count() == 0


@pytest.mark.parametrize("shard_bytes", [10, 60, 10_000])
def test_merged_transforms_find_the_smallest_owner(monkeypatch, shard_bytes):
    monkeypatch.setattr(bwt, "SHARD_BYTES", shard_bytes)
    rng = random.Random(shard_bytes)
    for _ in range(60):
        window = rng.choice([1, 3, 9, 17])
        strings = [bytes(rng.choice(b"ab\x00\xc3") for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 25))]
        owners = np.array([rng.randint(0, 5) for _ in strings])
        smallest, starts = bwt.repeated_windows(strings, owners, window)
        best: dict[bytes, int] = {}
        for string, owner in zip(strings, owners.tolist(), strict=True):
            for i in range(len(string) - window + 1):
                best[string[i : i + window]] = min(best.get(string[i : i + window], 99), owner)
        for string, start in zip(strings, starts.tolist(), strict=False):
            for i in range(len(string) - window + 1):
                assert smallest[start + i] == best[string[i : i + window]]


def test_only_what_ends_a_window_is_refined(monkeypatch):
    rng = random.Random(5)
    shared = rng.randbytes(64).replace(b"\xff", b"a")
    strings = list(dict.fromkeys(shared[i % 10 :] + bytes([97 + i % 20]) for i in range(200)))
    carried, sort = [], np.argsort
    monkeypatch.setattr(bwt.np, "argsort", lambda a, **how: (a.dtype == np.uint8 and carried.append(len(a))) or sort(a, **how))
    owners = np.arange(len(strings))
    smallest, starts = bwt.repeated_windows(strings, owners, 50)
    for one, (text, start) in enumerate(zip(strings, starts.tolist(), strict=False)):
        for at in range(len(text) - 49):
            assert smallest[start + at] == min(i for i, other in enumerate(strings) if text[at : at + 50] in other)
    # a place for each window, not for each byte
    assert max(carried) <= sum(len(text) - 49 for text in strings)


def test_open_strings_are_worked_on_in_columns(monkeypatch):
    """A batch keeps its open strings and their places as arrays: some of them are repeated
    in it, some elsewhere, and work is done by slice, not by string."""
    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 3000)
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz     "
    texts = ["".join(rng.choices(letters, k=700)) for _ in range(20)]
    shared = "".join(rng.choices(letters, k=90))
    texts = [text[:300] + shared + text[300:] if i % 3 == 0 else text for i, text in enumerate(texts)]
    ids = list(range(20))
    table = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": texts, "batch": pa.array([0] * 20, pa.int64())})
    asked = suffix_dedup._ask(1)(table)
    told = suffix_dedup._tell(asked)
    settled = suffix_dedup.Settled(suffix_dedup.Batch.of(table), told, 1)
    open_ = settled.questions()
    assert len(open_.edges) == len(settled.batch.slices) + 1 > 3
    assert open_.edges[-1] == len(open_.which) == len(open_.start) == len(open_.doc_id)
    assert len(set(open_.texts)) == len(open_.texts) == len(open_.sizes) == len(open_.owners)
    for no, (_, data, _, _) in enumerate(settled.batch.slices):
        for place in range(open_.edges[no], open_.edges[no + 1]):
            which, start = open_.which[place], open_.start[place]
            text = open_.texts[which]
            assert data[start : start + len(text)].tobytes() == text
            assert len(text) == open_.sizes[which] + suffix_dedup.WINDOW - 1
    for which in range(len(open_.texts)):
        assert open_.owners[which] == open_.doc_id[open_.which == which].min()
    opened = suffix_dedup._open(1)(table, told)
    answers = pa.concat_tables([told, suffix_dedup._settle(opened)])
    found = suffix_dedup._finish(1, suffix_dedup.Digests())(table, answers).to_pylist()
    rows = list(zip(ids, texts, strict=True))
    assert in_order(tuple(row.values()) for row in found) == in_order(map(digest, rows, removed(rows)))
