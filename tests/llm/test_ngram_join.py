"""The n-gram join against every pair, one at a time."""

from itertools import combinations

import pytest
from pyspark.sql import functions as F

from stockflow.llm import ngram_join
from stockflow.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.helpers import documents, grams, groups, odd_documents


def plain(rows):
    """(doc_id, class_id, n_links) of each row, in order."""
    sets = [grams(row[1]) for row in rows]
    links = [
        (i, j)
        for i, j in combinations(range(len(rows)), 2)
        if sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
    ]
    counts = [0] * len(rows)
    for i, j in links:
        counts[i] += 1
        counts[j] += 1
    group = groups(len(rows), links)
    found = []
    for i, row in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        found.append((row[0], min(ids) if ids and sets[i] else row[0], counts[i]))
    return found


def in_order(found):
    return sorted(found, key=repr)


def test_odd_documents(spark):
    rows = odd_documents()
    found = ngram_join.similar_documents(documents(spark).withColumn("key", F.lit(1)).withColumn("bands", F.lit("x")))
    assert in_order((r.doc_id, r.class_id, r.n_links) for r in found.collect()) == in_order(plain(rows))


def test_all_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op1_ngram_join"](spark, SMALL).collect()
    assert in_order((r.doc_id, r.class_id, r.n_links) for r in found) == in_order(plain(rows))


def test_copies_of_equal_texts(spark):
    found = ngram_join.similar_documents(documents(spark)).where("n_copies > 1").collect()
    assert found and all(r.n_links >= r.n_copies - 1 for r in found)


def test_one_document_of_each_group_stays(spark):
    rows = odd_documents()
    kept = ngram_join.keep_one_per_group(documents(spark))
    assert kept.columns == documents(spark).columns
    group = {}
    for row, (_, class_id, _) in zip(rows, plain(rows), strict=True):
        group.setdefault((class_id if grams(row[1]) else (row[0], row[1])), set()).add(row[0])
    left = [r.doc_id for r in kept.collect()]
    assert len(left) == len(group)
    for class_id in group:
        assert (class_id if not isinstance(class_id, tuple) else class_id[0]) in left


def test_one_near_copy_stays_whatever_the_doc_ids(spark):
    """Near copies of NULL doc_ids alone, and several that share the smallest doc_id."""
    words = [f"w{i}" for i in range(100)]

    def near(name: str, n: int) -> list[str]:
        return [" ".join([name + w for w in words] + [f"end{i}"]) for i in range(n)]

    nulls, equal, mixed, apart = near("a", 4), near("b", 3), near("c", 2), near("d", 1) + near("e", 1)
    rows = [(None, t) for t in nulls + nulls[:1]] + [(1, t) for t in equal + equal[:1]] + [(2, equal[0] + " more")]
    rows += [(None, mixed[0]), (7, mixed[1])] + [(None, t) for t in apart] + [(None, ""), (None, " "), (3, "")]
    kept = ngram_join.keep_one_per_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by_name = {}
    for r in kept:
        by_name.setdefault(r.text[:1] if r.text.strip() else "", []).append(r.doc_id)
    assert {k: v for k, v in by_name.items() if k} == {"a": [None], "b": [1], "c": [7], "d": [None], "e": [None]}
    assert len(by_name[""]) == 3


def test_no_documents(spark):
    assert ngram_join.similar_documents(documents(spark, [])).count() == 0
    assert ngram_join.keep_one_per_group(documents(spark, [])).count() == 0


def test_blocks_of_a_large_cluster(spark, monkeypatch):
    """The same counts when clusters are cut into blocks of a few texts."""
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", 3)
    rows = odd_documents(2)
    found = ngram_join.similar_documents(documents(spark, rows)).collect()
    assert in_order((r.doc_id, r.class_id, r.n_links) for r in found) == in_order(plain(rows))


@pytest.mark.parametrize("similarity", [0.8, 0.85, 0.95])
def test_a_pair_shares_a_band_with_the_promised_probability(similarity):
    missed = (1 - similarity**ngram_join.ROWS) ** ngram_join.BANDS
    assert missed <= 1 - ngram_join.RECALL
