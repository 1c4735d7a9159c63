"""The divergence audit against a plain version."""

import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from stockflow.llm import divergence as d
from tests.llm.helpers import COLUMNS, documents, odd_documents

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, min_docs, limit=50):
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        key = (lang or "", source or "")
        groups.add(key)
        terms = TERM.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
        counts[key].update(terms)
        in_docs[key[0]].update(set(terms))
    found = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in in_docs[lang].items() if n >= min_docs)
        own = sorted(g for g in groups if g[0] == lang)
        whole = Counter()
        for g in own:
            whole.update({t: counts[g][t] for t in kept})

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {g: shares(counts[g]) for g in own}, shares(whole)
        for g in own:
            pairs = [(sum(abs(p[g][t] - p[h][t]) for t in kept), h[1]) for h in own if h != g]
            terms = [(p[g][t] - q[t], t) for t in kept if counts[g][t] and p[g][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ordered = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                ordered = ordered if part == "pair" else ordered[:limit]
                found += [(*g, part, item, value, i + 1) for i, (value, item) in enumerate(ordered)]
    return sorted(found, key=repr)


def several(seed=5):
    """Documents of many sources, some without any term, over two languages and NULLs."""
    rng = np.random.default_rng(seed)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120)] + ["é", "Zz", "日本"]
    made = []
    for i in range(300):
        source = f"s{rng.integers(0, 9)}" if i % 3 else "hot"
        pick = rng.zipf(1.4, rng.integers(0, 40)) % len(words)
        made.append((i, " ".join(words[k] for k in pick), ["aa", "bb", None][i % 7 % 3], source, 0))
    return made + [(900, None, "aa", "empty", 0), (901, "12 34", "lone", "only", 0), (902, "!", None, None, 0), made[3], made[3]]


@pytest.mark.parametrize("block_terms, tile_groups", [(64, 32), (7, 3), (1, 1)])
def test_pairs_for_any_block_and_tile(spark, rows, block_terms, tile_groups):
    made = several()
    found = d.Shares(documents(spark, made), 3).pairs(block_terms=block_terms, tile_groups=tile_groups)
    assert rows(found) == [row for row in plain(made, 3) if row[2] == "pair"]


@pytest.mark.parametrize("make, min_docs", [(several, 3), (several, 30), (odd_documents, 4), (odd_documents, 500)])
def test_audit_equals_a_plain_version(spark, rows, make, min_docs):
    made = make()
    found = d.audit(documents(spark, made), min_docs)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert dict(found.dtypes)["value"] == "bigint" and dict(found.dtypes)["rank"] == "int"
    assert rows(found) == plain(made, min_docs)


def test_counts_that_are_handed_on_early_are_the_same(spark, rows, monkeypatch):
    made = several()
    monkeypatch.setattr(d, "HELD_ROWS", 20)
    assert len({(r.lang, r.source, r.term) for r in d.term_counts(documents(spark, made)).collect()}) == d.term_counts(
        documents(spark, made)
    ).count()


def test_joint_tables_are_products_of_marks():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 5, 40), rng.integers(0, 4, (3, 40)) + np.array([[0], [4], [8]])
    table = d.joint_table(a, 5, b, 12)
    for (i, j) in itertools.product(range(5), range(12)):
        assert table[i, j] == ((a == i) & (b[j // 4] == j)).sum()


def test_empty_table_and_other_columns(spark):
    assert d.audit(spark.createDataFrame([], COLUMNS)).count() == 0
    docs = documents(spark, several()).selectExpr("*", "1 AS term", "2 AS n", "3 AS place", "4 AS unit", "'x' AS value")
    assert d.audit(docs, 3).count() == len(plain(several(), 3))
