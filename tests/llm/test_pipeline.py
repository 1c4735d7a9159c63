"""The pipeline, the components helper, and the registered names."""

import random

import __spark_entry__ as entry_points
import corpus_pipeline
from stockflow.llm.graph import components
from tests.conftest import SMALL
from tests.llm.helpers import documents, groups


def test_components(spark):
    rng = random.Random(1)
    n = 120
    links = [(rng.randrange(n), rng.randrange(n)) for _ in range(70)] + [(i, i + 1) for i in range(90, 119)]
    edges = spark.createDataFrame([*links, (5, None), (None, 6), (7, 7)], "a long, b long")
    found = {r.node: r.component for r in components(edges).collect()}
    expected = groups(n, links)
    assert found == {i: expected[i] for link in links if link[0] != link[1] for i in link}
    assert components(edges.limit(0)).count() == 0


def test_stages(spark, tmp_path):
    docs = documents(spark)
    folder = str(tmp_path)
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "ngram_jaccard_join", "suffix_array_dedup", "personal_data", "best_fit_packing"
    ]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, docs, folder)
        if i < 4:
            assert found.columns == docs.columns, name
            found.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
    assert found.count() > 0


def test_whole_run(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert found.count() > 0 and {"doc_id", "sequence_id", "offset", "length"} <= set(found.columns)


def test_eleven_queries_are_registered():
    names = entry_points.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
