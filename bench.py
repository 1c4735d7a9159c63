"""Time every model and the main operators; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) holds the flat tables, BENCH_CPUS is the
number of local cores. Models are built in dependency order and written as Parquet,
as in the daily refresh; operator queries go to a sink that discards the rows. The
raw tables are derived from the flat tables first, and that time is reported apart.
A run over the smallest tables warms the JVM up and is not counted. Loading queries are
timed too, with the writing of their pages, and kept out of the total.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry.loading import LOADING_QUERIES  # noqa: E402
from registry.operators import OPERATOR_QUERIES  # noqa: E402
from stockflow import build_session  # noqa: E402
from stockflow.plans.models import (  # noqa: E402
    MART_MODELS,
    STAGING_MODELS,
    TABLE,
    StoredTables,
    stored_layout,
)
from stockflow.session import scratch_path  # noqa: E402
from stockflow.sources import TableStore, feed  # noqa: E402

OPERATORS = (
    "latest_version",
    "latest_by_two_keys",
    "json_scalar",
    "conditional_units",
    "pivot_fixed_names",
    "distinct_counts",
    "union_reaggregate",
    "inner_star",
    "left_expr_join",
    "left_two_keys",
    "whole_table_rank",
    "single_best_line",
)


# from landed pages on; the refresh runs twice, over all versions
LOADING = ("page_unnest", "stream_ingest", "cursor_roundtrip", "refresh_summary")


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def write_or_fail(store: TableStore, name: str, rows) -> None:
    result = store.replace(name, rows)
    if not result.ok:
        raise RuntimeError(f"{name}: {result.error_message}")


def run(spark, folder: str) -> tuple[dict[str, float], dict[str, float], float]:
    """Seconds per model and operator, per loading query, and for deriving the raw tables."""
    store = TableStore(spark, scratch_path(spark, "bench"))
    tables = StoredTables(store, feed.FEED_CONFIG)
    setup = sum(
        timed(lambda: write_or_fail(store, name, build(spark, folder)))
        for name, build in feed.RAW_TABLES.items()
    )
    seconds = {}
    for model in (*STAGING_MODELS, *MART_MODELS):
        if model.kind == TABLE:
            seconds[model.name] = timed(
                lambda: write_or_fail(
                    store, model.name, stored_layout(model, model.build(tables, tables.cfg))
                )
            )
        else:
            seconds[model.name] = timed(
                lambda: model.build(tables, tables.cfg).write.format("noop").mode("overwrite").save()
            )
    for name in OPERATORS:
        seconds[name] = timed(
            lambda: OPERATOR_QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        )
    loading = {
        name: timed(lambda: LOADING_QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save())
        for name in LOADING
    }
    return seconds, loading, round(setup, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "stockflow-bench",
        {
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": "16" if cpus == "*" else str(2 * int(cpus)),
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    smallest = Path(folder).parent / "sf0.001"
    if smallest.is_dir():
        run(spark, str(smallest))
    seconds, loading, setup = run(spark, folder)
    models = len(STAGING_MODELS) + len(MART_MODELS)
    print(
        json.dumps(
            {
                "metric": "staging_marts_and_operators_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "models_total": round(sum(list(seconds.values())[:models]), 3),
                "loading": loading,
                "derive_raw_tables": setup,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
