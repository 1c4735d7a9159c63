"""Helpers that several corpus operators share."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from stockflow.session import shared_root

# a word: a run of anything but ASCII white space
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)

_shipped: set[str] = set()
# where the C library has it
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="package-"), "stockflow_package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def cut(df: DataFrame) -> DataFrame:
    """``df``, written to the shared checkpoint folder: its lineage ends there.

    The files go when the DataFrame does, if ``spark.cleaner.referenceTracking.cleanCheckpoints``
    is set.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def has_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, whatever else the table holds."""
    return df.select(*[df[name] for name in names])


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the table does not use yet, whatever its case."""
    used = {name.lower() for name in df.columns}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def release_memory() -> None:
    """Give what this worker no longer uses back to the system; workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def releasing(function):
    """A function for ``mapInArrow`` that gives memory back when its partition ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            release_memory()

    return run


def releasing_group(function):
    """The same for ``applyInArrow``."""

    def run(table: pa.Table) -> pa.Table:
        result = function(table)
        release_memory()
        return result

    return run


def releasing_pair(function):
    """The same for ``applyInArrow`` of two grouped tables."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        result = function(left, right)
        release_memory()
        return result

    return run


def groups_of(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The groups of a stream of batches whose rows come ordered by ``key``."""
    pending: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        runs = pc.run_end_encode(batch.column(batch.schema.get_field_index(key)))
        start = 0
        for value, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
            if pending and value != current:
                yield pa.Table.from_batches(pending)
                pending = []
            current = value
            pending.append(batch.slice(start, end - start))
            start = end
    if pending:
        yield pa.Table.from_batches(pending)
