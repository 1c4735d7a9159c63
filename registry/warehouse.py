"""The models over a folder of flat tables, written on first use.

A registered query runs one model over the stored tables it reads. Those are built
once per session and version of the input files, and kept in the shared folder.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.plans.models import MODELS, TABLE, StoredTables, stored_layout
from stockflow.session import prepare, scratch_path
from stockflow.sources import feed
from stockflow.sources.tables import TableStore

_open: dict[tuple, "Warehouse"] = {}


class Warehouse(StoredTables):
    """Raw tables from the feed, and every model, each written when first asked for."""

    def __init__(self, store: TableStore, folder: str):
        super().__init__(store, feed.FEED_CONFIG)
        self.folder = folder
        self.written: set[str] = set()
        self.locks = {name: Lock() for name in (*feed.RAW_TABLES, *MODELS)}

    def __getitem__(self, name: str) -> DataFrame:
        self._ensure(name)
        return super().__getitem__(name)

    def _ensure(self, name: str) -> None:
        # inputs at the same time: on small tables a single job leaves most cores idle
        inputs = MODELS[name].inputs if name in MODELS else ()
        if name not in self.written and inputs:
            with ThreadPoolExecutor(len(inputs)) as pool:
                list(pool.map(self._ensure, inputs))
        with self.locks[name]:
            if name not in self.written:
                self._write(name)
                self.written.add(name)

    def _write(self, name: str) -> None:
        if name in feed.RAW_TABLES:
            rows = feed.RAW_TABLES[name](self.store.spark, self.folder)
        elif MODELS[name].kind == TABLE:
            rows = stored_layout(MODELS[name], MODELS[name].build(self, self.cfg))
        else:
            return
        result = self.store.replace(name, rows)
        if not result.ok:
            raise RuntimeError(f"{name}: {result.error_message}")

    def model(self, name: str) -> DataFrame:
        """The model as a query over its stored inputs."""
        with ThreadPoolExecutor(len(MODELS[name].inputs)) as pool:
            list(pool.map(self._ensure, MODELS[name].inputs))
        return MODELS[name].build(self, self.cfg)


def _input_version(spark: SparkSession, folder: str) -> tuple:
    """Number, size and latest change of the input files; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    found = files.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.max(F.unix_micros("modificationTime")).alias("changed"),
    )
    return tuple(found.first())


def open_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    prepare(spark)
    key = (spark.sparkContext.applicationId, folder, _input_version(spark, folder))
    if key not in _open:
        _open[key] = Warehouse(TableStore(spark, scratch_path(spark, "warehouse")), folder)
    return _open[key]


NOT_COMPARED = (
    "payload", "modelled_at", "report_updated_at", "source", "entity", "extracted_at", "line_items", "shipping_lines", "refunds"
)


def present(df: DataFrame, *drop: str) -> DataFrame:
    """Columns as plain long, double, boolean and text, without clock and payload.

    Money has two decimals here; times and dates become text.
    """

    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("decimal(28,2)").cast("double")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        return column.alias(field.name)

    return df.select(
        *[plain(field) for field in df.schema.fields if field.name not in (*NOT_COMPARED, *drop)]
    )
