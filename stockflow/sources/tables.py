"""Parquet tables under one root folder, and the outcome of a load.

Every load writes a folder of its own, which becomes part of its table, or takes the place of
all its parts, by one commit of the store. So a load that fails at any point leaves the table as
it was, two writers lose nothing of each other, and a reader that began on an older state can
finish.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.operators.upsert import upsert
from stockflow.sources.commits import Change, CommitLog, Snapshot
from stockflow.sources.files import changed_at, delete_folder, folder_bytes, folder_exists, folders_in

SUCCESS = "success"
FAILED = "failed"
# add to the table, take its place, or fail if it exists
DISPOSITIONS = ("append", "truncate", "empty")


@dataclass(frozen=True)
class LoadResult:
    """What a load did. ``latest`` is the value of ``track``, if one was asked for."""

    table: str
    status: str
    rows_loaded: int
    error_message: str | None = None
    latest: datetime | None = None

    @property
    def ok(self) -> bool:
        return self.status == SUCCESS


_VERSION = ".v-"
# Payloads repeat their keys: zstd makes raw orders about half of what Spark's default does. A file
# counts at least its opening cost when Spark packs files into tasks, so a bound on its rows
# bounds the rows of a task that reads it, however small they are compressed. Level 6 writes an eighth less of orders
# than the default of 3; level 9 writes another twentieth less, but takes twice as long.
WRITE_OPTIONS = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6", "maxRecordsPerFile": 100_000}
# parts below this size are joined into one once there are so many of them
SMALL_BYTES = 128 << 20
SMALL_PARTS = 20
# commits that stay on record; a folder that none of them names goes after a day
COMMITS_KEPT = 200
LEFTOVER_AGE = timedelta(days=1)
MERGE_ATTEMPTS = 5


class _Overtaken(Exception):
    """The parts that a merge read are no longer those of its table."""


@dataclass(frozen=True)
class TableStore:
    """Named tables in ``root``, a folder all executors can reach."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def _log(self) -> CommitLog:
        return CommitLog(self.path(".commits"))

    def _seen(self) -> Snapshot:
        """The commit that reads go by."""
        return self._log.newest()

    def _commit(self, change: Change) -> None:
        self._log.commit(change)

    def _parts(self, name: str, seen: Snapshot) -> list[str]:
        """Folders of a table; one that no commit names is the folder of its name, if any."""
        return seen.tables.get(name) or ([name] if folder_exists(self.path(name)) else [])

    def exists(self, name: str) -> bool:
        return bool(self._parts(name, self._seen()))

    def locations(self, name: str) -> list[str]:
        """Where the table is now."""
        return [self.path(folder) for folder in self._parts(name, self._seen()) or [name]]

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(*self.locations(name))

    def read_or_empty(self, name: str, schema: T.StructType) -> DataFrame:
        """The table, or no rows if there is none yet."""
        if not self.exists(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*self.locations(name))

    def load(
        self,
        name: str,
        rows: DataFrame,
        disposition: str = "append",
        track: Column | None = None,
        batch: tuple[str, int] | None = None,
    ) -> LoadResult:
        """Write ``rows`` and report how many; an error becomes a FAILED result.

        The count, and the maximum of ``track``, are taken while writing. ``batch`` names a
        stream and the number of one of its batches, which rise: rows and number become part of
        the table by one commit, and a batch that the table holds is not loaded again.
        """
        if disposition not in DISPOSITIONS:
            raise ValueError(f"disposition {disposition!r} is none of {', '.join(DISPOSITIONS)}")
        seen = Observation(f"load-{uuid.uuid4().hex}")
        measures = [F.count(F.lit(1)).alias("rows")]
        if track is not None:
            # without zone: Python would otherwise turn it into the driver's local time
            measures.append(F.max(track.cast("timestamp_ntz")).alias("latest"))
        folder = f"{name}{_VERSION}{uuid.uuid4().hex}"

        def change(now: Snapshot) -> Snapshot:
            if batch and now.holds(name, *batch):
                return now
            before = [] if disposition == "truncate" else self._parts(name, now)
            if before and disposition == "empty":
                raise FileExistsError(f"table {name} exists")
            after = now.with_tables({name: [*before, folder]})
            return after.with_batch(name, *batch) if batch else after

        try:
            # before the write: a batch loaded earlier, or a table that may not be there
            now = self._seen()
            if change(now) is now:
                return LoadResult(name, SUCCESS, 0)
            rows.observe(seen, *measures).write.options(**WRITE_OPTIONS).mode("error").parquet(self.path(folder))
            found = seen.get
            self._commit(change)
        except Exception as error:
            return LoadResult(name, FAILED, 0, str(error))
        return LoadResult(name, SUCCESS, found["rows"], latest=found.get("latest"))

    def replace(self, name: str, rows: DataFrame) -> LoadResult:
        """Full refresh: the table holds exactly ``rows`` afterwards, or, if that fails,
        what it held before."""
        return self.load(name, rows, "truncate")

    def merge(
        self,
        name: str,
        rows: DataFrame,
        keys: list[str],
        combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
        buckets: int = 64,
    ) -> LoadResult:
        """Merge ``rows`` into a table that is kept in buckets of its keys.

        Only the buckets that ``rows`` touch are read, combined and written again; the files of
        the others stay as they are. ``combine`` gets the stored and the new rows of these
        buckets; by default new rows take the place of stored ones with equal keys. ``rows`` are
        read twice: for the numbers of their buckets, of which there are at most ``buckets``, and
        to be merged; without any, nothing changes. NULL keys equal nothing. A merge that another writer overtook starts again.
        """
        field_name = f"__bucket_of_{buckets}"
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
        combine = combine or (lambda old, new: upsert(old, new, keys))
        try:
            touched = {f"{field_name}={row[0]}" for row in rows.select(bucket).distinct().collect()}
            if not touched:
                return LoadResult(name, SUCCESS, 0)
            for _ in range(MERGE_ATTEMPTS):
                before = self._parts(name, self._seen())
                if any(f"/{field_name}=" not in part for part in before):
                    raise ValueError(f"table {name} is not kept in {buckets} buckets")
                stale = [part for part in before if part.rpartition("/")[2] in touched]
                old = self.spark.createDataFrame([], rows.schema)
                if stale:
                    old = self.spark.read.schema(rows.schema).parquet(*map(self.path, stale))
                folder, seen = f"{name}{_VERSION}{uuid.uuid4().hex}", Observation(f"merge-{uuid.uuid4().hex}")
                # a bucket goes to one task, or to several if it is large
                merged = combine(old, rows).withColumn(field_name, bucket).hint("rebalance", F.col(field_name))
                counted = merged.observe(seen, F.count(F.lit(1)).alias("rows"))
                counted.write.options(**WRITE_OPTIONS).partitionBy(field_name).parquet(self.path(folder))
                fresh = [f"{folder}/{part}" for part in folders_in(self.path(folder)) if "=" in part]

                def change(now: Snapshot) -> Snapshot:
                    if self._parts(name, now) != before:
                        raise _Overtaken(f"merge into {name} was overtaken {MERGE_ATTEMPTS} times")
                    kept = [part for part in before if part not in stale]
                    return now.with_tables({name: [*kept, *fresh]})

                try:
                    self._commit(change)
                    return LoadResult(name, SUCCESS, seen.get["rows"])
                except _Overtaken as error:
                    lost = error
            raise lost
        except Exception as error:
            return LoadResult(name, FAILED, 0, str(error))

    def draft(self) -> Draft:
        """A place to build tables that readers see only once all of them are published."""
        return Draft(self.spark, self.root, self._seen())

    def join_small_parts(self, name: str, parts: int = SMALL_PARTS) -> None:
        """Join the small parts of an appended table into one, if there are ``parts`` of them.

        Large parts are not written again. Readers that began on the small ones can finish:
        these stay until they are superseded twice.
        """
        small = {}
        for folder in self._parts(name, self._seen()):
            size = folder_bytes(self.path(folder))
            if size < SMALL_BYTES:
                small[folder] = size
        if len(small) < max(parts, 2):
            return
        joined = f"{name}{_VERSION}{uuid.uuid4().hex}"
        rows = self.spark.read.option("mergeSchema", True).parquet(*map(self.path, small))
        rows.coalesce(1 + sum(small.values()) // SMALL_BYTES).write.options(**WRITE_OPTIONS).mode("error").parquet(self.path(joined))

        def change(now: Snapshot) -> Snapshot:
            here = self._parts(name, now)
            if not small.keys() <= set(here):
                # replaced or joined by someone else meanwhile
                return now
            return now.with_tables({name: [*(folder for folder in here if folder not in small), joined]})

        self._commit(change)

    def remove_superseded(self, *names: str, keep: int = 2) -> None:
        """Delete the folders of tables that none of their newest ``keep`` states names.

        The state before the current one stays by default, for readers that began on it. A
        folder that no commit names may be one that is being written, so it must be a day old.
        """
        states: dict[str, list[list[str]]] = {name: [] for name in names}
        for snapshot in self._log.history():
            for name, found in states.items():
                folders = snapshot.tables.get(name)
                if folders and (not found or folders != found[-1]):
                    found.append(folders)
        there = folders_in(self.root)
        aged = datetime.now(timezone.utc) - LEFTOVER_AGE
        for name, found in states.items():
            kept = {folder for folders in found[:keep] for folder in folders}
            superseded = {folder for folders in found[keep:] for folder in folders}
            for bucket in superseded - kept:
                if "/" in bucket:
                    delete_folder(self.path(bucket))
            kept, superseded = ({folder.partition("/")[0] for folder in some} for some in (kept, superseded))
            for folder in there:
                if folder.startswith(name + _VERSION) and folder not in kept:
                    if folder in superseded or (changed_at(self.path(folder)) or aged) < aged:
                        delete_folder(self.path(folder))
        self._log.forget(COMMITS_KEPT)


@dataclass(frozen=True, eq=False)
class Draft(TableStore):
    """Replacements of tables that only the draft shows, until ``publish`` makes all of them
    count by one commit. Other tables are read as they were when the draft began."""

    base: Snapshot = Snapshot()
    pending: dict[str, list[str]] = field(default_factory=dict)

    def _seen(self) -> Snapshot:
        return self.base.with_tables(self.pending)

    def _commit(self, change: Change) -> None:
        before = self._seen()
        after = change(before).tables
        self.pending.update({name: after[name] for name in after if after[name] != before.tables.get(name)})

    def load(self, name, rows, disposition="append", track=None, batch=None) -> LoadResult:
        if disposition != "truncate":
            raise ValueError("a draft takes replacements only")
        return super().load(name, rows, disposition, track)

    def merge(self, name, rows, keys, combine=None, buckets=64) -> LoadResult:
        raise ValueError("a draft takes replacements only")

    def publish(self) -> None:
        self._log.commit(lambda now: now.with_tables(self.pending) if self.pending else now)
