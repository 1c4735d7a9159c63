"""Spark session settings and the shared folder of a run."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# All of these can be changed on a running session. Shuffle partition numbers
# and file split sizes belong to the cluster and are left alone.
RUNTIME_SETTINGS = {
    # every timestamp is a UTC instant; local dates name their zone
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # money keeps its nine decimals; a sum that does not fit is an error
    "spark.sql.decimalOperations.allowPrecisionLoss": "false",
    # measured sizes decide on broadcast joins, partition numbers and skew
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even when a later step must then shuffle again
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_roots: dict[str, str] = {}
_scratch: dict[str, list[str]] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the models rely on to a session made elsewhere. They stay in force
    for all its later queries: decimals, zone, ANSI errors and the splitting of skewed joins."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    master: str = "local[*]", app: str = "stockflow", extra: dict[str, str] | None = None
) -> SparkSession:
    """A session for tests, benchmarks and single machines."""
    builder = SparkSession.builder.master(master).appName(app)
    start = {
        "spark.ui.enabled": "false",
        # recording the place of every Column call slows building a plan down
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**start, **RUNTIME_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def use_shared_root(spark: SparkSession, path: str) -> None:
    """Name the shared folder of a session that has no ``spark.checkpoint.dir``: for tests
    and single machines."""
    _roots[spark.sparkContext.applicationId] = path.rstrip("/")


def has_shared_root(spark: SparkSession) -> bool:
    return bool(spark.conf.get("spark.checkpoint.dir", None)) or spark.sparkContext.applicationId in _roots


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, where intermediate tables are written: the one
    the session names in ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None) or _roots.get(spark.sparkContext.applicationId)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path for one intermediate table."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_paths(spark: SparkSession, label: str) -> list[str]:
    """The paths with a label that this session was given so far."""
    return [path for path in _scratch.get(spark.sparkContext.applicationId, []) if f"/{label}-" in path]
