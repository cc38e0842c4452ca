"""Spark session settings and lineage cutting.

Everything in the library is a lazy DataFrame plan; this module only
holds the session defaults the plans are tuned for and the one helper
that materialises an intermediate result in the cluster's shared
checkpoint folder.
"""

from __future__ import annotations

import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings every plan in the package assumes: adaptive execution (runtime
# coalescing, broadcast conversion of small build sides, skew-join splits)
# and a UTC session clock.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "kinrank", driver_memory: str = "16g",
                  extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster, pass the cluster's
    own builder settings through ``extra`` and leave ``master`` to spark-submit."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def named_folder(spark: SparkSession) -> str | None:
    """The shared folder that the session names for checkpoints, if any."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", "") or None
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder:
            sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or None


def _must_be_local(spark: SparkSession) -> None:
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                           "(a machine-local folder cannot hold checkpoints)")


_scratch: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """A folder for tables that an operator writes and reads again: the one
    that the session names. Only a local session that names none gets a
    scratch folder (one for each application); a cluster session is refused."""
    folder = named_folder(spark)
    if folder:
        return folder
    _must_be_local(spark)
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        _scratch[app] = tempfile.mkdtemp(prefix="kinrank-")
    return _scratch[app]


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files that nothing refers to any more. It does
    so once the driver's objects are collected, which on an idle heap may be
    long after: a query's steps would then be on disk all together."""
    try:
        spark.sparkContext._jvm.System.gc()
    except Exception:  # noqa: BLE001 - a remote (Connect) session: the server sees to it
        pass


def materialize(df: DataFrame) -> DataFrame:
    """Keep one intermediate result that several branches read.

    Where the session names a shared folder this is a reliable checkpoint,
    which survives the loss of the executors that computed it. A local session
    without one keeps the rows in Spark's own storage and writes no files of
    ours; a cluster session without one is refused.
    """
    spark = df.sparkSession
    if named_folder(spark):
        kept = df.checkpoint(eager=True)
        release(spark)
        return kept
    _must_be_local(spark)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def parallelism(spark: SparkSession) -> int:
    """Least partition count for joins whose output is much larger than their
    inputs (pair generation, neighbour expansion): the session's shuffle
    partitions. Above it, ``skew.output_partitions`` sizes such a join by its
    measured joined-row count. Adaptive execution sizes ordinary shuffles by
    their input and would run such a join in a few tasks, so the count is
    explicit. It cannot go lower either: when both sides of a join are
    shuffles, Spark's planner re-plans them to at least this many partitions."""
    try:
        return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    except (TypeError, ValueError):
        return 200
