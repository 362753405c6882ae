"""Session factory (C1) and the shared work folder used for staged writes.

On a cluster the session is created by the launcher; ``get_spark_session``
only fills in settings that are not set yet, so a cluster's own
configuration always wins.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Defaults for a session this module creates itself.  AQE re-plans shuffles at
# runtime: it coalesces small shuffle partitions towards the advisory size,
# splits skewed join partitions and skewed REBALANCE partitions, so the static
# ``spark.sql.shuffle.partitions`` is an upper bound rather than a guess.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_spark_session(app_name: str = "cardrisk", master: str | None = None,
                      shuffle_partitions: int | None = None,
                      extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build one with the defaults above.

    ``master`` is only applied when no session exists (local runs and tests).
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    given = dict(extra or {})
    if shuffle_partitions:
        given["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master:
        given.setdefault("spark.ui.enabled", "false")
    for key, value in given.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    launched = spark.sparkContext.getConf()
    for key, value in SESSION_DEFAULTS.items():
        if key not in given and not launched.contains(key):
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 150 * 1024 * 1024,
                           minimum: int = 1) -> int:
    """Size-based shuffle partition count (input size / target size).

    With AQE on, use the result as the initial partition count; AQE then
    coalesces towards ``advisoryPartitionSizeInBytes``.
    """
    return max(minimum, -(-int(input_bytes) // int(target_bytes)))


def input_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan: for scans the size of the files it reads."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _given_by_launcher(spark: SparkSession, key: str) -> bool:
    return spark.sparkContext.getConf().contains(key)


@contextmanager
def sized_shuffles(spark: SparkSession, *inputs: DataFrame) -> Iterator[int]:
    """The shuffle partitions of the jobs inside follow the size of their inputs.

    Yields the count in force.  A count that the cluster set at launch is left as it is, and
    the default is never lowered, since AQE coalesces small partitions: 200 partitions are
    too few for an input of over 30 GB, never too many with AQE.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if _given_by_launcher(spark, key):
        yield int(before)
        return
    # an estimate of a join's product can be absurd: the inputs' own sizes are added up instead
    wanted = max(int(before), shuffle_partitions_for(sum(input_bytes(df) for df in inputs)))
    spark.conf.set(key, str(wanted))
    try:
        yield wanted
    finally:
        spark.conf.set(key, before)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset and the master is local
    (local runs, tests) a private folder under the system temp dir is registered.
    """
    configured = None
    try:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001 - key unknown to this session
        configured = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext on a remote (Connect) session
        sc = None
    if sc is None:
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must be set on a remote session")
        return configured.rstrip("/")
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="cardrisk-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique directory path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this module's own, wherever Spark's file systems keep it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def has_path(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, wherever Spark's file systems keep it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
