"""Session defaults and small plan helpers shared by every module.

Nothing here touches data rows on the driver: the helpers return Column
expressions or DataFrames, or read session configuration.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings that matter for every job in this library. AQE re-plans joins at
# runtime from real shuffle sizes (sort-merge -> broadcast when a side turns out
# small, skewed partitions split), which is the size check behind every join
# whose sides grow with the data.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.mergeSchema": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "rollcall",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster ``master`` stays None so spark-submit decides. Tests pass
    ``local[*]`` and a small shuffle partition count.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; only when nobody set it
    (a local test run) a fresh folder is created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception as e:  # noqa: BLE001 - no SparkContext handle (Spark Connect)
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share") from e
        return named
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="rollcall-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a Parquet table under the shared checkpoint folder
    and return the table read back.

    Used where one intermediate result feeds several branches (a self-join, a
    two-level aggregate, several marts or checks): column pruning makes those
    branches differ, so Spark cannot reuse one exchange and would recompute the
    whole upstream chain per branch. The written table also cuts the lineage,
    so a lost executor does not replay the chain.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def small_table(df: DataFrame, name: str = "small", max_rows: int = 100_000) -> DataFrame:
    """Pin a result that is bounded by metadata (e.g. the snapshot calendar, one
    row per loaded snapshot) as driver-held data: computed once, no write, and
    AQE broadcasts it at runtime. The bound is checked: beyond ``max_rows`` it
    is written as a table (``materialize``) instead, so nothing unbounded
    passes through the driver (a broadcast would collect it there anyway).
    The result carries the broadcast hint."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) <= max_rows:
        # bounded by the check above, so every join may broadcast it
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
    return materialize(df, name)


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan (no job is run); None if unknown."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # noqa: BLE001 - estimate unavailable (e.g. Spark Connect)
        return None


UNKNOWN_SIZE = (1 << 63) - 1     # Catalyst's default size for plans it cannot estimate


def bounded_broadcast(df: DataFrame, max_bytes: int = 64 << 20, what: str = "",
                      max_rows: int = 1_000_000, count_check: bool = False) -> DataFrame:
    """Broadcast hint for a side whose size is checked, not assumed.

    Used for seed / lookup tables the user hands in (leaves of the plan). The
    check is the optimizer's size estimate (file sizes for scans, the same
    statistic ``autoBroadcastJoinThreshold`` uses) when it has one; when it has
    none (rows created in memory), the rows are counted up to ``max_rows`` -
    cheap for a seed. ``count_check=True`` always counts: for small results of
    an aggregate, whose estimate Catalyst inherits from the (large) input.
    Beyond either bound no hint is given and the planner keeps a shuffle join
    (AQE may still convert it once the real size is known).
    """
    n = None if count_check else estimated_bytes(df)
    if n is not None and n < UNKNOWN_SIZE:
        return F.broadcast(df) if n <= max_bytes else df
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def local_path(p: str) -> str:
    """Strip a ``file:`` scheme for code that must use the local file system."""
    return p[5:] if p.startswith("file:") else p


__all__ = [
    "DEFAULT_CONF", "get_session", "ensure_checkpoint_dir", "scratch_path",
    "bounded_broadcast", "local_path", "materialize", "small_table", "estimated_bytes",
]
