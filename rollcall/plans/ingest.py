"""Ingest planning (I1-I3): which snapshot files load, which are skipped."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.names import has_extension, snapshot_date_of
from rollcall.sources import commit_log
from rollcall.sources import raw_store as R

LOAD, SKIP, IGNORED = "LOAD", "SKIP", "IGNORED"


def plan_ingest(files: DataFrame, loaded: DataFrame, ext: str | None = ".csv",
                name_col: str = "file_name") -> DataFrame:
    """Label every listed file LOAD, SKIP or IGNORED.

    IGNORED: wrong extension or no parseable date in the name. SKIP: the date
    is loaded already, or another file with the same date sorts first by name
    (first file wins; of equal names the first ``snapshot`` path, where the files
    come with one). LOAD otherwise. Returns ``file_name, snapshot_date,
    status``. The first file of each date comes from an aggregate (partial
    ``min`` per date, one row per date), so neither a date with very many files
    nor the mass of undated files ever lands in a single task.
    """
    keys = ["file_name"] + ["snapshot"] * ("snapshot" in files.columns)
    f = files.select(F.col(name_col).alias("file_name"), *keys[1:]) \
        .withColumn("snapshot_date", snapshot_date_of("file_name"))
    ok = F.col("snapshot_date").isNotNull()
    if ext:
        ok = ok & has_extension("file_name", ext)
    f = f.withColumn("_ok", ok)
    done = loaded.select("snapshot_date").distinct().withColumn("_loaded", F.lit(True))
    first = (f.where("_ok").groupBy("snapshot_date")
             .agg(F.min(F.struct(*keys)).alias("_first")))
    f = f.join(done, "snapshot_date", "left").join(first, "snapshot_date", "left")
    status = (F.when(~F.col("_ok"), F.lit(IGNORED))
              .when(F.col("_loaded").isNotNull(), F.lit(SKIP))
              .when(F.struct(*keys) != F.col("_first"), F.lit(SKIP))
              .otherwise(F.lit(LOAD)))
    return f.select(*keys, "snapshot_date", status.alias("status"))


def run_counters(plan: DataFrame) -> DataFrame:
    """How many files load / skip / are ignored."""
    return plan.groupBy("status").agg(F.count(F.lit(1)).alias("files"))


@dataclass
class Loaded:
    plan: dict = field(default_factory=dict)
    rows: int = 0


def load_landing(spark: SparkSession, landing: str, store: str, ext: str = ".csv", fmt: str | None = None,
                 cluster_by: str | None = "region_name", arrived: DataFrame | None = None) -> Loaded:
    """The one way from a landing folder to the raw store: command line, close and stream.

    Plans on whole snapshots (a file, or a folder of part files), reads only
    the LOAD ones, numbers and shapes their rows and commits each date whole.
    Only paths reach the driver, one row a file.

    With ``arrived`` (path) the plan is made on the snapshots of these files alone, and on
    those that were not landed to the end when their files arrived, which a log in
    the store names: the landing folder is not listed, so the work doesn't grow with what
    landed before. Of several files of one date the first to arrive wins then.
    """
    of = _arrived(spark, store, arrived) if arrived is not None else None
    if of == []:
        return Loaded()
    files = R.list_snapshots(spark, landing, of=of).select("path", "file_name", "snapshot")
    plan = plan_ingest(files.select("file_name", "snapshot").distinct(), R.loaded_dates(spark, store), ext=ext)
    plan = spark.createDataFrame(plan.collect(), plan.schema)      # one row a snapshot: fixed before anything is written
    out = Loaded({r["status"]: r["files"] for r in run_counters(plan).collect()})
    to_load = files.join(plan.where(F.col("status") == LOAD).select("snapshot"), "snapshot").select("path")
    paths = sorted(R.reader_path(r["path"]) for r in to_load.collect())
    if paths:
        rows = R.read_snapshots(spark, paths, fmt or ext.lstrip(".").lower() or "csv")
        out.rows = R.append_new(spark, R.shape_raw(rows), store, cluster_by=cluster_by)
    if of is not None:
        landed = {r["snapshot"] for r in plan.select("snapshot").collect()}
        commit_log.commit(spark, _waiting_log(store), WAITING, [s for s in of if s not in landed])
        commit_log.commit(spark, _waiting_log(store), PLANNED, [s for s in of if s in landed])
    return out


WAITING, PLANNED = "waiting", "planned"


def _waiting_log(store: str) -> str:
    """The log of snapshots whose files have arrived: planned, or waiting to be landed to the end."""
    return f"{store.rstrip('/')}/_arrived"


def _arrived(spark: SparkSession, store: str, files: DataFrame) -> list[str]:
    """The snapshots of files that arrived, and those that are waiting."""
    waiting = commit_log.newest(spark, _waiting_log(store)).where(F.col("load") == WAITING).select(F.col("folder").alias("snapshot"))
    names = R.snapshots_of(files.select("path")).select("snapshot").unionByName(waiting).distinct()
    return sorted(r["snapshot"] for r in names.collect())            # of one batch of files
