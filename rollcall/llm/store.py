"""Shared helpers of the operators: the shared folder, written tables, cogroups, code shipping."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps


ARROW_ROWS = 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    master may go without: then a temporary folder is made and set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="rollcall-llm-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    The table cuts the lineage: a lost executor rereads it and replays nothing.
    It gets no success marker, as it is read only after its write has ended: in a local
    folder each marker starts two more processes from the driver.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context.

    Workers import the operators by name, so their tables and caches live as
    long as a worker does, wherever the driver was started from. Texts can be
    long, so batches to the workers are kept at ARROW_ROWS rows where the
    session leaves Spark's default.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_rollcall_llm_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(here)
    target = os.path.join(tempfile.mkdtemp(prefix="rollcall-code-"), "rollcall_llm_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        z.write(os.path.join(top, "__init__.py"), "rollcall/__init__.py")
        for name in sorted(os.listdir(here)):
            if name.endswith(".py"):
                z.write(os.path.join(here, name), f"rollcall/llm/{name}")
    sc.addPyFile(target)
    sc._rollcall_llm_shipped = True


def release() -> None:
    """Give free memory of this process back to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def releasing(run):
    """``run`` for ``mapInArrow``, after whose last batch free memory goes back: workers live on and serve other stages."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()
    return whole


def parts_for(total: int, per_part: int) -> int:
    """How many parts of about ``per_part`` units hold ``total`` units."""
    return max(1, -(-int(total or 0) // per_part))


def cogrouped(left: DataFrame, right: DataFrame, *by: str) -> PandasCogroupedOps:
    """Both sides grouped by the columns ``by`` of either, whole numbers.

    Spark hashes an int and a long of the same value apart and casts no keys of
    a cogroup, so a group's two sides would go to different tasks: all are long.
    """
    sides = (df.withColumns({c: F.col(c).cast("long") for c in by}).groupBy(*by) for df in (left, right))
    return next(sides).cogroup(next(sides))


def pick(df: DataFrame, *cols: str) -> DataFrame:
    """The named columns only, so that extra columns never reach an operator."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
