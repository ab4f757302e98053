"""The log of committed loads that readers of a store follow.

A load gives its files a name of its own (``load_name``) and appends them to the
folders they belong to. What makes them count is one small Parquet file added
to the store's log afterwards: an entry for each folder the load wrote, with the
load's name, a version and the columns it wrote. Readers take a folder's files
from its newest entry alone, so

* a folder without an entry, or files of a load that was interrupted, are not seen;
* a repeated or replacing load supersedes the earlier one in one step;
* the columns of the whole store come from the log, and no footer is opened.

Adding one file is the only step that must be atomic; no folder is renamed or
emptied, so the same holds on object stores. The log has an entry for each
folder and load - metadata, as many as the snapshots - and is what reaches the
driver; files are listed by Spark, data is not touched.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRY = "folder string, load string, version long, columns string"
# a writer option of Hadoop's output formats: the first part of the file names
BASENAME = "mapreduce.output.basename"
_LOAD = re.compile(r"load[0-9a-f]{16}")


def load_name() -> str:
    """A name that no other load has."""
    return f"load{uuid.uuid4().hex[:16]}"


def _missing(error: Exception) -> bool:
    return any(s in str(error) for s in ("PATH_NOT_FOUND", "does not exist", "UNABLE_TO_INFER_SCHEMA"))


def entries(spark: SparkSession, log: str) -> DataFrame:
    """All entries of a log; none where there is no log yet."""
    try:
        return spark.read.schema(ENTRY).parquet(log)
    except Exception as e:  # noqa: BLE001 - a missing log is an empty one
        if _missing(e):
            return spark.createDataFrame([], ENTRY)
        raise


def newest(spark: SparkSession, log: str) -> DataFrame:
    """The entry that counts of each folder: the one of the highest version."""
    best = F.max_by(F.struct("load", "version", "columns"), F.struct("version", "load"))
    return entries(spark, log).groupBy("folder").agg(best.alias("e")).select("folder", "e.*")


def commit(spark: SparkSession, log: str, load: str, folders: list[str], columns: T.StructType | None = None) -> None:
    """Make the files of ``load`` in ``folders`` the ones that count there: one file added to the log."""
    if not folders:
        return
    version = (entries(spark, log).agg(F.max("version")).first()[0] or 0) + 1
    held = columns.json() if columns is not None else None
    rows = [(f, load, version, held) for f in sorted(folders)]
    spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("append").parquet(log)


def merged(found: list, partition: tuple[str, ...] = ()) -> T.StructType:
    """Columns of the entries (oldest first), added up by name; a column keeps its type."""
    out: dict[str, T.StructField] = {}
    for row in sorted(found, key=lambda r: (r["version"], r["load"])):
        for field in T.StructType.fromJson(json.loads(row["columns"])) if row["columns"] else ():
            known = out.setdefault(field.name, T.StructField(field.name, field.dataType, True))
            if known.dataType != field.dataType:
                raise ValueError(f"column {field.name} is {known.dataType.simpleString()} in the store, "
                                 f"{field.dataType.simpleString()} in a load")
    return T.StructType([f for f in out.values() if f.name not in partition])


def file_load(path):
    """The load that a file belongs to by its name (Column over a path); empty for files of other writers."""
    return F.regexp_extract(path, rf"/({_LOAD.pattern})-[^/]*$", 1)
