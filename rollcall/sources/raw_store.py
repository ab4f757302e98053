"""Snapshot files -> immutable raw store.

A snapshot is one file (or one directory of part files) whose name carries the
cut-off date. The raw store is Parquet partitioned by ``snapshot_date`` and is
only ever appended to; a committed date is skipped, so a rerun loads nothing
(idempotent by date, not by file name). A date counts as loaded, and its files
are read, once the commit log names the load that wrote them
(``commit_log``): what an interrupted load left behind is never seen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.names import (canonical_label, has_extension, is_valid_name,
                                      normalise_headers, reader_path, snapshot_date_of)
from rollcall.functions.text import utrim
from rollcall.session import bounded_broadcast, materialize
from rollcall.sources import commit_log, split_csv

# Header and data, reading and writing follow one rule: a cell may be quoted, a
# quote in it is doubled, and a quoted cell may hold separators and line breaks.
CSV_CELLS = {"quote": '"', "escape": '"', "multiLine": True}

# Metadata columns added at ingest and their types; everything
# else in the raw store is text. ``snapshot_date`` is required.
METADATA_TYPES = {
    "snapshot_date": T.DateType(),
    "_source_file": T.StringType(),
    "_ingested_at": T.TimestampType(),
    "_row_number": T.LongType(),
}
REQUIRED = {"snapshot_date"}
META = list(METADATA_TYPES)

# The cell texts pandas' spreadsheet reader treats as missing by
# default (public pandas documentation). Opt-in for ``shape_raw(na_values=…)``;
# by default only an empty cell is missing, so an acronym such as "NA" survives.
PANDAS_NA_VALUES = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                    "nan", "null"]


def raw_schema(cols: list[str]) -> T.StructType:
    """Metadata typed, the rest STRING; ``snapshot_date`` not nullable."""
    return T.StructType([
        T.StructField(c, METADATA_TYPES.get(c, T.StringType()), c not in REQUIRED)
        for c in cols])


def list_snapshots(spark: SparkSession, path: str, pattern: str | None = None,
                   ext: str | None = None, recursive: bool = True, of: list[str] | None = None) -> DataFrame:
    """Candidate snapshot files with their date and validity, in date
    order then name order. Only the path is read (file content is pruned).
    ``file_name`` is the name that carries the date: the file's own name, or
    the directory name for a snapshot stored as part files; ``snapshot`` is the
    path of that file or directory. With ``of`` only these snapshots are listed."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
             .load(path if of is None else [reader_path(p) for p in of]).select("path"))
    out = snapshots_of(only_landed(spark, files, path))
    if ext:
        out = out.where(has_extension("file_name", ext))
    out = out.withColumn("snapshot_date", snapshot_date_of("file_name"))
    valid = is_valid_name("file_name", pattern) if pattern else F.col("snapshot_date").isNotNull()
    return out.withColumn("is_valid", valid & F.col("snapshot_date").isNotNull()) \
        .orderBy(F.col("snapshot_date").asc_nulls_last(), "file_name")


def snapshots_of(files: DataFrame) -> DataFrame:
    """(path, file_name, snapshot) of files: a snapshot written as a directory of part files is named by its directory."""
    out = with_source_name(files, "path", "file_name").select("path", "file_name")
    own = _uri_decode(F.regexp_extract("path", r"([^/]+)$", 1)) == F.col("file_name")
    return out.withColumn("snapshot", F.when(own, F.col("path")).otherwise(F.regexp_replace("path", r"/[^/]+$", "")))


def landed_log(landing_dir: str) -> str:
    """The log of landed snapshots: inside the landing folder, under a name that listings pass over."""
    return f"{landing_dir.rstrip('/')}/_landed"


def only_landed(spark: SparkSession, files: DataFrame, landing_dir: str) -> DataFrame:
    """Without the files of ``land_snapshots`` runs that did not get to the end; other writers' files stay."""
    landed = commit_log.newest(spark, landed_log(landing_dir)).select("folder", "load")
    own = files.withColumn("load", commit_log.file_load("path")) \
        .withColumn("folder", _uri_decode(F.regexp_extract("path", r"/snapshot=([^/]+)/[^/]+$", 1)))
    # one row per landed snapshot; a file of a load counts if its folder's newest entry names the load
    return own.where("load = ''").select("path").unionByName(
        own.where("load != ''").join(landed, ["folder", "load"], "left_semi").select("path"))


def _uri_decode(c: Column) -> Column:
    """``_metadata.file_path`` is a URI; decode it without turning ``+`` into
    a space."""
    return F.url_decode(F.regexp_replace(c, r"\+", "%2B"))


def with_source_name(df: DataFrame, path_col: str = "_file_path", out: str = "_source_file") -> DataFrame:
    """Add the name that carries the snapshot date: the file name, or for a
    snapshot written as a directory of part files, the directory name.

    Built in separate projections so each regex runs once per row (Catalyst
    does not inline non-cheap aliases that are used more than once).
    """
    p = F.col(path_col)
    df = (df.withColumn("_fname", _uri_decode(F.regexp_extract(p, r"([^/]+)$", 1)))
            .withColumn("_dname", _uri_decode(F.regexp_replace(
                F.regexp_extract(p, r"([^/]+)/[^/]+$", 1), r"^[^=]*=", ""))))
    df = (df.withColumn("_fdate", snapshot_date_of("_fname"))
            .withColumn(out, F.when(F.col("_fdate").isNotNull() | snapshot_date_of("_dname").isNull(),
                                    F.col("_fname")).otherwise(F.col("_dname"))))
    return df.drop("_fname", "_dname", "_fdate")


def _with_file_meta(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mid"))


def landed_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the snapshot files under a landing folder: what a landing left half done is not among them."""
    return sorted(reader_path(r["path"]) for r in list_snapshots(spark, folder).select("path").collect())


def read_snapshots(spark: SparkSession, paths, fmt: str = "csv", sep: str = ",",
                   null_value: str = "") -> DataFrame:
    """S3: read snapshot files with every column as text, no inference.

    CSV is positional in Spark, so each row is parsed by its own file's (normalised)
    header, into the columns of all headers (extra columns are kept,
    absent ones are NULL). Only the headers - one per file, the same
    order of size as the file index Spark keeps on the driver for any file
    read - reach the driver; no data row does. Cells come back as typed, with
    quotes, separators and line breaks, in the header too; a row of another width
    than its header fails the read. A large file is read by many tasks
    (``split_csv``). Adds ``_file_path``, ``_row_number`` (I11), and the per-file
    ``_source_file`` / ``_snapshot_date``. ``paths`` is a landing folder, or a list of
    files, which are read as they are.
    """
    files = landed_files(spark, paths) if isinstance(paths, str) else sorted(paths)
    if not files:
        raise ValueError("no snapshot files found")
    if fmt != "csv":
        df = spark.read.format(fmt).load(files)
        df = df.toDF(*normalise_headers(df.columns))
        df = df.select([F.col(c).cast("string").alias(c) for c in df.columns])
        # inputFiles() writes local files as file:///…, _metadata as file:/…
        read = [re.sub(r"^file:///", "file:/", f) for f in df.inputFiles()]
        return _attach_source(spark, _with_file_meta(df), read)
    out, per_file = split_csv.read_csv(spark, files, sep, CSV_CELLS["quote"], null_value, normalise_headers)
    if out is None:
        raise ValueError("no snapshot files found")
    # one row a file: the rows of a snapshot's earlier part files come first
    earlier = Window.partitionBy("_source_file").orderBy("_file_path").rowsBetween(Window.unboundedPreceding, -1)
    meta = with_source_name(per_file).withColumn("_snapshot_date", snapshot_date_of("_source_file")) \
        .withColumn("_before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    meta = materialize(meta.drop("rows"), "file-metadata")
    return out.join(meta, "_file_path").withColumn("_row_number", F.col("_before") + F.col("_record")) \
        .drop("_before", "_record")


def _attach_source(spark: SparkSession, df: DataFrame, files: list[str]) -> DataFrame:
    """Source name and snapshot date computed once per file (a table of one
    row per listed file, broadcast) instead of once per row."""
    meta = with_source_name(spark.createDataFrame([(f,) for f in files], "_file_path string"))
    meta = meta.withColumn("_snapshot_date", snapshot_date_of("_source_file"))
    return df.join(bounded_broadcast(meta, what="file metadata"), "_file_path", "left")


def row_numbers(df: DataFrame) -> DataFrame:
    """I11 for formats other than CSV (whose reader numbers rows by position):
    ``_row_number`` 1..n per snapshot in file order, part files by name.

    Within one split the ids of ``monotonically_increasing_id`` follow the file
    order, and scans of the same files cut them alike; so a first scan counts
    the rows of each split and a second one adds the split's offset, a running
    sum in block order over one row per split. No task holds more than one
    split, and no row is copied in between.
    """
    source = F.first("_source_file") if "_source_file" in df.columns else F.col("_file_path")
    splits = df.groupBy("_file_path", "_block").agg(
        source.alias("_of"), F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("_of").orderBy("_file_path", "_block") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    offsets = materialize(offsets.select("_file_path", "_block", "_first", "_offset"), "split-offsets")
    return (df.join(offsets, ["_file_path", "_block"])
            .withColumn("_row_number",
                        (F.col("_offset") + F.col("_mid") - F.col("_first") + 1).cast("bigint"))
            .drop("_first", "_offset"))


def shape_raw(df: DataFrame, number_rows: bool = True,
              na_values: list[str] | None = None) -> DataFrame:
    """Every data column -> text, NULL -> '', Unicode trim; add
    ``snapshot_date`` (from the source name), ``_source_file``, ``_ingested_at``
    (UTC) and ``_row_number``. Rows without a date in their name are dropped.
    ``na_values`` (e.g. ``PANDAS_NA_VALUES``) lists cell texts read as missing."""
    data_cols = [c for c in df.columns if not c.startswith("_") and c not in METADATA_TYPES]
    if number_rows and "_row_number" not in df.columns:
        df = row_numbers(df)
    if "_source_file" not in df.columns:
        df = with_source_name(df)
    if "_snapshot_date" not in df.columns:
        df = df.withColumn("_snapshot_date", snapshot_date_of("_source_file"))
    def cell(c):
        v = F.col(c).cast("string")
        if na_values:
            v = F.when(v.isin(list(na_values)), F.lit(None)).otherwise(v)
        return utrim(F.coalesce(v, F.lit(""))).alias(c)
    shaped = df.select(
        *[cell(c) for c in data_cols],
        F.col("_snapshot_date").alias("snapshot_date"),
        F.col("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
        *([F.col("_row_number")] if number_rows else []))
    return shaped.where(F.col("snapshot_date").isNotNull())


def shape_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """I5-I7 on the given columns: text, NULL -> '', Unicode trim."""
    want = set(cols)
    return df.select(*[utrim(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c)
                       if c in want else F.col(c) for c in df.columns])


def select_known(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep the known columns in order; absent ones become NULL text."""
    have = set(df.columns)
    return df.select([F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in cols])


def committed_path(path: str) -> str:
    """The store's commit log: inside the store, under a name its readers pass over."""
    return f"{path.rstrip('/')}/_committed"


def loaded_dates(spark: SparkSession, path: str) -> DataFrame:
    """Dates committed to the raw store; empty when the store is missing.
    Reads the commit log, and no data."""
    log = commit_log.entries(spark, committed_path(path))
    return log.select(F.to_date("folder").alias("snapshot_date")).distinct()


def loaded_dates_of(raw: DataFrame) -> DataFrame:
    """S7 for a DataFrame already in hand."""
    return raw.select("snapshot_date").distinct()


def load_new(incoming: DataFrame, loaded: DataFrame, date_col: str = "snapshot_date") -> DataFrame:
    """Only snapshots whose date is not loaded yet."""
    return incoming.join(loaded.select(F.col("snapshot_date").alias(date_col)).distinct(),
                         date_col, "left_anti")


def conform(df: DataFrame) -> DataFrame:
    """The columns with their types in the store (``raw_schema``), enforced where rows are
    written: a cell that has no such type, or a required value that is missing, fails the load."""
    def cell(field: T.StructField):
        value = F.col(f"`{field.name}`").cast(field.dataType)
        if not field.nullable:
            value = F.when(value.isNull(), F.raise_error(F.lit(f"{field.name} is required"))).otherwise(value)
        return value.alias(field.name)

    return df.select(*[cell(f) for f in raw_schema(df.columns)])


def write_raw(df: DataFrame, path: str, cluster_by: str | None = "region_name") -> int:
    """Add whole dates to the date-partitioned raw store, rows clustered by region
    name inside each date (Parquet min/max skipping). The files of a load count once
    its entry is in the commit log, written after them: readers see a date whole
    or not at all, and a repeated or replacing load takes the place of the earlier one
    in that step. Range partitioning spreads
    a large date over many writer tasks instead of one. Returns the number of
    rows written (observed during the write, no second pass)."""
    spark, df = df.sparkSession, conform(df)
    columns = T.StructType([f for f in df.schema if f.name != "snapshot_date"])
    log = committed_path(path)
    # Added columns only; a column that changes its type is refused before anything is written
    commit_log.merged([*commit_log.newest(spark, log).collect(),
                       {"version": 1 << 62, "load": "", "columns": columns.json()}])
    keys = ["snapshot_date"] + ([cluster_by] if cluster_by and cluster_by in df.columns else [])
    # the row hash as last range key spreads one hot (date, region) over many
    # writer tasks; it is deterministic, so a retried task writes the same rows
    spread = F.xxhash64(*[F.col(c) for c in df.columns]).alias("_spread")
    # The written row count is a metric of the write job itself
    seen, load = Observation("raw_load"), commit_log.load_name()
    # (observed after the range exchange: the bounds-sampling job must not count)
    (df.repartitionByRange(*keys, spread).sortWithinPartitions(*keys)
     .observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set("snapshot_date").alias("dates"))
     .write.mode("append").option(commit_log.BASENAME, load).partitionBy("snapshot_date").parquet(path))
    dates = [str(d) for d in seen.get.get("dates") or []]      # one a snapshot
    commit_log.commit(spark, log, load, dates, columns)
    return int(seen.get.get("rows", 0))


def append_new(spark: SparkSession, incoming: DataFrame, path: str, **kw) -> int:
    """I1+I2+S4: write only dates not in the store yet; returns the number of
    rows written (0 on a rerun)."""
    new = load_new(incoming, loaded_dates(spark, path))
    return write_raw(new, path, **kw)


def replace_snapshot(df: DataFrame, path: str, **kw) -> int:
    """Write the given dates anew: the new load's entry takes their place, the manual
    "drop the partition, load again" step as one call."""
    return write_raw(df, path, **kw)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The raw store as the commit log has it, with additive schema evolution.

    Of each committed date the files of its newest load are read, nothing else
    that lies in the store. The columns are those of all these loads together, from
    the log: no footer is opened to plan, and a column that a date lacks is NULL.
    A store without a commit is empty.
    """
    found = commit_log.newest(spark, committed_path(path)).collect()       # one row a date
    columns = commit_log.merged(found, partition=("snapshot_date",))
    schema = T.StructType([*columns, T.StructField("snapshot_date", T.DateType())])
    if not found:
        return spark.createDataFrame([], schema)
    root = path.rstrip("/")
    files = [f"{root}/snapshot_date={r['folder']}/{r['load']}-*" for r in found]
    return spark.read.schema(schema).option("basePath", root).parquet(*files)


def ensure_store(spark: SparkSession, name: str) -> None:
    """Create the target namespace if missing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


class SeedError(ValueError):
    """A seed has rows that can't be used as they are."""


def check_seed(rows: DataFrame, keys: list[str] | None = None, nullable: set[str] = frozenset()) -> DataFrame:
    """Rows of ``read_seed(..., checked=False)`` with ``_reason``: why a row can't be used, NULL where it can.

    ``malformed``: more or fewer cells than columns, or a cell that has not its
    column's type. ``key missing``: a key column, other than the ``nullable`` ones, is empty.
    ``key doubled``: several different rows have one key; with ``keys`` the same row
    written twice counts once.
    """
    cols = [c for c in rows.columns if c != "_line"]
    bad = F.col("_line").isNotNull()
    missing = F.lit(False)
    for c in keys or []:
        if c not in nullable:
            missing = missing | F.col(c).isNull()
    out, n = rows, F.lit(0)
    if keys:
        once = rows.where(~bad).select(*cols).distinct().withColumn("_line", F.lit(None).cast("string"))
        out = rows.where(bad).unionByName(once)
        n = F.count(F.when(~bad & ~missing, 1)).over(Window.partitionBy(*keys, bad))
    return out.withColumn("_reason", F.when(bad, F.lit("malformed")).when(missing, F.lit("key missing"))
                          .when(n > 1, F.lit("key doubled")))


def read_seed(spark: SparkSession, path: str, schema: T.StructType | str, keys: list[str] | None = None,
              nullable: set[str] = frozenset(), quarantine: str | None = None) -> DataFrame:
    """Seed CSV with declared types; an empty cell is NULL; declared text
    keeps leading zeros.

    Every row must have as many cells as columns, of their types, and with
    ``keys`` be the only one of its key (``check_seed``): joins with the seed
    then neither lose a correction nor double a row. Otherwise reading fails with
    the first bad rows, or, with ``quarantine``, they are appended to the table
    there, with their reason, and the others are returned.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    flagged = T.StructType([*declared.fields, T.StructField("_line", T.StringType())])
    rows = spark.read.schema(flagged).option("header", True).option("nullValue", "").option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", "_line").options(**CSV_CELLS).csv(path)
    checked = materialize(check_seed(rows, keys, nullable), "seed")      # a seed is read by several joins anyway
    bad = checked.where("_reason IS NOT NULL")
    if quarantine:
        bad.withColumn("_seed", F.lit(path)).withColumn("_read_at", F.current_timestamp()) \
            .write.mode("append").option("mergeSchema", "true").parquet(quarantine)
    elif first := bad.limit(5).collect():
        raise SeedError(f"{path}: " + "; ".join(f"{r['_reason']}: {r['_line'] or tuple(r)[:-2]}" for r in first))
    return checked.where("_reason IS NULL").select(*declared.fieldNames())


def materialise(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> DataFrame:
    """A layer as a temp view (lazy) or as a written table (lineage cut)."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    target = path or name
    df.write.mode("overwrite").parquet(target)
    out = df.sparkSession.read.parquet(target)
    out.createOrReplaceTempView(name)
    return out


def land_snapshots(df: DataFrame, landing_dir: str, prefix: str, suffix: str = ".csv",
                   data_cols: list[str] | None = None, order_by: list[str] | None = None) -> None:
    """Store each snapshot under a standard name derived from its date.

    One directory per snapshot named ``<prefix>DD_MM_YYYY<suffix>`` holding CSV
    part files with a header; the name alone carries the date. Snapshots count as
    landed once the log of landed snapshots names the run that wrote them, after
    all of their files: a run that breaks off leaves nothing that listings show,
    and its snapshots are written whole by the next. A landed one is not written
    again. With ``order_by`` the rows of a snapshot lie in that order over its part files.
    """
    spark = df.sparkSession
    cols = data_cols or [c for c in df.columns if c not in META]
    label = canonical_label("snapshot_date", prefix, suffix)
    rows = df.select(*cols, label.alias("snapshot"))
    log, load = landed_log(landing_dir), commit_log.load_name()
    landed = commit_log.entries(spark, log).select(F.col("folder").alias("snapshot")).distinct()
    rows = rows.join(landed, "snapshot", "left_anti").select(*cols, "snapshot")
    if order_by:
        # neighbouring ranges go to neighbouring part files, so a large date is still written by many tasks
        rows = rows.repartitionByRange("snapshot", *order_by).sortWithinPartitions("snapshot", *order_by)
    seen = Observation("landed")
    (rows.observe(seen, F.collect_set("snapshot").alias("names"))
     .write.mode("append").option("header", True).options(**CSV_CELLS)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option(commit_log.BASENAME, load).partitionBy("snapshot").csv(landing_dir))
    commit_log.commit(spark, log, load, seen.get.get("names") or [])         # one a snapshot
