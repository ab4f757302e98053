"""Quoted CSV read by many tasks a file, with row numbers by position.

A quoted cell may hold line breaks, so where a file is cut for the tasks, the
lines alone don't say whether a record begins there. The number of quotes
before them does: a quote in a cell is doubled, so a line break lies inside a
cell exactly where the count of quotes before it is odd. Two passes:

1. each split counts, from its lines alone, its quotes and the records that end
   in it, for either case of what lies before (``split_facts``). That gives a
   table of one row a split; a running sum over a file's splits tells each one's
   case, and how many records came before it;
2. each split then puts its lines together to records and numbers them
   (``records``). A record across a border is given in pieces, which are few,
   and put together by its number.

Records are parsed by ``from_csv``, each file's by its own header. Numbers come from positions, not from the
order of a run, so a repeated task or another cut gives the same ones; nothing
is copied or checkpointed. The work on lines is done on Arrow columns.

Both passes read the same files, so Spark cuts them alike, and no filter gets
below them. The first pass counts each split's lines and the second compares:
should the cut have changed in between (another setting, another file), the read
fails; it can't lose a record.

Defined cases: lines end with a line feed, before which a carriage return is
dropped outside cells; empty lines between records are none; a file whose quotes
don't pair, and a row of another width than its header, fail the read; a byte
order mark before the header is dropped; an empty file has no header and no rows.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.session import materialize

FACTS = pa.schema([("_file_path", pa.string()), ("_block", pa.int64()), ("lines", pa.int64()), ("odd", pa.int64()),
                   ("even_ends", pa.int64()), ("odd_ends", pa.int64()), ("header", pa.string())])
FACTS_DDL = "_file_path string, _block long, lines long, odd long, even_ends long, odd_ends long, header string"
RECORD = pa.schema([("_file_path", pa.string()), ("record", pa.int64()), ("_block", pa.int64()), ("text", pa.string())])
RECORD_DDL = "_file_path string, record long, _block long, text string"


def lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """The lines of the files with their split and their order in it."""
    return spark.read.option("lineSep", "\n").text(files).select(
        F.col("_metadata.file_path").alias("_file_path"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"), F.col("value"))


def runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """(file, split, its lines) of a batch; lines of a split follow one another."""
    if not batch.num_rows:
        return
    block = batch.column("_block").to_numpy()
    path = batch.column("_file_path").dictionary_encode().indices.to_numpy()
    cuts = np.flatnonzero((block[1:] != block[:-1]) | (path[1:] != path[:-1])) + 1
    for a, z in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.column("_file_path")[a].as_py(), int(block[a]), batch.slice(a, z - a)


def quotes_and_blank(value: pa.Array, quote: str) -> tuple[np.ndarray, np.ndarray]:
    """(quotes up to and with each line, whether the line is empty)."""
    blank = pc.is_in(value, pa.array(["", "\r"]))
    return np.cumsum(pc.count_substring(value, quote).to_numpy()), blank.to_numpy(zero_copy_only=False)


def split_facts(batches: Iterator[pa.RecordBatch], quote: str) -> Iterator[pa.RecordBatch]:
    """One row a split: its lines, parity of its quotes, records that end in it in either case, and the first record of a file."""
    done, now = [], None

    def close():
        if now:
            header = "\n".join(now["head"]) if now["head"] is not None and now["whole"] else None
            done.append((now["file"], now["block"], now["lines"], now["quotes"] % 2, now["ends"][0], now["ends"][1], header))

    for batch in batches:
        for file, block, part in runs(batch):
            if now is None or (now["file"], now["block"]) != (file, block):
                close()
                now = {"file": file, "block": block, "lines": 0, "quotes": 0, "ends": [0, 0],
                       "head": [] if block == 0 else None, "whole": False}
            value = part.column("value")
            now["lines"] += len(value)
            count, blank = quotes_and_blank(value, quote)
            odd = (count + now["quotes"]) % 2
            if now["head"] is not None and not now["whole"]:
                for i in range(len(odd)):
                    if not now["head"] and blank[i]:
                        continue
                    now["head"].append(value[i].as_py())
                    if not odd[i]:
                        now["whole"] = True
                        break
            now["ends"][1] += int((odd[~blank] == 1).sum())
            now["ends"][0] += int((odd[~blank] == 0).sum())
            now["quotes"] += int(count[-1])
    close()
    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*done) if done else [[]] * len(FACTS), FACTS)], schema=FACTS)


def records(batches: Iterator[pa.RecordBatch], quote: str, borders: bool) -> Iterator[pa.RecordBatch]:
    """Records that lie whole in a split; with ``borders`` the pieces of the others instead."""
    now = None

    def closed():
        if now and now["lines"] != now["counted"]:       # None for a split that was not counted
            raise ValueError(f"{now['file']} was cut in another way when its lines were counted")

    def piece():
        return [(now["file"], now["at"], now["block"], "\n".join(now["open"]))] if now and now["open"] else []

    def batch_of(rows):
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(RECORD), RECORD)],
                               schema=RECORD)

    for batch in batches:
        for file, block, part in runs(batch):
            if now is None or (now["file"], now["block"]) != (file, block):
                closed()
                if borders:
                    yield batch_of(piece())
                case = part.column("start")[0].as_py() or 0
                # a record is open at the split's start where the quotes before it are odd
                now = {"file": file, "block": block, "quotes": case, "at": part.column("before")[0].as_py() or 0, "open": [],
                       "foreign": case == 1, "lines": 0, "counted": part.column("lines")[0].as_py()}
            value = part.column("value")
            now["lines"] += len(value)
            count, blank = quotes_and_blank(value, quote)
            odd = (count + now["quotes"]) % 2
            now["quotes"] += int(count[-1])
            if not now["open"] and not now["foreign"] and not odd.any():          # a record a line
                text = value.filter(pa.array(~blank))
                if not borders and len(text):
                    at = now["at"] + np.arange(len(text))
                    yield pa.record_batch([pa.array([file]).take(pa.array(np.zeros(len(text), np.int64))), pa.array(at),
                                           pa.array(np.full(len(text), block)), text], schema=RECORD)
                now["at"] += len(text)
                continue
            whole, pieces = [], []
            for i, line in enumerate(value.to_pylist()):
                if not odd[i] and blank[i] and not now["open"] and not now["foreign"]:
                    continue
                now["open"].append(line)
                if not odd[i]:
                    (pieces if now["foreign"] else whole).extend(piece())
                    now["at"], now["open"], now["foreign"] = now["at"] + 1, [], False
            yield batch_of(pieces if borders else whole)
    closed()
    if borders:
        yield batch_of(piece())


def widened(parsed: Column, names: tuple, columns: list[str]) -> Column:
    """A struct of ``names`` as one of ``columns``, NULL where it lacks one; the row is parsed once."""
    def fields(row: Column) -> Column:
        return F.struct(*[(row[c] if c in names else F.lit(None).cast("string")).alias(c) for c in columns])

    return F.transform(F.array(parsed), fields)[0]


def read_csv(spark: SparkSession, files: list[str], sep: str, quote: str, null_value: str, header_names) -> tuple:
    """(rows, files) of CSV files with headers; rows is None where no file has a header.

    ``rows`` has the columns of all headers as text (NULL where a file lacks one),
    ``_file_path`` and ``_record``: 1 for the first row after the header. ``files``
    has the number of ``rows`` of each file.
    """
    facts = lines(spark, files).select("_file_path", "_block", "value").mapInArrow(
        lambda b: split_facts(b, quote), FACTS_DDL)
    facts = materialize(facts, "csv-splits")                      # one row a split
    before = Window.partitionBy("_file_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = facts.withColumn("start", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2) \
        .withColumn("ended", F.when(F.col("start") == 0, F.col("even_ends")).otherwise(F.col("odd_ends"))) \
        .withColumn("before", F.coalesce(F.sum("ended").over(before), F.lit(0))) \
        .withColumn("crossed", (F.col("start") == 1) | ((F.col("start") + F.col("odd")) % 2 == 1))

    # one row a file: its header, and whether its quotes pair
    per_file = splits.groupBy("_file_path").agg(F.max("header").alias("header"), (F.sum("odd") % 2).alias("odd"),
                                                F.sum("ended").alias("records"), F.max("crossed").alias("crossed"))
    heads, groups = per_file.collect(), {}
    for r in heads:
        if r["odd"] or (r["header"] is None and r["records"]):
            raise ValueError(f"quotes do not pair in {r['_file_path']}")
        if r["header"] is not None:
            text = r["header"].removeprefix("\ufeff").removesuffix("\r")
            names = next(csv.reader(io.StringIO(text, newline=""), delimiter=sep, quotechar=quote), [""])
            groups.setdefault(tuple(header_names(names)), []).append(r["_file_path"])
    counted_rows = per_file.select("_file_path", (F.greatest(F.col("records"), F.lit(1)) - 1).alias("rows"))
    if not groups:
        return None, counted_rows

    numbered = sorted(groups)
    of_file = spark.createDataFrame([(f, i) for i, names in enumerate(numbered) for f in groups[names]],
                                    "_file_path string, header_no int")
    known = materialize(splits.select("_file_path", "_block", "lines", "start", "before", "crossed"), "csv-borders")

    def put_together(borders: bool) -> DataFrame:
        # of the splits whose records all lie in them no piece is missing; a join may deal the
        # lines of a split anew, but keeps them in one task
        at = (known.where("crossed") if borders else known).drop("crossed")
        placed = lines(spark, files).join(at, ["_file_path", "_block"], "inner" if borders else "left") \
            .sortWithinPartitions("_file_path", "_block", "_line").drop("_line")
        return placed.mapInArrow(lambda b: records(b, quote, borders), RECORD_DDL)

    found = put_together(False).drop("_block")
    if any(r["crossed"] for r in heads):
        pieces = put_together(True).groupBy("_file_path", "record").agg(
            F.array_sort(F.collect_list(F.struct("_block", "text"))).alias("pieces"))
        found = found.unionByName(pieces.select("_file_path", "record", F.array_join("pieces.text", "\n").alias("text")))

    # one parse a row, by its file's header, into the columns of all headers
    options = {"sep": sep, "quote": quote, "escape": quote, "multiLine": "true", "nullValue": null_value, "mode": "FAILFAST"}
    columns = list(dict.fromkeys(c for names in numbered for c in names))
    text, row = F.regexp_replace("text", r"\r\z", ""), None
    for i, names in enumerate(numbered):
        ddl = ", ".join(f"`{c}` string" for c in names)
        parsed = F.from_csv(text, ddl, options)
        if list(names) != columns:
            parsed = widened(parsed, names, columns)
        row = F.when(F.col("header_no") == i, parsed) if row is None else row.when(F.col("header_no") == i, parsed)
    # the driver holds these rows already, one a file
    return found.where("record > 0").join(F.broadcast(of_file), "_file_path").select(
        row.alias("row"), "_file_path", F.col("record").alias("_record")).select("row.*", "_file_path", "_record"), counted_rows
