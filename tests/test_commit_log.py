"""Readers follow the commit log: whole loads, whole landings, columns of all loads, types enforced on write."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from rollcall.plans.ingest import load_landing
from rollcall.sources import commit_log as L
from rollcall.sources import raw_store as R

JAN, FEB, MAR = dt.date(2026, 1, 31), dt.date(2026, 2, 28), dt.date(2026, 3, 31)


def rows(spark, names, date, **extra):
    df = spark.createDataFrame([(n, date) for n in names], "entity_name string, snapshot_date date")
    return df.withColumns({c: F.lit(v) for c, v in extra.items()})


def held(spark, store):
    return sorted((str(r.snapshot_date), r.entity_name) for r in R.read_raw(spark, store).collect())


def leave_behind(df, store):
    """What a load leaves that wrote its files and broke off before its commit."""
    df.write.mode("append").option(L.BASENAME, L.load_name()).partitionBy("snapshot_date").parquet(store)


def test_uncommitted_dates_and_files_are_not_read(spark, tmp_dir):
    store = f"{tmp_dir}/s"
    assert held(spark, store) == [] and R.loaded_dates(spark, store).count() == 0
    leave_behind(rows(spark, "xy", JAN), store)                       # before any commit
    assert held(spark, store) == [] and R.loaded_dates(spark, store).count() == 0
    assert R.write_raw(rows(spark, "ab", JAN), store) == 2
    leave_behind(rows(spark, "z", JAN), store)                        # into a committed date
    leave_behind(rows(spark, "z", FEB), store)                        # a date of its own
    rows(spark, "q", MAR).write.mode("append").partitionBy("snapshot_date").parquet(store)      # another writer's files
    assert held(spark, store) == [("2026-01-31", "a"), ("2026-01-31", "b")]
    assert R.append_new(spark, rows(spark, "cd", FEB), store) == 2    # the date that broke off is loaded whole
    assert held(spark, store) == [("2026-01-31", "a"), ("2026-01-31", "b"), ("2026-02-28", "c"), ("2026-02-28", "d")]


def test_a_replacing_load_takes_the_place_in_one_step(spark, tmp_dir):
    store = f"{tmp_dir}/s"
    R.write_raw(rows(spark, "ab", JAN).unionByName(rows(spark, "c", FEB)), store)
    before = R.read_raw(spark, store)                                 # a reader at work keeps what it planned on
    R.replace_snapshot(rows(spark, "n", JAN), store)
    assert held(spark, store) == [("2026-01-31", "n"), ("2026-02-28", "c")]
    assert before.count() == 3 and R.loaded_dates(spark, store).count() == 2


def test_columns_come_from_the_log_and_no_footer_is_opened(spark, tmp_dir):
    store = f"{tmp_dir}/s"
    R.write_raw(rows(spark, "a", JAN), store)
    R.write_raw(rows(spark, "b", FEB, case_ref="X"), store)
    assert R.read_raw(spark, store).columns == ["entity_name", "case_ref", "snapshot_date"]
    got = sorted((str(r.snapshot_date), r.case_ref) for r in R.read_raw(spark, store).collect())
    assert got == [("2026-01-31", None), ("2026-02-28", "X")]
    for path in glob.glob(f"{store}/snapshot_date=2026-01-31/*.parquet"):
        with open(path, "wb") as f:
            f.write(b"no parquet")
        os.remove(os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc"))
    df = R.read_raw(spark, store)
    assert df.columns == ["entity_name", "case_ref", "snapshot_date"]
    assert df.where("snapshot_date = DATE'2026-02-28'").count() == 1  # pruned: the other date's files aren't touched
    with pytest.raises(Exception):  # noqa: B017 - Spark's error for a file that is no Parquet
        df.collect()


def test_types_and_the_required_date_are_enforced_on_write(spark, tmp_dir):
    store = f"{tmp_dir}/s"
    R.write_raw(rows(spark, "a", JAN, _row_number=1), store)
    with pytest.raises(Exception, match="snapshot_date is required"):
        R.write_raw(rows(spark, "b", FEB).unionByName(rows(spark, "c", None)), store)
    with pytest.raises(Exception, match="(?i)cast"):
        R.write_raw(rows(spark, "b", FEB, _row_number="first"), store)
    assert held(spark, store) == [("2026-01-31", "a")]
    R.write_raw(rows(spark, "b", FEB, _row_number="2"), store)        # text that has the type
    kinds = dict(R.read_raw(spark, store).dtypes)
    assert kinds == {"entity_name": "string", "_row_number": "bigint", "snapshot_date": "date"}


def test_a_column_can_not_change_its_type(spark):
    import json
    field = lambda kind: json.dumps({"type": "struct", "fields": [
        {"name": "c", "type": kind, "nullable": True, "metadata": {}}]})
    same = [{"version": 1, "load": "a", "columns": field("string")}, {"version": 2, "load": "b", "columns": field("string")}]
    assert L.merged(same).simpleString() == "struct<c:string>"
    with pytest.raises(ValueError, match="column c is string in the store"):
        L.merged([same[0], {"version": 2, "load": "b", "columns": field("long")}])


def test_an_interrupted_landing_is_repeated_whole(spark, tmp_dir):
    landing, store = f"{tmp_dir}/l", f"{tmp_dir}/s"
    all_rows = rows(spark, "abc", JAN).unionByName(rows(spark, "d", FEB))
    R.land_snapshots(rows(spark, "d", FEB), landing, "registry_")
    # a run that wrote a part of January and broke off
    rows(spark, "a", JAN).select("entity_name", F.lit("registry_31_01_2026.csv").alias("snapshot")) \
        .write.mode("append").option("header", True).option(L.BASENAME, L.load_name()).partitionBy("snapshot").csv(landing)
    names = lambda: sorted({r.file_name for r in R.list_snapshots(spark, landing).collect()})
    assert names() == ["registry_28_02_2026.csv"]
    assert load_landing(spark, landing, store).plan == {"LOAD": 1}
    R.land_snapshots(all_rows, landing, "registry_")
    R.land_snapshots(all_rows, landing, "registry_")                  # landed: nothing is written again
    assert names() == ["registry_28_02_2026.csv", "registry_31_01_2026.csv"]
    assert load_landing(spark, landing, store).plan == {"LOAD": 1, "SKIP": 1}
    assert held(spark, store) == [("2026-01-31", n) for n in "abc"] + [("2026-02-28", "d")]


def test_files_of_other_writers_are_listed_beside_landed_ones(spark, tmp_dir):
    R.land_snapshots(rows(spark, "a", JAN), f"{tmp_dir}/l", "registry_")
    os.makedirs(f"{tmp_dir}/l/by hand")
    with open(f"{tmp_dir}/l/by hand/registry 28_02_2026.csv", "w") as f:
        f.write("entity_name\nb\n")
    got = R.read_snapshots(spark, f"{tmp_dir}/l")
    assert sorted((str(r._snapshot_date), r.entity_name, r._row_number) for r in got.collect()) == \
        [("2026-01-31", "a", 1), ("2026-02-28", "b", 1)]


def test_incremental_stream_plans_on_what_arrived(spark, tmp_dir, monkeypatch):
    from rollcall.streaming.landing import stream_new_snapshots
    landing, store = f"{tmp_dir}/l", f"{tmp_dir}/s"
    listed = []
    monkeypatch.setattr(R, "list_snapshots", lambda *a, f=R.list_snapshots, **k: listed.append(k.get("of")) or f(*a, **k))

    def run():
        stream_new_snapshots(spark, landing, store, f"{tmp_dir}/c", incremental=True).awaitTermination()

    R.land_snapshots(rows(spark, "ab", JAN), landing, "registry_")
    run()
    # the files of a landing that breaks off arrive, and wait
    rows(spark, "c", FEB).select("entity_name", F.lit("registry_28_02_2026.csv").alias("snapshot")) \
        .write.mode("append").option("header", True).option(L.BASENAME, L.load_name()).partitionBy("snapshot").csv(landing)
    run()
    assert held(spark, store) == [("2026-01-31", "a"), ("2026-01-31", "b")]
    R.land_snapshots(rows(spark, "cd", FEB), landing, "registry_")
    R.land_snapshots(rows(spark, "e", MAR), landing, "registry_")
    run()
    run()
    assert held(spark, store) == [("2026-01-31", "a"), ("2026-01-31", "b"), ("2026-02-28", "c"), ("2026-02-28", "d"), ("2026-03-31", "e")]
    names = [sorted(p.rsplit("_", 3)[1] for p in of) for of in listed]     # the days of month that each plan listed
    assert names == [["31"], ["28"], ["28", "31"]]
