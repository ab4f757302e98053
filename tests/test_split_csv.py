"""Quoted CSV over many splits: cells, headers and row numbers of the files, whatever the cut."""

import csv
import io
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.sources import raw_store as R
from rollcall.sources import split_csv

NAME = "Entities Registry at {}.csv"


def write(path, text, encoding="utf-8"):
    import os
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def as_csv(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def read(spark, folder, cols):
    got = R.read_snapshots(spark, folder)
    return sorted((r._source_file, r._row_number, *[r[c] or "" for c in cols]) for r in got.collect())


def test_one_large_file_is_read_by_many_tasks(spark, tmp_dir, small_splits):
    rng = random.Random(1)
    cells = ["plain", 'a "quoted" word', "two\nlines", "a,b", "", "win\r\ndows", "\n", '"', "ü" * 9, "x" * 900 + "\n" * 5, '""\n""']
    rows = [[str(i), rng.choice(cells), rng.choice(cells)] for i in range(400)]
    write(f"{tmp_dir}/l/{NAME.format('31_01_2026')}", as_csv([["seq", "entity_name", "note"], *rows]))
    assert read(spark, f"{tmp_dir}/l", ["seq", "entity_name", "note"]) == \
        sorted((NAME.format("31_01_2026"), i + 1, *r) for i, r in enumerate(rows))
    files = R.landed_files(spark, f"{tmp_dir}/l")
    found = split_csv.lines(spark, files).select("_block", F.spark_partition_id().alias("t")).distinct().collect()
    assert len({r._block for r in found}) > 20 and len({r.t for r in found}) > 20
    plan = R.read_snapshots(spark, f"{tmp_dir}/l")._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD[seq" not in plan                # numbered by position: no checkpointed copy


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.text('ab",\n\ré ', max_size=8), st.text('x"\n', max_size=300)), min_size=1, max_size=25),
       end=st.sampled_from(["\n", "\r\n"]))
def test_any_cells_come_back(spark, tmp_path_factory, small_splits, rows, end):
    folder = str(tmp_path_factory.mktemp("csv"))
    rows = [(f"k{a}", b) for a, b in rows]              # a first cell that is not empty: an empty line is no record
    write(f"{folder}/{NAME.format('31_01_2026')}", as_csv([["k", "v"], *rows], end))
    assert read(spark, folder, ["k", "v"]) == sorted((NAME.format("31_01_2026"), i + 1, *r) for i, r in enumerate(rows))


def test_numbers_do_not_depend_on_the_cut(spark, tmp_dir, small_splits):
    rows = [[str(i), "a\nb" if i % 3 else "c"] for i in range(300)]
    for k in range(3):
        write(f"{tmp_dir}/l/{NAME.format('31_01_2026')}/part-0000{k}.csv", as_csv([["seq", "v"], *rows[k * 100:k * 100 + 100]]))
    fine = read(spark, f"{tmp_dir}/l", ["seq"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert read(spark, f"{tmp_dir}/l", ["seq"]) == fine == sorted((NAME.format("31_01_2026"), i + 1, str(i)) for i in range(300))


def test_another_cut_in_between_fails_and_loses_nothing(spark, tmp_dir, small_splits):
    write(f"{tmp_dir}/l/{NAME.format('31_01_2026')}", as_csv([["seq", "v"], *[[str(i), "a\nb"] for i in range(300)]]))
    got = R.read_snapshots(spark, f"{tmp_dir}/l")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    with pytest.raises(Exception, match="cut in another way"):
        got.collect()
    assert R.read_snapshots(spark, f"{tmp_dir}/l").count() == 300


def test_headers_with_breaks_marks_and_other_columns(spark, tmp_dir):
    write(f"{tmp_dir}/l/{NAME.format('31_01_2026')}", '﻿"Entity\nName",Region Code\r\nAlpha,1\r\n\r\nBeta,2\r\n')
    write(f"{tmp_dir}/l/{NAME.format('28_02_2026')}", "\n\nRegion Code,EntityName,Extra\n3,Gamma,x")
    write(f"{tmp_dir}/l/{NAME.format('31_03_2026')}", "Region Code\n")
    write(f"{tmp_dir}/l/{NAME.format('30_04_2026')}", "")
    got = R.read_snapshots(spark, f"{tmp_dir}/l")
    assert {"entityname", "region_code", "extra"} <= set(got.columns)
    assert sorted((str(r._snapshot_date), r._row_number, r.entityname, r.region_code, r.extra) for r in got.collect()) == [
        ("2026-01-31", 1, "Alpha", "1", None), ("2026-01-31", 2, "Beta", "2", None), ("2026-02-28", 1, "Gamma", "3", "x")]


@pytest.mark.parametrize("body", ['a,b\n1,"2\n3,4\n', 'a,b\n1,2,3\n', 'a,b\n1\n', '"a,b\n1,2\n'])
def test_bad_files_fail_the_read(spark, tmp_dir, body):
    write(f"{tmp_dir}/l/{NAME.format('31_01_2026')}", body)
    with pytest.raises(Exception, match="(?i)malformed|do not pair"):
        R.read_snapshots(spark, f"{tmp_dir}/l").collect()


def test_formats_other_than_csv_are_numbered_without_a_copy(spark, tmp_dir):
    spark.range(100).selectExpr("CAST(id AS STRING) AS seq").coalesce(1).write.parquet(f"{tmp_dir}/l/{NAME.format('31_01_2026')}")
    raw = R.shape_raw(R.read_snapshots(spark, f"{tmp_dir}/l", fmt="parquet"))
    assert sorted((r._row_number, int(r.seq) + 1) for r in raw.collect()) == [(i, i) for i in range(1, 101)]
    assert "ExistingRDD[seq" not in raw._jdf.queryExecution().executedPlan().toString()
