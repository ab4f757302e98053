"""The one ingest path: whole snapshots, whole dates, cells as typed."""

import datetime as dt
import glob
import os
import shutil

import pytest

from rollcall.operators import checks as K
from rollcall.plans.ingest import load_landing
from rollcall.sources import raw_store as R
from rollcall.streaming.landing import stream_new_snapshots

NAME = "Entities Registry at {}.csv"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)


def landing(base):
    head = "entity_name,region_name\n"
    for k in range(3):                                        # one snapshot as a folder of part files
        write(f"{base}/{NAME.format('31_01_2026')}/part-0000{k}.csv", head + f"a{k},ASIA\nb{k},EUROPE\n")
    write(f"{base}/{NAME.format('28_02_2026')}", head + "first,ASIA\n")
    write(f"{base}/{NAME.format('28-02-2026')}", head + "second,ASIA\n")        # the same date; '-' sorts first
    write(f"{base}/x/{NAME.format('31_03_2026')}", head + "x,ASIA\n")            # the same name in two folders
    write(f"{base}/y/{NAME.format('31_03_2026')}", head + "y,ASIA\n")
    write(f"{base}/Entities Registry at 30_04_2026.txt", head + "text,ASIA\n")


def rows(spark, store):
    return sorted((str(r.snapshot_date), r._row_number, r.entity_name) for r in R.read_raw(spark, store).collect())


WANT = sorted([("2026-01-31", 2 * k + j + 1, f"{c}{k}") for k in range(3) for j, c in enumerate("ab")]
              + [("2026-02-28", 1, "second"), ("2026-03-31", 1, "x")])


def test_plan_load_and_repeat(spark, tmp_dir):
    landing(f"{tmp_dir}/l")
    done = load_landing(spark, f"{tmp_dir}/l", f"{tmp_dir}/s")
    assert done.plan == {"LOAD": 3, "SKIP": 2, "IGNORED": 1} and done.rows == 8
    assert rows(spark, f"{tmp_dir}/s") == WANT
    again = load_landing(spark, f"{tmp_dir}/l", f"{tmp_dir}/s")
    assert again.plan == {"SKIP": 5, "IGNORED": 1} and again.rows == 0
    assert rows(spark, f"{tmp_dir}/s") == WANT


def test_stream_with_a_cap_of_one_file(spark, tmp_dir):
    landing(f"{tmp_dir}/l")
    stream_new_snapshots(spark, f"{tmp_dir}/l", f"{tmp_dir}/s", f"{tmp_dir}/c", max_files_per_trigger=1).awaitTermination()
    assert rows(spark, f"{tmp_dir}/s") == WANT


def test_interrupted_load_is_repeated_whole(spark, tmp_dir):
    landing(f"{tmp_dir}/l")
    load_landing(spark, f"{tmp_dir}/l", f"{tmp_dir}/s")
    # as after a stop in the middle of a commit: some files of a date, the date not committed
    kept = sorted(glob.glob(f"{tmp_dir}/s/snapshot_date=2026-01-31/*.parquet"))[:1]
    os.makedirs(f"{tmp_dir}/half/snapshot_date=2026-01-31")
    shutil.copy(kept[0], f"{tmp_dir}/half/snapshot_date=2026-01-31/")
    assert R.loaded_dates(spark, f"{tmp_dir}/half").count() == 0
    load_landing(spark, f"{tmp_dir}/l", f"{tmp_dir}/half")
    assert rows(spark, f"{tmp_dir}/half") == WANT


def test_cells_come_back_as_typed(spark, tmp_dir):
    cells = ['PARTY "X", NORTH', "TWO\nLINES", "a,b", '"', "back\\slash", "  blanks  ", "semi;colon", "é"]
    df = spark.createDataFrame([(c, dt.date(2026, 1, 31)) for c in cells], "entity_name string, snapshot_date date")
    R.land_snapshots(df, f"{tmp_dir}/l", "registry_", ".csv")
    R.land_snapshots(df, f"{tmp_dir}/l", "registry_", ".csv")          # landed already: writes nothing
    got = R.read_snapshots(spark, f"{tmp_dir}/l")
    assert sorted(r.entity_name for r in got.collect()) == sorted(cells)
    numbers = sorted(r._row_number for r in R.shape_raw(got).collect())
    assert numbers == list(range(1, len(cells) + 1))


def test_rows_wider_than_the_header_fail(spark, tmp_dir):
    write(f"{tmp_dir}/l/{NAME.format('31_01_2026')}", "a,b\n1,2,3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        R.shape_raw(R.read_snapshots(spark, f"{tmp_dir}/l")).collect()


def test_grain_checks_report_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], "k string, d int")
    assert K.check_unique(df, ["k", "d"]).count() == 0
    assert [(r.k, r.n) for r in K.check_unique(df, ["k", "d"], nulls_count=True).collect()] == [(None, 2)]


def test_a_cluster_without_a_shared_folder_is_refused():
    from rollcall.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"
        getConf = lambda self: Conf()
        getCheckpointDir = lambda self: None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
