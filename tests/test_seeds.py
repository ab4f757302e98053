"""Seeds: rows that can't be used stop the run or are set aside, with their reason."""

import datetime as dt

import pytest

from rollcall.operators.corrections import apply_corrections
from rollcall.sources import raw_store as R

SCHEMA = "snapshot_date date, code string, weight int, fixed string"
GOOD = "snapshot_date,code,weight,fixed\n2026-01-31,01,5,X\n2026-02-28,01,,Y\n"
KEYS = ["snapshot_date", "code"]


def seed(spark, tmp_dir, text, **kw):
    with open(f"{tmp_dir}/seed.csv", "w") as f:
        f.write(text)
    return R.read_seed(spark, f"{tmp_dir}/seed.csv", SCHEMA, **kw)


def test_good_rows_keep_their_cells(spark, tmp_dir):
    got = sorted(tuple(r) for r in seed(spark, tmp_dir, GOOD, keys=KEYS).collect())
    assert got == [(dt.date(2026, 1, 31), "01", 5, "X"), (dt.date(2026, 2, 28), "01", None, "Y")]
    assert seed(spark, tmp_dir, GOOD).columns == ["snapshot_date", "code", "weight", "fixed"]


@pytest.mark.parametrize("line, reason", [
    ("2026-03-31,02,7,Z,one too many", "malformed"), ("2026-03-31,02,7", "malformed"), ("2026-03-31,02,seven,Z", "malformed"),
    ("31/03/2026,02,7,Z", "malformed"), ("2026-03-31,,7,Z", "key missing"), ("2026-01-31,01,6,Z", "key doubled")])
def test_bad_rows_stop_the_run_or_are_set_aside(spark, tmp_dir, line, reason):
    with pytest.raises(R.SeedError, match=reason):
        seed(spark, tmp_dir, GOOD + line + "\n", keys=KEYS)
    kept = seed(spark, tmp_dir, GOOD + line + "\n", keys=KEYS, quarantine=f"{tmp_dir}/q").collect()
    aside = spark.read.parquet(f"{tmp_dir}/q").collect()
    assert {r._reason for r in aside} == {reason} and len(kept) + len(aside) == 3
    assert len(kept) == (1 if reason == "key doubled" else 2)         # of several rows with one key none is taken


def test_a_missing_date_can_be_allowed_and_copies_count_once(spark, tmp_dir):
    text = GOOD + ",02,1,Z\n" + ",02,1,Z\n"
    assert seed(spark, tmp_dir, text, keys=KEYS, nullable={"snapshot_date"}).count() == 3
    with pytest.raises(R.SeedError, match="key missing"):
        seed(spark, tmp_dir, text, keys=KEYS)


def test_corrections_from_a_checked_seed_double_no_row(spark, tmp_dir):
    fixes = seed(spark, tmp_dir, GOOD + GOOD.split("\n", 1)[1], keys=KEYS).drop("weight")
    rows = spark.createDataFrame([(dt.date(2026, 1, 31), "01", "old")], "snapshot_date date, code string, name string")
    assert [r.name for r in apply_corrections(rows, fixes, ["code"], "name", "fixed").collect()] == ["X"]
