"""The backfill as a segmented scan: a hot group is many tasks, and the rows are those of the definition."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from rollcall.operators import gaps
from rollcall.operators.gaps import backfill, carries, in_ranges, scanned_carries

BASE = dt.date(2024, 1, 1)


def definition(rows):
    """(group, date, number, value): own value, else the last before, else the first after."""
    out = set()
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2], r[3] is not None, r[3] or ""))
        for i, r in enumerate(mine):
            before = [x[3] for x in mine[:i] if x[3] is not None]
            after = [x[3] for x in mine[i + 1:] if x[3] is not None]
            out.add((g, r[1], r[2], r[3] if r[3] is not None else (before or after[:1] or [None])[-1]))
    return out


def table(spark, n=1500, missing=0.4, seed=3):
    rnd = random.Random(seed)
    names = lambda i: None if i % 11 == 0 else "" if i % 3 else f"g{i % 17}"  # noqa: E731  two of three rows have no name
    rows = [(names(i), BASE + dt.timedelta(days=rnd.randrange(12)), i, None if rnd.random() < missing else str(rnd.randrange(100)))
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "g string, snapshot_date date, _row_number int, v string")


@pytest.mark.parametrize("missing", [0.0, 0.4, 0.97, 1.0])
def test_scan_equals_the_definition(spark, missing):
    rows, df = table(spark, missing=missing)
    got = [tuple(r) for r in backfill(df, "v", ["g"], "snapshot_date", ["_row_number"], scan=True).collect()]
    assert len(got) == len(rows) and set(got) == definition(rows)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None)], [("a", BASE, 1, None), ("a", BASE, 1, "x"), ("a", BASE, 1, None)],
                                  [("a", None, 1, "x"), ("a", BASE, None, None), (None, BASE, 1, None), (None, BASE, 2, "y")]])
def test_scan_of_nulls_ties_and_empty_tables(spark, rows):
    df = spark.createDataFrame(rows, "g string, snapshot_date date, _row_number int, v string")
    same = lambda scan: sorted(map(str, backfill(df, "v", ["g"], "snapshot_date", ["_row_number"], scan=scan).collect()))
    assert same(True) == same(False)


def summary(df):
    return df.select("g", "snapshot_date", "_row_number", F.col("v").alias("_first"), F.col("v").alias("_last"))


def test_a_hot_group_is_many_tasks(spark):
    rows, df = table(spark)
    ranged = in_ranges(summary(df), ["g"], ["snapshot_date", "_row_number"], ranges=8)
    hot = {r._range: r.n for r in ranged.where("g = ''").groupBy("_range").agg(F.count("*").alias("n")).collect()}
    total = sum(1 for r in rows if r[0] == "")
    assert len(hot) >= 4 and max(hot.values()) < total / 2
    scanned = scanned_carries(ranged, ["g"], ["snapshot_date", "_row_number"])
    assert sorted(map(str, scanned.collect())) == sorted(map(str, carries(
        summary(df), ["g"], ["snapshot_date", "_row_number"]).select(scanned.columns).collect()))
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"Window \[.*\], \[(.*?)\], \[(.*?)\]", plan)
    # windows over rows are by range and group; one by group alone runs over one row a range and group
    assert windows and all("_range" in by or order.startswith("_range") for by, order in windows)


def test_the_staged_registry_scans(spark, monkeypatch):
    """The registry's backfill, with its row numbers as tie-break, goes through the scan."""
    from rollcall.plans import staging as S
    seen = []
    monkeypatch.setattr(gaps, "in_ranges", lambda *a, f=gaps.in_ranges, **k: seen.append(f(*a, **k)) or seen[-1])
    rows = [("LOCAL", "2", "ASIA", None if i % 2 else str(i % 5), "", None, None, "SI", BASE, i) for i in range(400)]
    raw = spark.createDataFrame(rows, "entity_type string, region_code string, region_name string, entity_no string, entity_name "
                                "string, acronym string, recognised_on string, member_flag string, snapshot_date date, _row_number long")
    staged = S.stage(raw)
    assert staged.count() == 400 and staged.where("entity_no IS NULL").count() == 0
    assert seen and seen[0].select("_range").distinct().count() > 1
