"""Positions of an order: 1 to n, over many tasks, ties and NULLs included."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from rollcall.operators.positions import with_positions
from rollcall.sources.export import export_current


@pytest.mark.parametrize("n", [0, 1, 700])
def test_positions_are_those_of_the_sorted_rows(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([None, "a", "b"]) if i % 3 else "hot", None if i % 5 == 0 else rng.randrange(9), i) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, v int, i int")
    got = [tuple(r) for r in with_positions(df, ["k", F.col("v").desc_nulls_last()], ranges=6).orderBy("position").collect()]
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is None, -(r[1] or 0)))
    assert [(r[0], r[1]) for r in got] == [(r[0], r[1]) for r in want]
    assert [r[3] for r in got] == list(range(1, n + 1)) and sorted(r[2] for r in got) == list(range(n))


def test_a_value_that_most_rows_have_is_many_tasks(spark):
    df = spark.range(3000).select(F.lit("hot").alias("k"), "id")
    got = with_positions(df, ["k"], ranges=8)
    assert sorted(r.position for r in got.collect()) == list(range(1, 3001))
    path = max(glob.glob(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/positions-*"), key=lambda p: __import__("os").path.getmtime(p))
    dealt = spark.read.parquet(path).groupBy("_range").count().collect()
    assert len(dealt) >= 4 and max(r["count"] for r in dealt) < 1500


def test_the_publication_carries_its_order(spark, tmp_dir):
    import datetime as dt
    rows = [(f"e{i}", f"{9 - i % 10}", dt.date(2024, 3, 31)) for i in range(40)]
    current = spark.createDataFrame(rows, "entity_id string, region_code string, updated date")
    target = export_current(current, tmp_dir, order=["region_code"], position="NO")
    out = spark.read.option("header", True).csv(target)
    assert out.columns == ["NO", "ENTITY ID", "REGION CODE", "UPDATED"]
    got = sorted((int(r["NO"]), r["REGION CODE"], r["ENTITY ID"]) for r in out.collect())
    assert [(r, e) for _, r, e in got] == sorted((r, e) for e, r, _ in rows) and [p for p, _, _ in got] == list(range(1, 41))
