"""The grids of the searches where every cell is a task of its own, as on large tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import kronecker, lemp, topk
from rollcall.llm.topk import maxscore_topk
from tests.llm.test_search_and_licenses import mined, negatives, prose, ranked, searched


@pytest.fixture()
def apart(spark):
    """No partitions are merged: small tables are dealt over the tasks as large ones are."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    was = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield spark
    spark.conf.set(key, was)


def tops(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted(map(tuple, maxscore_topk(df, F.col("vec_id") % 20 == 0, k=20).collect()))


def best(rows):
    """Brute force by row: a query row's candidates are all rows but itself."""
    ids, w = np.array([i for i, _ in rows]), np.array([np.floor(64 * np.array(v)) for _, v in rows]).astype(np.int64)
    out = []
    for a in np.flatnonzero(ids % 20 == 0):
        s = w @ w[a]
        out += [(ids[a], r, ids[i], s[i]) for r, i in enumerate([i for i in np.lexsort((ids, -s)) if i != a][:20], 1)]
    return sorted(out)


def vectors(n, width, seed):
    return [(i, [float(x) for x in v]) for i, v in enumerate(np.round(np.random.RandomState(seed).randn(n, width), 2))]


def test_topk_of_many_cells(apart, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 40)
    monkeypatch.setattr(topk, "QUERIES", 5)
    rows = vectors(300, 8, 4)
    assert tops(apart, rows) == best(rows)


def test_topk_meets_other_rows_of_its_id(apart):
    rows = vectors(60, 4, 5)
    rows += [rows[20], rows[20], (40, rows[3][1])]
    assert tops(apart, rows) == best(rows)


def test_topk_of_empty_vectors(spark):
    assert tops(spark, [(0, []), (1, []), (20, [])]) == [(0, 1, 1, 0), (0, 2, 20, 0), (20, 1, 0, 0), (20, 2, 1, 0)]


def test_topk_where_bounds_exceed_64_bits(spark):
    """Scores fit, sums of the terms' bounds don't."""
    rng = np.random.default_rng(6)
    x = rng.integers(-2 ** 29, 2 ** 29, (3 * topk.BLOCK, 64))
    x[0] = rng.choice((-2 ** 29, 2 ** 29), 64)
    exact = x.astype(object) @ x[0].astype(object)
    assert abs(exact[1:]).max() < 2 ** 63
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, maxscore_topk(df, F.col("vec_id") == 0, k=20, scale=1).collect()))
    want = sorted((-s, i) for i, s in enumerate(exact) if i != 0)[:20]
    assert got == [(0, r, i, -s) for r, (s, i) in enumerate(want, 1)]


def test_search_of_many_cells(apart, monkeypatch):
    for name, value in (("SHARD", 60), ("ITEM_TERMS", 40)):
        monkeypatch.setattr(lemp, name, value)
    rng = random.Random(4)
    docs = [(i, prose(rng, rng.choice((3, 20, 90)))) for i in range(300)]
    items = [(i, prose(rng, 12)) for i in range(15)]
    assert searched(apart, docs, items) == ranked(docs, items) != []


def test_negatives_of_many_cells(apart, monkeypatch):
    monkeypatch.setattr(kronecker, "SHARD", 37)
    monkeypatch.setattr(kronecker, "ANCHORS", 2)
    rng = np.random.RandomState(3)
    rows = [(20 * i, [float(x) for x in v], int(rng.choice(3))) for i, v in enumerate(np.round(rng.normal(0.1, 0.2, (200, 6)), 3))]
    want = mined([(i, [float(np.float32(x)) for x in v], b) for i, v, b in rows])
    assert negatives(apart, rows) == want and len(want) > 30
