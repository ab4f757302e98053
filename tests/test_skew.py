"""Hot keys: one key (or the NULL key) holding a third of all rows must give
the same results as the row-by-row definitions."""

import datetime as dt
import random

from rollcall.operators import checks as K
from rollcall.operators import history as H
from rollcall.operators.gaps import backfill

BASE = dt.date(2024, 1, 1)


def test_scd2_with_hot_null_key_and_duplicates(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        key = None if hot else f"k{rnd.randrange(60)}"
        day = rnd.randrange(40)
        if not hot and day % 7 == 3:
            continue                      # leave gaps for ordinary keys
        rows.append((key, BASE + dt.timedelta(days=day), rnd.randrange(1000), i))
    df = spark.createDataFrame(rows, "k string, snapshot_date date, v int, seq int")
    got = {(r.k, r.valid_from, r.valid_to, r.v, r.is_current)
           for r in H.scd2_presence(df, "k", "snapshot_date", ["v"], order_by=["seq"]).collect()}
    dates = sorted({r[1] for r in rows})
    period = {d: i for i, d in enumerate(dates)}
    want = set()
    for key in {r[0] for r in rows}:
        mine = sorted({period[r[1]] for r in rows if r[0] == key})
        runs, start = [], mine[0]
        for a, b in zip(mine, mine[1:] + [None]):
            if b is None or b != a + 1:
                runs.append((start, a))
                start = b
        for s, e in runs:
            last = max((r for r in rows if r[0] == key and period[r[1]] == e), key=lambda r: r[3])
            want.add((key, dates[s], dates[e], last[2], e == len(dates) - 1))
    assert got == want


def test_backfill_with_hot_group(spark):
    rnd = random.Random(11)
    rows = [("HOT" if i % 3 else f"g{i % 17}", BASE + dt.timedelta(days=rnd.randrange(30)), i,
             None if rnd.random() < 0.4 else str(rnd.randrange(100))) for i in range(1500)]
    df = spark.createDataFrame(rows, "g string, snapshot_date date, t int, v string")
    got = {(r.g, r.t, r.v) for r in backfill(df, "v", ["g"], "snapshot_date", ["t"]).collect()}
    want = set()
    for g in {r[0] for r in rows}:
        grp = sorted([r for r in rows if r[0] == g], key=lambda r: (r[1], r[2]))
        for i, r in enumerate(grp):
            before = [x[3] for x in grp[:i] if x[3] is not None]
            after = [x[3] for x in grp[i + 1:] if x[3] is not None]
            want.add((g, r[2], r[3] if r[3] is not None else (before[-1] if before else (after[0] if after else None))))
    assert got == want


def test_overlap_with_hot_part(spark):
    rnd = random.Random(5)
    rows = [("HOT" if i % 3 == 0 else f"p{i % 50}", i) for i in range(1200)]
    rows = [(k, BASE + dt.timedelta(days=rnd.randrange(300)), rnd.randrange(4), i) for k, i in rows]
    rows = [(k, s, s + dt.timedelta(days=n), i) for k, s, n, i in rows]
    df = spark.createDataFrame(rows, "k string, valid_from date, valid_to date, i int")
    got = sorted((r.k, r.valid_from, r.valid_to, r.overlaps_until) for r in K.check_no_overlap(df, "k").collect())
    want = []
    for b in rows:
        earlier = [a[2] for a in rows if a[0] == b[0] and a[1] < b[1]]
        if earlier and b[1] <= max(earlier):
            want.append((b[0], b[1], b[2], max(earlier)))
    assert got == sorted(want)
