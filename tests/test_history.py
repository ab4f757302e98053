import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rollcall.operators import checks as K
from rollcall.operators import history as H

D = [dt.date(2024, m, 28) for m in (1, 2, 3, 5, 6, 7)]   # April never loaded


def panel(spark, rows):
    return spark.createDataFrame(rows, "k string, snapshot_date date, name string, seq int")


def test_gap_in_loaded_snapshots_splits_missing_month_does_not(spark):
    rows = [("A", d, "a", 1) for d in D] + [("B", d, "b", 1) for d in D if d != D[2]]
    h = H.scd2_presence(panel(spark, rows), "k", "snapshot_date", ["name"]).orderBy("k", "valid_from")
    got = [(r.k, r.valid_from, r.valid_to, r.is_current) for r in h.collect()]
    assert got == [("A", D[0], D[5], True), ("B", D[0], D[1], False), ("B", D[3], D[5], True)]


def test_attributes_come_from_last_snapshot_and_do_not_split(spark):
    rows = [("A", D[0], "old", 1), ("A", D[1], "new", 1), ("A", D[2], "newer", 1), ("Z", D[5], "z", 1)]
    h = H.scd2_presence(panel(spark, rows), "k", "snapshot_date", ["name"]).where("k = 'A'").collect()
    assert len(h) == 1 and h[0].name == "newer" and h[0].is_current is False


def test_duplicates_in_one_snapshot_continue_and_tiebreak(spark):
    rows = [("A", D[0], "x", 1), ("A", D[1], "first", 1), ("A", D[1], "second", 2)]
    h = H.scd2_presence(panel(spark, rows), "k", "snapshot_date", ["name"], order_by=["seq"]).collect()
    assert len(h) == 1 and h[0].name == "second" and h[0].is_current


def test_movements_booked_on_next_loaded_snapshot(spark):
    rows = [("A", d, "a", 1) for d in D[:2]] + [("B", d, "b", 1) for d in D] + \
           [("C", d, "c", 1) for d in D[3:]]
    p = panel(spark, rows)
    cal = H.calendar(p)
    m = H.movements(H.scd2_presence(p, "k", "snapshot_date", [], cal=cal), cal).orderBy("snapshot_date")
    got = [(r.snapshot_date, r.additions, r.removals, r.net) for r in m.collect()]
    assert got[0] == (D[0], 0, 0, 0)                 # first snapshot: baseline, no additions
    assert got[2] == (D[2], 0, 1, -1)                # A last seen D[1] -> removal on D[2]
    assert got[3] == (D[3], 1, 0, 1)                 # C starts after the missing month
    assert [r.month for r in m.collect()][:2] == ["01", "02"]


def test_current_view(spark):
    rows = [("A", D[0], "a", 1), ("A", D[1], "a", 1)]
    h = H.scd2_presence(panel(spark, rows).withColumn("flag", F.lit(None).cast("boolean")),
                        "k", "snapshot_date", ["name", "flag"])
    cv = H.current_view(h, key="k", flag_col="flag").collect()
    assert cv[0].entity_id == "A" and cv[0].flag == "NO" and cv[0].updated == D[1]


@settings(max_examples=12, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 4), st.integers(0, 9)), min_size=1, max_size=40))
def test_property_versions_expand_back_to_presence(spark, presence):
    rows = [(f"k{k}", dt.date(2024, 1, 1) + dt.timedelta(days=7 * p), "n", 1) for k, p in presence]
    p = panel(spark, rows)
    cal = H.calendar(p)
    h = H.scd2_presence(p, "k", "snapshot_date", ["name"], cal=cal)
    back = {(r.k, r.snapshot_date) for r in H.expand_versions(h, cal, "k").collect()}
    assert back == {(r[0], r[1]) for r in rows}
    for c in (K.check_unique(h, ["k", "valid_from"]), K.check_interval(h, "k"),
              K.check_no_overlap(h, "k"), K.check_single_current(h, "k")):
        assert c.count() == 0


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30), st.integers(0, 6)), min_size=1, max_size=30))
def test_overlap_window_equals_pairwise(spark, ivs):
    base = dt.date(2024, 1, 1)
    rows = [(f"p{k}", base + dt.timedelta(days=s), base + dt.timedelta(days=s + n), i)
            for i, (k, s, n) in enumerate(ivs)]
    df = spark.createDataFrame(rows, "k string, valid_from date, valid_to date, i int")
    got = sorted((r.k, r.valid_from, r.valid_to, r.overlaps_until)
                 for r in K.check_no_overlap(df, "k").collect())
    want = []
    for b in rows:
        tos = [a[2] for a in rows if a[0] == b[0] and a[1] < b[1] <= a[2]]
        if tos:
            want.append((b[0], b[1], b[2], max(a[2] for a in rows if a[0] == b[0] and a[1] < b[1])))
    assert got == sorted(want)


def test_run_checks_and_gate(spark):
    df = spark.createDataFrame([("A", 1), ("A", 1), (None, 2)], "k string, v int")
    rep = K.run_checks([K.Check("nn", K.check_not_null(df, "k")),
                        K.Check("uq", K.check_unique(df, "k"), K.WARN),
                        K.Check("ok", K.check_accepted(df, "k", ["A"]))])
    got = {r["check"]: (r.failures, r.status) for r in rep.collect()}
    assert got == {"nn": (1, "FAIL"), "uq": (1, "WARN"), "ok": (0, "PASS")}
    try:
        K.gate(rep)
        raise AssertionError("gate did not stop")
    except RuntimeError as e:
        assert "nn" in str(e)


def test_calendar_is_dense_over_loaded_dates(spark):
    p = panel(spark, [("A", d, "a", 1) for d in D])
    cal = H.calendar(p).orderBy("snapshot_date").collect()
    assert [r.period for r in cal] == list(range(1, 7))
    assert [r.next_date for r in cal][:3] == [D[1], D[2], D[3]] and cal[-1].is_last
