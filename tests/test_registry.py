import datetime as dt

from hypothesis import given, settings, strategies as st

from rollcall.operators import canonical as C
from rollcall.operators.corrections import apply_corrections
from rollcall.operators.gaps import backfill
from rollcall.plans import staging as S

D1, D2, D3 = dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 31)
KEYS = ["entity_type", "region_code", "entity_no"]


def test_dated_beats_undated_and_undated_applies_everywhere(spark):
    rows = spark.createDataFrame(
        [("LOCAL", "01", "005", "X ANNOT", d) for d in (D1, D2, D3)] + [("LOCAL", "01", None, "Y", D1)],
        "entity_type string, region_code string, entity_no string, entity_name string, snapshot_date date")
    fixes = spark.createDataFrame([(D2, "LOCAL", "01", "005", "DATED"), (None, "LOCAL", "01", "005", "ALL")],
                                  S.NAME_CORRECTION_SCHEMA)
    out = apply_corrections(rows, fixes, KEYS, "entity_name", "entity_name_fixed", date_optional=True)
    got = sorted((r.snapshot_date, r.entity_no or "", r.entity_name) for r in out.collect())
    assert got == [(D1, "", "Y"), (D1, "005", "ALL"), (D2, "005", "DATED"), (D3, "005", "ALL")]
    assert out.count() == 4   # no fan-out


def test_region_correction_only_listed_rows(spark):
    rows = spark.createDataFrame([("LOCAL", "09", "001", D1), ("LOCAL", "09", "001", D2)],
                                 "entity_type string, region_code string, entity_no string, snapshot_date date")
    fixes = spark.createDataFrame([(D1, "LOCAL", "09", "001", "02")], S.REGION_CORRECTION_SCHEMA)
    out = apply_corrections(rows, fixes, KEYS, "region_code", "region_code_fixed")
    assert sorted((r.snapshot_date, r.region_code) for r in out.collect()) == [(D1, "02"), (D2, "09")]


def test_canonicalise_guard(spark):
    lookup = spark.createDataFrame([("18", "SAN JUAN"), ("19", "SAN LUIS"), ("06", "CHACO"),
                                    ("01", "CAPITAL FEDERAL")], "region_code string, region_name string")
    rows = spark.createDataFrame([("18", "SAN JUAM"), ("19", "SAN JUAN"), ("06", "CAPITAL FEDERAL"),
                                  ("77", "NOWHERE"), ("01", None)], "region_code string, region_name string")
    out = C.canonicalise(rows, lookup, on="region_code", value="region_name", threshold=0.20)
    got = {r.region_code: (r.region_name, r.needs_review, r.suggested) for r in out.collect()}
    assert got["18"] == ("SAN JUAN", False, None)                 # spelling variant fixed
    assert got["19"] == ("SAN JUAN", True, "SAN LUIS")            # similar names do not merge
    assert got["06"] == ("CAPITAL FEDERAL", True, "CHACO")        # contradiction kept + flagged
    assert got["77"] == ("NOWHERE", False, None)                  # no official value
    assert got["01"] == (None, None, None)                        # NULL name -> NULL flag


def test_leader_rule(spark):
    rows = spark.createDataFrame([
        ("NATIONAL", "001", "PARTY OF ALL", False, D1),
        ("LOCAL", "001", "PARTY OF ALL X", True, D1),      # close -> leader name
        ("LOCAL", "001", "SOMETHING ELSE", True, D1),      # far -> flagged
        ("LOCAL", "001", "PARTY OF ALL X", False, D1),     # not a member -> untouched
        ("LOCAL", "001", "PARTY OF ALL X", True, D2)],     # no leader that date
        "entity_type string, entity_no string, entity_name string, is_member boolean, snapshot_date date")
    out = C.canonicalise_to_leader(rows).collect()
    got = sorted((r.entity_type, r.is_member, r.snapshot_date, r.entity_name, r.needs_name_review,
                  r.suggested_name) for r in out)
    assert ("LOCAL", True, D1, "PARTY OF ALL", False, None) in got
    assert ("LOCAL", True, D1, "SOMETHING ELSE", True, "PARTY OF ALL") in got
    assert ("LOCAL", False, D1, "PARTY OF ALL X", False, None) in got
    assert ("LOCAL", True, D2, "PARTY OF ALL X", False, None) in got
    assert len(got) == 5


def test_backfill_cases(spark):
    rows = [("R", "A", D1, "005"), ("R", "A", D2, None), ("R", "A", D3, "006"),   # earlier wins
            ("R", "B", D1, None), ("R", "B", D2, "007"),                          # only later
            ("R", "C", D1, None), ("R", "C", D2, None),                            # neither
            (None, None, D1, "008"), (None, None, D2, None)]                      # NULL group
    df = spark.createDataFrame(rows, "r string, n string, snapshot_date date, no string")
    out = backfill(df, "no", ["r", "n"], "snapshot_date")
    got = sorted(((r.n or ""), r.snapshot_date, r.no) for r in out.collect())
    assert got == [("", D1, "008"), ("", D2, "008"), ("A", D1, "005"), ("A", D2, "005"), ("A", D3, "006"),
                   ("B", D1, "007"), ("B", D2, "007"), ("C", D1, None), ("C", D2, None)]


def brute_backfill(rows):
    out = []
    for i, (g, d, t, v) in enumerate(rows):
        if v is not None:
            out.append((g, d, t, v))
            continue
        grp = sorted([r for r in rows if r[0] == g], key=lambda r: (r[1], r[2]))
        pos = grp.index(rows[i])
        before = [r[3] for r in grp[:pos] if r[3] is not None]
        after = [r[3] for r in grp[pos + 1:] if r[3] is not None]
        out.append((g, d, t, before[-1] if before else (after[0] if after else None)))
    return sorted(out, key=lambda r: (r[0], r[1], r[2], r[3] or ""))


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 5), st.one_of(st.none(), st.integers(0, 99))),
                min_size=1, max_size=40))
def test_backfill_matches_row_order_definition(spark, cells):
    # unique (group, date, tie) so the row order is total, as in the model
    rows = [(f"g{g}", dt.date(2024, 1, 1) + dt.timedelta(days=d), i, None if v is None else str(v))
            for i, (g, d, v) in enumerate(cells)]
    df = spark.createDataFrame(rows, "g string, snapshot_date date, t int, v string")
    out = backfill(df, "v", ["g"], "snapshot_date", ["t"]).collect()
    got = sorted(((r.g, r.snapshot_date, r.t, r.v) for r in out), key=lambda r: (r[0], r[1], r[2], r[3] or ""))
    assert got == brute_backfill(rows)
