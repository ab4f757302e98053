import datetime as dt

from pyspark.sql import functions as F

from rollcall.functions import names as N
from rollcall.functions import text as X


def one(spark, col, data, schema="x string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_pad_code_spellings(spark):
    vals = ["2", "02", "2.0", "", "abc", "2.5", "1234", None, "-1.5"]
    got = one(spark, X.pad_code("x", 2), [(v,) for v in vals])
    assert got == ["02", "02", "02", None, None, "03", "12", None, "-2"]
    assert one(spark, X.pad_code("x", 3), [("1234",)]) == ["123"]
    assert one(spark, X.pad_code("x", 3, strict=True), [("1234",), ("7",)]) == ["1234", "007"]


def test_clean_name_collapses_and_trims_unicode(spark):
    got = one(spark, X.clean_name("x"), [("  san\t juan  ",), (" río negro ",), (None,)])
    assert got == ["SAN JUAN", "RÍO NEGRO", None]


def test_entity_key_null_propagation(spark):
    df = spark.createDataFrame([("NATIONAL", "02", "154"), ("LOCAL", "02", None), (None, "01", "001")],
                               "t string, r string, n string")
    got = [r[0] for r in df.select(X.entity_key("t", "r", "n")).collect()]
    assert got == ["N-02-154", None, "L-01-001"]


def test_norm_distance_characters_and_edges(spark):
    df = spark.createDataFrame([("ÑANDÚ", "NANDU"), ("", ""), (None, "A"), ("ABC", "ABC")],
                               "a string, b string")
    got = [r[0] for r in df.select(X.norm_distance("a", "b")).collect()]
    assert got == [0.4, 0.0, None, 0.0]


def test_threshold_boundaries(spark):
    # 1/5, 3/15 at 0.20 and 6/15 at 0.40 are all "close"; one more edit is not
    rows = [("ABCDE", "ABCDX", 0.20), ("ABCDEFGHIJKLMNO", "XXXDEFGHIJKLMNO", 0.20),
            ("ABCDEFGHIJKLMNO", "XXXXXXGHIJKLMNO", 0.40), ("ABCDE", "ABCXX", 0.20),
            ("ABCDEFGHIJKLMNO", "XXXXDEFGHIJKLMNO"[1:], 0.20)]
    for a, b, t in rows:
        df = spark.createDataFrame([(a, b)], "a string, b string")
        r = df.select(X.within_distance("a", "b", t).alias("w"),
                      (X.norm_distance("a", "b") <= t).alias("exact")).first()
        assert r["w"] == r["exact"], (a, b, t)


def test_parse_datetime_date_shape_guard(spark):
    vals = ["2020-01-05 00:00:00", "2020-1-5", "2020", "2020-01", "n/d", "2020-01-05T10:00:00Z", None,
            "2020-02-30 00:00:00"]
    got = one(spark, X.parse_datetime_date("x"), [(v,) for v in vals])
    assert got == [dt.date(2020, 1, 5), dt.date(2020, 1, 5), None, None, None, None, None, None]


def test_flags(spark):
    got = one(spark, X.flag_to_bool("x"), [("YES",), ("yes",), ("NO",), (None,)])
    assert got == [True, False, False, None]
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert [r[0] for r in df.select(X.bool_to_flag("b")).collect()] == ["YES", "NO", "NO"]


def test_date_text_and_location(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 7), -34.6144, -58.4464), (None, -54.0, None)],
                               "d date, la double, lo double")
    got = df.select(X.date_text_or_empty("d"), X.lat_long_text("la", "lo"), X.month_text("d"),
                    X.year_of("d")).collect()
    assert tuple(got[0]) == ("07-03-2024", "-34.6144,-58.4464", "03", 2024)
    assert tuple(got[1]) == ("", None, None, None)


PATTERN = N.name_pattern(["Roster"], ["Révisé", "final"], ".csv")


def test_file_names(spark):
    names = ["Roster 31_01_2026.csv", "Roster Révisé 30-11-2025.csv",
             "ROSTER RÉVISÉ FINAL 31_10_2025.CSV", "Roster 2025-10-31.csv",
             "Roster 31_02_2025.csv", "Roster 31_01_2026.txt",
             "notes 01_02_2024 and 03_04_2025.csv"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    got = df.select(N.is_valid_name("f", PATTERN).alias("v"), N.snapshot_date_of("f").alias("d"),
                    N.canonical_label(N.snapshot_date_of("f"), "entities_registry_", ".csv").alias("l")
                    ).collect()
    assert [r.v for r in got] == [True, True, True, False, True, False, False]
    assert [r.d for r in got] == [dt.date(2026, 1, 31), dt.date(2025, 11, 30), dt.date(2025, 10, 31),
                                  None, None, dt.date(2026, 1, 31), dt.date(2024, 2, 1)]
    assert got[0].l == "entities_registry_31_01_2026.csv" and got[3].l is None


def test_header_normalisation():
    assert N.normalise_header(" Fecha de Reconocimiento ") == "fecha_de_reconocimiento"
    assert N.normalise_header("N° X") == "n_x"
    assert N.normalise_header("Nº X") == "no_x"
    assert N.normalise_header("Línea\nDos") == "lineados"
    try:
        N.normalise_headers(["Año", "ano"])
        raise AssertionError("collision not detected")
    except ValueError:
        pass


def test_leaders_with_one_number_double_no_row(spark):
    from rollcall.operators.canonical import canonicalise_to_leader
    day = dt.date(2024, 1, 31)
    rows = [("NATIONAL", f"{i % 7:03d}", f"PARTY {i}", None, day) for i in range(40)] + \
        [("LOCAL", f"{i % 7:03d}", f"PARTY {i % 7}", True, day) for i in range(1200)] + \
        [("LOCAL", None, "NO NUMBER", True, day)] * 30
    df = spark.createDataFrame(rows, "entity_type string, entity_no string, entity_name string, is_member boolean, "
                                     "snapshot_date date")
    out = canonicalise_to_leader(df)
    assert out.count() == len(rows)
    leader = min(f"PARTY {i}" for i in range(40) if i % 7 == 3)
    got = {r.entity_name for r in out.where("entity_type = 'LOCAL' and entity_no = '003'").collect()}
    assert got == {leader}
