import datetime as dt
import os

from pyspark.sql import functions as F

from rollcall.functions.names import name_pattern
from rollcall.plans import ingest as I
from rollcall.sources import raw_store as R
from rollcall.streaming.landing import stream_new_snapshots


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_plan_first_file_wins_and_loaded_skips(spark):
    files = spark.createDataFrame([
        ("Entities Registry at 31_01_2026.csv",), ("ENTITIES REGISTRY AT 31-01-2026.CSV",),
        ("Entities Registry at 28_02_2026.csv",), ("Entities Registry at 31_02_2026.csv",),
        ("Entities Registry at 31_03_2026.txt",), ("random.csv",)], "file_name string")
    loaded = spark.createDataFrame([(dt.date(2026, 2, 28),)], "snapshot_date date")
    got = {r.file_name: r.status for r in I.plan_ingest(files, loaded).collect()}
    assert got == {"ENTITIES REGISTRY AT 31-01-2026.CSV": "LOAD",   # sorts first by name
                   "Entities Registry at 31_01_2026.csv": "SKIP",
                   "Entities Registry at 28_02_2026.csv": "SKIP",
                   "Entities Registry at 31_02_2026.csv": "IGNORED",
                   "Entities Registry at 31_03_2026.txt": "IGNORED",
                   "random.csv": "IGNORED"}
    counts = {r.status: r.files for r in I.run_counters(I.plan_ingest(files, loaded)).collect()}
    assert counts == {"LOAD": 1, "SKIP": 2, "IGNORED": 3}


def test_header_drift_is_read_by_name(spark, tmp_dir):
    write(f"{tmp_dir}/in/Entities Registry at 31_01_2026.csv",
          "Entity Type,Region Code,Entity Name\nLOCAL,2,  Alpha \nNATIONAL,1,Beta\n")
    write(f"{tmp_dir}/in/Entities Registry at 28_02_2026.csv",
          "Region Code,Entity Type,Case Ref,Entity Name\n3,LOCAL,X-1,Gamma \n")
    raw = R.shape_raw(R.read_snapshots(spark, f"{tmp_dir}/in"))
    got = sorted((r.snapshot_date, r.entity_type, r.region_code, r.entity_name, r.case_ref, r._row_number)
                 for r in raw.collect())
    assert got == [(dt.date(2026, 1, 31), "LOCAL", "2", "Alpha", "", 1),
                   (dt.date(2026, 1, 31), "NATIONAL", "1", "Beta", "", 2),
                   (dt.date(2026, 2, 28), "LOCAL", "3", "Gamma", "X-1", 1)]
    assert {r._source_file for r in raw.collect()} == {"Entities Registry at 31_01_2026.csv",
                                                       "Entities Registry at 28_02_2026.csv"}


def test_row_numbers_follow_file_order_across_splits(spark, tmp_dir):
    n = 4000
    body = "\n".join(f"{i},name {i:05d}" for i in range(n))
    write(f"{tmp_dir}/big/Entities Registry at 31_01_2026.csv", "seq,entity_name\n" + body + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        raw = R.shape_raw(R.read_snapshots(spark, f"{tmp_dir}/big"))
        assert raw.select("_block").distinct().count() if "_block" in raw.columns else True
        bad = raw.where(F.col("_row_number") != F.col("seq").cast("long") + 1).count()
        assert raw.count() == n and bad == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_raw_store_idempotent_and_schema_evolution(spark, tmp_dir):
    store = f"{tmp_dir}/raw"
    a = spark.createDataFrame([("LOCAL", "ASIA", dt.date(2024, 1, 31))],
                              "entity_type string, region_name string, snapshot_date date")
    b = spark.createDataFrame([("LOCAL", "ASIA", "X", dt.date(2024, 2, 29)), ("LOCAL", "ASIA", "Y", dt.date(2024, 1, 31))],
                              "entity_type string, region_name string, extra string, snapshot_date date")
    assert R.loaded_dates(spark, store).count() == 0
    assert R.append_new(spark, a, store) == 1
    assert R.append_new(spark, b, store) == 1          # only 2024-02-29 is new
    assert R.append_new(spark, b, store) == 0          # rerun: nothing new
    raw = R.read_raw(spark, store)
    got = sorted((r.snapshot_date, r.extra) for r in raw.collect())
    assert got == [(dt.date(2024, 1, 31), None), (dt.date(2024, 2, 29), "X")]
    R.replace_snapshot(b.where("extra = 'Y'"), store)
    got = sorted((r.snapshot_date, r.extra) for r in R.read_raw(spark, store).collect())
    assert got == [(dt.date(2024, 1, 31), "Y"), (dt.date(2024, 2, 29), "X")]


def test_list_snapshots_and_seed(spark, tmp_dir):
    write(f"{tmp_dir}/l/Entities Registry at 31_01_2026.csv", "a\n1\n")
    write(f"{tmp_dir}/l/Entities Registry at 31_01_2026.txt", "a\n1\n")
    write(f"{tmp_dir}/l/other.csv", "a\n1\n")
    pattern = name_pattern(["Entities", "Registry", "at"])
    got = [(r.file_name, r.is_valid) for r in R.list_snapshots(spark, f"{tmp_dir}/l", pattern, ext=".csv").collect()]
    assert got == [("Entities Registry at 31_01_2026.csv", True), ("other.csv", False)]
    write(f"{tmp_dir}/seed.csv", "snapshot_date,code,value\n,01,X\n2024-01-31,02,Y\n")
    seed = R.read_seed(spark, f"{tmp_dir}/seed.csv", "snapshot_date date, code string, value string")
    assert [tuple(r) for r in seed.collect()] == [(None, "01", "X"), (dt.date(2024, 1, 31), "02", "Y")]


def test_stream_loads_only_new_dates(spark, tmp_dir):
    land, store, ck = f"{tmp_dir}/landing", f"{tmp_dir}/store", f"{tmp_dir}/ck"
    write(f"{land}/Entities Registry at 31_01_2026.csv", "entity_type,region_name\nLOCAL,ASIA\nLOCAL,EUROPE\n")
    stream_new_snapshots(spark, land, store, ck).awaitTermination()
    assert R.read_raw(spark, store).count() == 2
    write(f"{land}/Entities Registry at 28_02_2026.csv", "entity_type,region_name\nNATIONAL,ASIA\n")
    write(f"{land}/ENTITIES REGISTRY AT 31-01-2026.CSV", "entity_type,region_name\nLOCAL,AFRICA\n")
    stream_new_snapshots(spark, land, store, ck).awaitTermination()
    raw = R.read_raw(spark, store)
    assert sorted((str(r.snapshot_date), r.region_name) for r in raw.collect()) == \
        [("2026-01-31", "ASIA"), ("2026-01-31", "EUROPE"), ("2026-02-28", "ASIA")]
    stream_new_snapshots(spark, land, store, ck).awaitTermination()     # nothing new
    assert R.read_raw(spark, store).count() == 3


def test_export_current_sorted_named_by_latest(spark, tmp_dir):
    import glob
    from rollcall.sources.export import export_current
    cur = spark.createDataFrame([
        ("L-02-001", "LOCAL", "02", "ASIA", "001", "B", "P1", dt.date(1990, 1, 2), "YES", dt.date(2024, 3, 31)),
        ("N-01-001", "NATIONAL", "01", "AMERICA", "001", "A", None, None, "NO", dt.date(2024, 3, 31)),
        ("L-01-002", "LOCAL", "01", "AMERICA", "002", "C", "P2", None, "YES", dt.date(2024, 3, 31))],
        "entity_id string, entity_type string, region_code string, region_name string, entity_no string, "
        "entity_name string, acronym string, recognised_on date, is_member string, updated date")
    target = export_current(cur, tmp_dir + "/out", order=["region_code", "entity_type", "entity_no"])
    assert target.endswith("entities_current_31_03_2024")
    parts = sorted(glob.glob(target + "/part-*.csv"))
    rows = [line for p in parts for line in open(p).read().splitlines()[1:]]
    assert [r.split(",")[0] for r in rows] == ["L-01-002", "N-01-001", "L-02-001"]
    assert export_current.last_rows == 3
    assert rows[2].split(",")[7] == "02-01-1990" and rows[0].split(",")[7] == ""
    assert export_current(cur.where("false"), tmp_dir + "/none") is None


def test_na_values_option_and_json_snapshots(spark, tmp_dir):
    write(f"{tmp_dir}/na/Entities Registry at 31_01_2026.csv", "acronym,entity_name\nNA,N/A\n")
    raw = R.read_snapshots(spark, f"{tmp_dir}/na")
    assert [(r.acronym, r.entity_name) for r in R.shape_raw(raw).collect()] == [("NA", "N/A")]
    got = R.shape_raw(raw, na_values=R.PANDAS_NA_VALUES).collect()
    assert [(r.acronym, r.entity_name) for r in got] == [("", "")]
    write(f"{tmp_dir}/js/Entities Registry at 28_02_2026.json", '{"Entity Name": "A", "N": 2}\n')
    js = R.shape_raw(R.read_snapshots(spark, f"{tmp_dir}/js", fmt="json"))
    assert [(r.entity_name, r.n, str(r.snapshot_date)) for r in js.collect()] == [("A", "2", "2026-02-28")]


def test_raw_schema_store_namespace_and_materialise(spark, tmp_dir):
    from pyspark.sql import types as T
    sch = R.raw_schema(["entity_name", "snapshot_date", "_source_file", "_ingested_at", "_row_number"])
    assert [(f.name, f.dataType, f.nullable) for f in sch.fields] == [
        ("entity_name", T.StringType(), True), ("snapshot_date", T.DateType(), False),
        ("_source_file", T.StringType(), True), ("_ingested_at", T.TimestampType(), True),
        ("_row_number", T.LongType(), True)]
    R.ensure_store(spark, "rollcall_test_store")
    R.ensure_store(spark, "rollcall_test_store")          # idempotent
    assert spark.catalog.databaseExists("rollcall_test_store")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    view = R.materialise(df, "layer_view")
    assert view is df and spark.table("layer_view").count() == 1
    table = R.materialise(df, "layer_table", kind="table", path=f"{tmp_dir}/layer_table")
    assert table.collect()[0].v == "a" and spark.table("layer_table").count() == 1
    assert R.select_known(df, ["v", "missing"]).columns == ["v", "missing"]
