"""Plan-shape regression tests: the scale properties the README claims."""

import datetime as dt
import re

import pytest

import __spark_entry__ as E
from rollcall.operators import checks as K
from rollcall.operators import history as H
from rollcall.sources import raw_store as R

SF = "/root/testdata/sf0.001"


def physical(df, spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_scd2_one_exchange_on_the_key_after_reduce(spark):
    p = spark.read.parquet(f"{SF}/events.parquet").selectExpr("user_id", "to_date(ts) AS snapshot_date",
                                                              "event_type")
    cal = spark.createDataFrame([(dt.date(2024, 1, d), d, d == 30) for d in range(1, 31)],
                                "snapshot_date date, period bigint, is_last boolean")
    plan = physical(H.scd2_presence(p, "user_id", "snapshot_date", ["event_type"], cal=cal), spark)
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    # one exchange for the per-snapshot reduce (key, date), one on the key for the
    # window; the version groupBy(key, island) adds none
    assert len(shuffles) == 2, shuffles
    assert [s for s in shuffles if "snapshot_date" not in s]
    # the (key, date) reduce has a partial aggregate below its exchange (map-side combine)
    reduce_at = plan.index("Exchange hashpartitioning(user_id")
    ex_date = re.search(r"Exchange hashpartitioning\(user_id#\d+L, snapshot_date", plan)
    assert ex_date and "partial_max(struct" in plan[ex_date.end():]
    assert reduce_at >= 0


def test_overlap_check_builds_no_pairs(spark):
    plan = physical(E.queries()["check_overlap"](spark, SF), spark)
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "partial_max" in plan
    scans = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert scans and all("l_extendedprice" not in x and "l_orderkey" not in x for x in scans)


def test_raw_store_prunes_partitions_and_columns(spark, tmp_dir):
    df = spark.createDataFrame([("LOCAL", "ASIA", "x", dt.date(2024, 1, d)) for d in range(1, 4)],
                               "entity_type string, region_name string, other string, snapshot_date date")
    R.write_raw(df, f"{tmp_dir}/raw")
    q = R.read_raw(spark, f"{tmp_dir}/raw").where("snapshot_date = DATE'2024-01-02'").select("region_name")
    text = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in text
    assert re.search(r"ReadSchema: struct<region_name:string>", text)
    assert q.count() == 1


@pytest.mark.parametrize("name", ["scd2_event_presence", "registry_history", "check_report"])
def test_no_cross_or_nested_loop_joins(spark, name):
    plan = physical(E.queries()[name](spark, SF), spark)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_checks_count_with_partial_aggregation(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").selectExpr("user_id", "to_date(ts) AS d")
    plan = physical(K.check_unique(ev, ["user_id", "d"]), spark)
    assert "partial_count" in plan


def test_small_table_is_bounded(spark):
    from rollcall.session import small_table
    local = small_table(spark.range(10), max_rows=50)
    local_plan = local._jdf.queryExecution().executedPlan().toString()
    assert local.count() == 10 and "FileScan" not in local_plan and "Range" not in local_plan
    written = small_table(spark.range(10), max_rows=5)      # over the bound: a written table instead
    plan = written._jdf.queryExecution().executedPlan().toString()
    assert written.count() == 10 and "FileScan parquet" in plan


def test_seed_joins_broadcast_and_numbered_rows_not_shuffled(spark):
    df = E.queries()["backfill_numbers"](spark, SF)
    plan = re.sub(r"#\d+L?", "", physical(df, spark))
    # the correction joins broadcast their seeds (no shuffle of the registry); the backfill
    # reads its input for the rows with a number, those without and the summary
    assert len(re.findall(r"BroadcastHashJoin \[entity_type, region_code, entity_no", plan)) == 9
    assert not re.search(r"SortMergeJoin \[entity_type", plan)
    tree = [ln for ln in plan.split("\n") if ln.strip()]
    depth = [len(re.match(r"[ :+\-]*", ln)[0]) for ln in tree]
    union = next(i for i, ln in enumerate(tree) if re.match(r"[ :+\-]*(\(\d+\) )?\*?(\(\d+\) )?Union", ln))
    children = [i for i in range(union + 1, len(tree)) if depth[i] == depth[union + 1]]
    numbered, looked_up = "\n".join(tree[children[0]:children[1]]), "\n".join(tree[children[1]:])
    source = re.escape("Exchange hashpartitioning(_k")
    assert "Window" not in numbered and not re.search(source, numbered)
    # windows run over the summary alone, which is aggregated before its shuffle
    under = [next(ln for ln in tree[i + 1:] if not re.search(r"Window|Sort \[|Exchange|Project|ShuffleQueryStage|AQEShuffleRead", ln))
             for i, ln in enumerate(tree) if re.search(r"\bWindow \[", ln)]
    assert "Window" in looked_up and under and all("Aggregate" in ln for ln in under)


def test_panel_is_not_shuffled_on_the_date(spark):
    from rollcall.operators import marts as M
    p = spark.read.parquet(f"{SF}/events.parquet").selectExpr("user_id", "to_date(ts) AS snapshot_date",
                                                              "'01' AS region_code")
    geo = spark.createDataFrame([("01", 1.5, 2.5)], "region_code string, latitude double, longitude double")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(M.panel(p, geo), spark)
        # the one exchange on the date is that of the calendar, below its partial aggregate
        assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1
        assert "SortMergeJoin" not in physical(H.scd2_presence(p, "user_id", "snapshot_date", ["region_code"]), spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["movements_monthly", "raw_row_numbers"])
def test_bounded_sides_are_broadcast(spark, name):
    assert "SortMergeJoin" not in physical(E.queries()[name](spark, SF), spark)
