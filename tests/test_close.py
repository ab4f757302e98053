import os

import pytest
from pyspark.sql import functions as F

from rollcall.plans import derived as D
from rollcall.plans import staging as S
from rollcall.plans.close import monthly_close
from rollcall.sources import raw_store as R

SF = "/root/testdata/sf0.001"


def test_monthly_close_end_to_end_and_rerun(spark, tmp_dir):
    reg = D.registry(spark, SF)
    landing, store, marts = f"{tmp_dir}/landing", f"{tmp_dir}/store", f"{tmp_dir}/marts"
    first = reg.where(F.col("snapshot_date") < F.lit("2024-01-20").cast("date"))
    R.land_snapshots(first, landing, D.LABEL_PREFIX, ".csv", data_cols=S.RAW_COLUMNS)
    kw = dict(region_lookup=D.region_lookup(spark, SF), region_fixes=D.region_fixes(spark),
              name_fixes=D.name_fixes(spark), geo=D.geo_lookup(spark, SF))
    # the derived registry holds entities whose number is never known: the gate stops
    with pytest.raises(RuntimeError, match="stg_number_not_null"):
        monthly_close(spark, landing, store, marts, **kw)
    assert R.read_raw(spark, store).count() == first.count()      # the raw load is kept
    assert not os.path.exists(marts)                               # nothing published

    res = monthly_close(spark, landing, store, marts, publish_dir=f"{tmp_dir}/pub",
                        stop_on_error=False, **kw)
    assert res.rows_loaded == 0 and res.plan.get("SKIP", 0) > 0
    status = {c["check"]: c["status"] for c in res.checks}
    assert status["hist_no_overlap"] == "PASS" and status["stg_number_not_null"] == "FAIL"
    assert set(res.marts) == {"history", "current", "movements", "panel", "summary"}
    assert res.publication and os.path.isdir(res.publication)

    # next month: the rest lands; what was loaded is not loaded again
    R.land_snapshots(reg.where(F.col("snapshot_date") >= F.lit("2024-01-20").cast("date")), landing,
                     D.LABEL_PREFIX, ".csv", data_cols=S.RAW_COLUMNS)
    res2 = monthly_close(spark, landing, store, marts, stop_on_error=False, **kw)
    assert res2.rows_loaded == reg.count() - first.count()
    assert R.read_raw(spark, store).count() == reg.count()
    res3 = monthly_close(spark, landing, store, marts, stop_on_error=False, **kw)
    assert res3.rows_loaded == 0 and res3.plan.get("LOAD", 0) == 0
    assert spark.read.parquet(res3.marts["history"]).where("is_current").count() > 0


def test_command_line(spark, tmp_dir, capsys):
    import json
    from rollcall.__main__ import main
    reg = D.registry(spark, SF)
    landing, store = f"{tmp_dir}/landing", f"{tmp_dir}/store"
    R.land_snapshots(reg, landing, D.LABEL_PREFIX, ".csv", data_cols=S.RAW_COLUMNS)
    with open(f"{tmp_dir}/regions.csv", "w") as f:
        f.write("region_code,region_name,latitude,longitude\n00,AFRICA,-1.5,20.25\n01,AMERICA,,\n"
                "02,ASIA,30.0,100.0\n03,EUROPE,50.0,10.0\n04,MIDDLE EAST,25.0,45.0\n")
    with open(f"{tmp_dir}/name_fixes.csv", "w") as f:
        f.write("snapshot_date,entity_type,region_code,entity_no,entity_name_fixed\n,NATIONAL,00,002,X\n")
    main(["plan", "--landing", landing, "--store", store])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["files"] == {"LOAD": 30}
    main(["close", "--landing", landing, "--store", store, "--marts", f"{tmp_dir}/marts",
          "--publish", f"{tmp_dir}/pub", "--regions", f"{tmp_dir}/regions.csv",
          "--name-fixes", f"{tmp_dir}/name_fixes.csv", "--warn-only"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["rows_loaded"] == reg.count() and out["publication"]
    assert {c["check"] for c in out["checks"]} >= {"hist_no_overlap", "warn_names"}
    main(["ingest", "--landing", landing, "--store", store])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["rows_loaded"] == 0
