import duckdb

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "orders", "lineitem", "events"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["user_id", "n_events", "last_event_type", "valid_from", "valid_to", "is_current"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    missing = set(E.queries()) - set(E.oracle_sql())
    assert not [q for q in missing if q != "pipeline" and not q.startswith("op")]


def test_sample_queries_match_oracle_at_smallest_scale(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ["registry_history", "registry_movements", "ingest_plan", "check_overlap", "check_report"]:
        df = E.queries()[name](spark, SF)
        res = con.execute(E.oracle_sql()[name])
        cols = [d[0] for d in res.description]
        assert sorted(cols) == sorted(df.columns), name
        norm = lambda cs, rows: sorted(tuple(str(r[cs.index(c)]) for c in sorted(cs)) for r in rows)
        assert norm(df.columns, [tuple(r) for r in df.collect()]) == norm(cols, res.fetchall()), name
