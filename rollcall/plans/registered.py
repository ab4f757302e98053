"""Spark side of every registered query: ``(spark, sf_dir) -> DataFrame``.

Each one reads the given tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import names as N
from rollcall.functions import text as X
from rollcall.operators import canonical as CA
from rollcall.operators import checks as K
from rollcall.operators import gaps as G
from rollcall.operators import history as H
from rollcall.operators import marts as M
from rollcall.operators.positions import with_positions
from rollcall.plans import close as CL
from rollcall.plans import derived as D
from rollcall.plans import ingest as I
from rollcall.plans import staging as S
from rollcall.sources import export as EX
from rollcall.sources import raw_store as R
from rollcall.sources.commit_log import BASENAME, load_name
from rollcall.session import materialize, scratch_path, small_table


def scd2_event_presence(spark: SparkSession, sf: str) -> DataFrame:
    daily = D.events_daily(spark, sf)
    return H.scd2_presence(daily, "user_id", "snapshot_date",
                           ["n_events", "last_event_type"])


REGISTRY = {
    "scd2_event_presence": scd2_event_presence,
}


def orders_monthly(spark: SparkSession, sf: str) -> DataFrame:
    o = D.table(spark, sf, "orders")
    return o.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                    F.trunc("o_orderdate", "month").alias("snapshot_date"))


ORDER_ATTRS = ["o_orderkey", "o_orderstatus", "o_totalprice"]


def scd2_order_presence(spark, sf):
    return H.scd2_presence(orders_monthly(spark, sf), "o_custkey", "snapshot_date",
                           ORDER_ATTRS, order_by=["o_orderdate", "o_orderkey"])


def events_with_customer(spark, sf):
    daily = D.events_daily(spark, sf)
    cust = D.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment", "c_nationkey",
        (F.col("c_acctbal") > 0).alias("has_credit"))
    return daily.join(cust, "user_id", "left")


def current_entities(spark, sf):
    panel = events_with_customer(spark, sf)
    hist = H.scd2_presence(panel, "user_id", "snapshot_date",
                           ["c_name", "c_mktsegment", "has_credit"])
    return H.current_view(hist, key="user_id", flag_col="has_credit")


def _movements(panel, key):
    """The calendar (one row per snapshot) is read several times and pinned."""
    cal = small_table(H.calendar(panel), "calendar")
    return H.movements(H.scd2_presence(panel, key, "snapshot_date", [], cal=cal), cal)


def movements_daily(spark, sf):
    return _movements(D.events_daily(spark, sf), "user_id")


def movements_monthly(spark, sf):
    return _movements(orders_monthly(spark, sf), "o_custkey")


def typed_daily(spark, sf):
    daily = D.events_daily(spark, sf)
    return daily.withColumn(
        "entity_type",
        F.when(F.col("user_id") % 5 == 0, F.lit("NATIONAL")).otherwise(F.lit("LOCAL")))


def snapshot_summary(spark, sf):
    return M.summary(typed_daily(spark, sf))


def panel_detail(spark, sf):
    p = events_with_customer(spark, sf).select(
        "user_id", "c_name", "snapshot_date",
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("region_code"))
    return M.panel(p, D.geo_lookup(spark, sf))


def calendar_index(spark, sf):
    return H.calendar(orders_monthly(spark, sf)).select("snapshot_date", "period")


REGISTRY.update({
    "scd2_order_presence": scd2_order_presence,
    "current_entities": current_entities,
    "movements_daily": movements_daily,
    "movements_monthly": movements_monthly,
    "snapshot_summary": snapshot_summary,
    "panel_detail": panel_detail,
    "calendar_index": calendar_index,
})


def valid_names(spark, sf):
    return D.file_names(spark, sf).select(
        "file_name", N.is_valid_name("file_name", D.NAME_PATTERN).alias("is_valid"))


def dates_from_names(spark, sf):
    return D.file_names(spark, sf).select(
        "file_name", N.snapshot_date_of("file_name").alias("snapshot_date"))


def canonical_labels(spark, sf):
    return D.file_names(spark, sf).select(
        "file_name", N.canonical_label(N.snapshot_date_of("file_name"), D.LABEL_PREFIX).alias("label"))


def ingest_plan(spark, sf):
    loaded = D.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("snapshot_date"))
    return I.plan_ingest(D.file_names(spark, sf), loaded, ext=".csv")


CUT_DATE = "2024-01-16"


def load_new_snapshots(spark, sf):
    daily = D.events_daily(spark, sf)
    store = daily.where(F.col("snapshot_date") < F.lit(CUT_DATE).cast("date"))
    return R.load_new(daily, R.loaded_dates_of(store))


REGISTRY.update({
    "valid_names": valid_names,
    "dates_from_names": dates_from_names,
    "canonical_labels": canonical_labels,
    "ingest_plan": ingest_plan,
    "load_new_snapshots": load_new_snapshots,
})


# ---- the derived registry ("reg") -------------------------------------------------

# numbers grow with the entities here: whole codes, else different ones share three digits
RULES = S.Rules(strict_codes=True)


def reg(spark, sf):
    return D.registry(spark, sf)


def raw_shape(spark, sf):
    r = reg(spark, sf)
    shaped = R.shape_values(r, S.RAW_COLUMNS)
    return shaped.select(*S.RAW_COLUMNS, "snapshot_date",
                         N.canonical_label("snapshot_date", D.LABEL_PREFIX, ".csv").alias("_source_file"))


def pad_codes(spark, sf):
    r = reg(spark, sf)
    return r.select("user_id", "snapshot_date", "region_code", "entity_no",
                    X.pad_code("region_code", 2).alias("region_code_padded"),
                    X.pad_code("entity_no", 3).alias("entity_no_padded"))


def clean_names(spark, sf):
    r = reg(spark, sf)
    return r.select("user_id", "snapshot_date",
                    X.clean_name("region_name").alias("region_name_clean"),
                    X.clean_name("entity_name").alias("entity_name_clean"))


def parse_recognition_dates(spark, sf):
    r = reg(spark, sf)
    return r.select("user_id", "snapshot_date", "recognised_on",
                    X.parse_datetime_date("recognised_on").alias("recognised_date"))


def flag_to_bool(spark, sf):
    r = reg(spark, sf)
    return r.select("user_id", "snapshot_date", "member_flag",
                    X.flag_to_bool("member_flag").alias("is_member"))


def bool_to_flag(spark, sf):
    r = reg(spark, sf)
    return r.select("user_id", "snapshot_date",
                    X.bool_to_flag(X.flag_to_bool("member_flag")).alias("member_text"))


def entity_keys(spark, sf):
    r = reg(spark, sf)
    return r.select("user_id", "snapshot_date",
                    X.entity_key("entity_type", X.pad_code("region_code", 2),
                                 X.pad_code("entity_no", 3)).alias("entity_key"))


NORM_OUT = ["entity_type", "region_code", "region_name", "entity_no", "entity_name", "snapshot_date"]


def region_corrections(spark, sf):
    n = S.normalise(reg(spark, sf), RULES)
    return S.correct(n, D.region_fixes(spark), None).select(*NORM_OUT)


def name_corrections(spark, sf):
    n = S.normalise(reg(spark, sf), RULES)
    return S.correct(n, D.region_fixes(spark), D.name_fixes(spark)).select(*NORM_OUT)


def canonical_regions(spark, sf):
    n = S.correct(S.normalise(reg(spark, sf), RULES), D.region_fixes(spark), D.name_fixes(spark))
    c = CA.canonicalise(n, D.region_lookup(spark, sf), on="region_code", value="region_name",
                        threshold=0.20, flag="needs_region_review", suggestion="suggested_region")
    return c.select(*NORM_OUT, "needs_region_review", "suggested_region")


def name_similarity(spark, sf):
    c = D.table(spark, sf, "customer").select("c_custkey", "c_name")
    s = D.table(spark, sf, "supplier").select("s_suppkey", "s_name")
    n = s.agg(F.max("s_suppkey")).first()[0] or 1        # every customer meets a supplier
    j = c.join(s, (c.c_custkey - 1) % n + 1 == s.s_suppkey)
    return j.select("c_custkey", "c_name", "s_name",
                    X.norm_distance("c_name", "s_name").alias("distance"),
                    X.within_distance("c_name", "s_name", 0.40).alias("is_close"))


def backfill_numbers(spark, sf):
    n = S.correct(S.normalise(reg(spark, sf), RULES), D.region_fixes(spark), D.name_fixes(spark))
    return G.backfill(n, "entity_no", ["region_code", "entity_name"], "snapshot_date",
                      ["entity_type"]).select(*NORM_OUT)


def stored_reg(spark, sf):
    """The derived registry written once, in the role of the raw store table
    (the staging chain scans its input twice)."""
    return materialize(reg(spark, sf), "registry")


def staged(spark, sf):
    return S.stage(stored_reg(spark, sf), D.region_lookup(spark, sf), D.region_fixes(spark),
                   D.name_fixes(spark), RULES)


def clean_registry(spark, sf):
    return S.clean(staged(spark, sf))


def clean_table(spark, sf):
    """The clean panel written once: every mart and check reads it."""
    return materialize(clean_registry(spark, sf), "clean")


def registry_history(spark, sf):
    return S.history(clean_table(spark, sf))


def registry_current(spark, sf):
    return H.current_view(registry_history(spark, sf), key="entity_key", flag_col="is_member")


def registry_movements(spark, sf):
    c = clean_table(spark, sf)
    cal = small_table(H.calendar(c), "calendar")
    return H.movements(S.history(c, cal), cal)


def registry_summary(spark, sf):
    return M.summary(clean_registry(spark, sf))          # one read: no need to write it


def registry_panel(spark, sf):
    return M.panel(clean_table(spark, sf).select(*S.PANEL_COLUMNS), D.geo_lookup(spark, sf))


def export_publication(spark, sf):
    return EX.publication_frame(registry_current(spark, sf))


REGISTRY.update({
    "raw_shape": raw_shape,
    "pad_codes": pad_codes,
    "clean_names": clean_names,
    "parse_recognition_dates": parse_recognition_dates,
    "flag_to_bool": flag_to_bool,
    "bool_to_flag": bool_to_flag,
    "entity_keys": entity_keys,
    "region_corrections": region_corrections,
    "name_corrections": name_corrections,
    "canonical_regions": canonical_regions,
    "name_similarity": name_similarity,
    "backfill_numbers": backfill_numbers,
    "canonical_to_leader": clean_registry,
    "staged_registry": staged,
    "registry_history": registry_history,
    "registry_current": registry_current,
    "registry_movements": registry_movements,
    "registry_summary": registry_summary,
    "registry_panel": registry_panel,
    "export_publication": export_publication,
})


# ---- data checks ----------------------------------------------------------------------

def check_not_null(spark, sf):
    return K.check_not_null(S.normalise(reg(spark, sf), RULES), "entity_no")


def check_unique(spark, sf):
    return K.check_unique(S.normalise(reg(spark, sf), RULES), "region_code")


def check_accepted_values(spark, sf):
    return K.check_accepted(S.normalise(reg(spark, sf), RULES), "region_name", D.OFFICIAL_REGIONS)


def check_snapshot_key(spark, sf):
    # error events carry no key here, so NULL keys repeat and must be reported
    ev = D.table(spark, sf, "events").select(F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"),
                                             F.to_date("ts").alias("snapshot_date"))
    return K.check_unique(ev, ["user_id", "snapshot_date"], nulls_count=True)


def _order_history(spark, sf):
    return H.scd2_presence(orders_monthly(spark, sf), "o_custkey", "snapshot_date", [],
                           order_by=["o_orderdate", "o_orderkey"])


def check_interval(spark, sf):
    h = _order_history(spark, sf)
    swap = F.col("valid_from") < F.col("valid_to")
    bad = h.select("o_custkey",
                   F.when(swap, F.col("valid_to")).otherwise(F.col("valid_from")).alias("valid_from"),
                   F.when(swap, F.col("valid_from")).otherwise(F.col("valid_to")).alias("valid_to"))
    return K.check_interval(bad, key="o_custkey")


def check_history_grain(spark, sf):
    h = materialize(_order_history(spark, sf), "history")     # read by both union branches
    return K.check_unique(h.unionByName(h.where("is_current")), ["o_custkey", "valid_from"], nulls_count=True)


def check_single_current(spark, sf):
    h = _order_history(spark, sf).withColumn("is_current", F.lit(True))
    return K.check_single_current(h, key="o_custkey")


def check_overlap(spark, sf):
    li = D.table(spark, sf, "lineitem")
    start = F.to_date("l_shipdate")
    iv = li.select("l_partkey", start.alias("valid_from"),
                   F.date_add(start, F.col("l_quantity").cast("int")).alias("valid_to"))
    return K.check_no_overlap(iv, key="l_partkey")


def warn_regions(spark, sf):
    return K.warn_regions(staged(spark, sf))


def warn_names(spark, sf):
    return K.warn_names(clean_registry(spark, sf))


def registry_checks(st, cl, hist):
    return CL.registry_checks(st, cl, hist)


def check_report(spark, sf):
    st = staged(spark, sf)
    cl = materialize(S.clean(st), "clean")
    hist = materialize(S.history(cl), "history")
    seeds = CL.seed_checks(D.region_lookup(spark, sf), D.region_fixes(spark), D.name_fixes(spark))
    return K.run_checks(seeds + registry_checks(st, cl, hist))


REGISTRY.update({
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_accepted_values": check_accepted_values,
    "check_snapshot_key": check_snapshot_key,
    "check_interval": check_interval,
    "check_history_grain": check_history_grain,
    "check_single_current": check_single_current,
    "check_overlap": check_overlap,
    "warn_regions": warn_regions,
    "warn_names": warn_names,
    "check_report": check_report,
})


# ---- file round trips -------------------------------------------

def raw_row_numbers(spark, sf):
    """Land every registry snapshot as CSV under its standard name, read the
    files back (header-safe), shape them and number rows in file order."""
    r = reg(spark, sf)
    landing = scratch_path(spark, "landing")
    R.land_snapshots(r, landing, D.LABEL_PREFIX, ".csv", data_cols=S.RAW_COLUMNS, order_by=S.RAW_COLUMNS)
    raw = R.shape_raw(R.read_snapshots(spark, landing))
    return raw.select(*S.RAW_COLUMNS, "snapshot_date", "_source_file", "_row_number")


def schema_evolution(spark, sf):
    """Two appends to the raw store, the later one with an extra column; read
    back with additive schema merge (earlier rows get NULL)."""
    r = reg(spark, sf)
    store = scratch_path(spark, "raw")
    cut = F.lit(CUT_DATE).cast("date")
    first = r.where(F.col("snapshot_date") < cut).select(*S.RAW_COLUMNS, "snapshot_date")
    later = r.where(F.col("snapshot_date") >= cut).select(
        *S.RAW_COLUMNS, "snapshot_date",
        F.concat(F.lit("CASE-"), F.col("event_id").cast("string")).alias("case_ref"))
    R.append_new(spark, first, store)
    R.append_new(spark, later, store)
    R.append_new(spark, later, store)   # rerun: nothing new is written
    return R.read_raw(spark, store)


def ingest_round_trip(spark, sf):
    """Two landings and loads of the registry with what broken-off runs leave behind in
    between: part files of a snapshot that was not landed to the end, and a date
    folder in the store that no load committed. Neither is read; the next run lands
    and loads the snapshot whole."""
    r = reg(spark, sf)
    landing, store = scratch_path(spark, "landing"), scratch_path(spark, "raw")
    cut = F.lit(CUT_DATE).cast("date")
    later = r.where(F.col("snapshot_date") >= cut)

    def land(rows):
        R.land_snapshots(rows, landing, D.LABEL_PREFIX, ".csv", data_cols=S.RAW_COLUMNS, order_by=S.RAW_COLUMNS)

    land(r.where(F.col("snapshot_date") < cut))
    I.load_landing(spark, landing, store)
    half = later.where("event_id % 2 = 0")
    half.select(*S.RAW_COLUMNS, N.canonical_label("snapshot_date", D.LABEL_PREFIX, ".csv").alias("snapshot")) \
        .write.mode("append").option("header", True).option(BASENAME, load_name()).partitionBy("snapshot").csv(landing)
    R.conform(half.select(*S.RAW_COLUMNS, "snapshot_date")) \
        .write.mode("append").option(BASENAME, load_name()).partitionBy("snapshot_date").parquet(store)
    I.load_landing(spark, landing, store)             # nothing is landed to the end that is not loaded
    land(r)
    I.load_landing(spark, landing, store)
    return R.read_raw(spark, store).select(*S.RAW_COLUMNS, "snapshot_date", "_source_file", "_row_number")


def backfill_scan(spark, sf):
    """The backfill as a segmented scan over order lines: of each part of the year (four
    groups, none smaller than a fifth of all rows), in order of ship date, order and line."""
    li = D.table(spark, sf, "lineitem").select(
        (F.month(F.to_date("l_shipdate")) % 4).alias("season"), F.to_date("l_shipdate").alias("shipped"), "l_orderkey",
        "l_linenumber", F.when(F.col("l_partkey") % 5 != 0, F.col("l_suppkey")).alias("supplier"))
    return G.backfill(li, "supplier", ["season"], "shipped", ["l_orderkey", "l_linenumber"], scan=True)


def publication_order(spark, sf):
    """Each published row's place in the publication's order: by region, type and number (O2)."""
    current = with_positions(registry_current(spark, sf), [*S.PUBLICATION_ORDER, "entity_id"])
    return current.select("position", *S.PUBLICATION_ORDER, "entity_id")


def file_order(spark, sf):
    """Each file's place in loading order: by date, undated ones last, equal dates by name (O3)."""
    return with_positions(dates_from_names(spark, sf), [F.col("snapshot_date").asc_nulls_last(), "file_name"])


REGISTRY.update({
    "file_order": file_order,
    "publication_order": publication_order,
    "backfill_scan": backfill_scan,
    "ingest_round_trip": ingest_round_trip,
    "raw_row_numbers": raw_row_numbers,
    "schema_evolution": schema_evolution,
})
