"""Inputs derived by Spark from the given tables (`FIXTURES.md` §2-§3).

The registry ("reg") stands in for a series of full monthly snapshots: one
row per (user, day) of ``events``; every noisy spelling is a pure function of
``event_id``, so the same table can be written in plain SQL for the oracle.
The work grows with ``events`` / ``orders``: nothing here is a fixed input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.names import name_pattern

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (user, day): last event of the day and the day's count."""
    ev = table(spark, sf_dir, "events")
    return (ev.groupBy("user_id", F.to_date("ts").alias("snapshot_date"))
            .agg(F.max("event_id").alias("event_id"),
                 F.count(F.lit(1)).alias("n_events"),
                 F.max_by("event_type", "event_id").alias("last_event_type")))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived registry, all data columns as text (raw snapshot shape)."""
    daily = (table(spark, sf_dir, "events")
             .groupBy("user_id", F.to_date("ts").alias("snapshot_date"))
             .agg(F.max("event_id").alias("event_id")))
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    u, e = F.col("user_id"), F.col("event_id")
    code = u % 5
    g = F.floor(u / 5).cast("bigint")
    d = daily.withColumn("code", code).withColumn("g", g)
    # one customer lookup: code 4 names use the user's own segment, the
    # others the leader's (user_id - code)
    seg_key = F.when(d.code == 4, d.user_id).otherwise(d.user_id - d.code)
    d = (d.join(region, d.code == region.r_regionkey, "left")
          .join(cust, seg_key == cust.c_custkey, "left"))
    code_s, g_s = F.col("code").cast("string"), F.col("g").cast("string")
    r_name = F.col("r_name")
    region_code = (
        F.when((u == 7) & (F.col("snapshot_date") <= F.lit("2024-01-05").cast("date")), F.lit("9"))
        .when(e % 3 == 0, code_s)
        .when(e % 3 == 1, F.concat(F.lit("0"), code_s))
        .otherwise(F.concat(code_s, F.lit(".0"))))
    region_name = (
        F.when(e % 29 == 0, F.lit("UNKNOWN PLACE"))
        .when(e % 11 == 0, F.expr("substring(r_name, 1, length(r_name) - 1)"))
        .when(e % 7 == 0, F.concat(F.lit("  "), F.lower(r_name), F.lit("  ")))
        .otherwise(r_name))
    entity_no = (
        F.when(e % 13 == 0, F.lit(""))
        .when(e % 3 == 0, g_s)
        .when(e % 3 == 1, F.lpad(g_s, 3, "0"))
        .otherwise(F.concat(g_s, F.lit(".0"))))
    entity_name = (
        F.when(F.col("code") <= 2,
               F.concat(F.lit("Party  "), F.col("c_mktsegment"), F.lit(" "), g_s))
        .when(F.col("code") == 3,
              F.concat(F.lit("PARTY "), F.col("c_mktsegment"), F.lit(" "), g_s, F.lit(" SUR")))
        .otherwise(F.concat(F.col("c_mktsegment"), F.lit(" UNION "), u.cast("string"))))
    member_flag = F.when((F.col("code") == 0) | (u % 10 == 6), F.lit("NO")).otherwise(F.lit("YES"))
    recognised_on = F.when(u % 23 == 0, F.lit("n/d")).otherwise(
        F.concat(F.date_add(F.lit("1990-01-01").cast("date"), u.cast("int")).cast("string"),
                 F.lit(" 00:00:00")))
    return d.select(
        F.when(F.col("code") == 0, F.lit("NATIONAL")).otherwise(F.lit("LOCAL")).alias("entity_type"),
        region_code.alias("region_code"),
        region_name.alias("region_name"),
        entity_no.alias("entity_no"),
        entity_name.alias("entity_name"),
        F.concat(F.lit("P"), g_s).alias("acronym"),
        recognised_on.alias("recognised_on"),
        member_flag.alias("member_flag"),
        F.col("snapshot_date"),
        F.col("user_id"),
        F.col("event_id"),
    )


def region_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Official region names by two-digit code (the role of the official-region seed)."""
    r = table(spark, sf_dir, "region")
    return r.select(F.lpad(F.col("r_regionkey").cast("string"), 2, "0").alias("region_code"),
                    F.col("r_name").alias("region_name"))


def geo_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates per two-digit code, derived from ``nation`` by a rule."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("region_code"),
        (F.lit(-20.25) - F.col("n_nationkey").cast("double") * 1.5).alias("latitude"),
        (F.lit(-70.5) + F.col("n_regionkey").cast("double") * 2.75).alias("longitude"))


# The file-name convention of the derived listing: a word, up to two optional
# words, the date.
WORD, EXTRA_WORDS = "Roster", ["Révisé", "final"]
NAME_PATTERN = name_pattern([WORD], EXTRA_WORDS, ".csv")
LABEL_PREFIX = "entities_registry_"


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One candidate file name per order (distinct), variant by o_orderkey % 6:
    0 plain with `_`; 1 one optional word and `-`; 2 both, all capitals; 3 ISO
    date; 4 impossible date; 5 wrong extension."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))

    def named(words: list[str], date_format: str, ext: str = ".csv"):
        return F.concat(F.lit(" ".join(words) + " "), F.date_format("d", date_format), F.lit(ext))

    variants = [named([WORD], "dd_MM_yyyy"), named([WORD, EXTRA_WORDS[0]], "dd-MM-yyyy"),
                F.upper(named([WORD, *EXTRA_WORDS], "dd_MM_yyyy")), named([WORD], "yyyy-MM-dd"),
                named([WORD], "'31_02_'yyyy"), named([WORD], "dd_MM_yyyy", ".txt")]
    v = F.col("o_orderkey") % len(variants)
    return o.select(F.coalesce(*[F.when(v == k, x) for k, x in enumerate(variants)]).alias("file_name")).distinct()


# The inline correction seeds of the derived registry. User 7's
# region code is wrong ('9') up to 2024-01-05; one dated and one undated name
# correction on two entities.
REGION_FIXES = [(f"2024-01-0{d}", "LOCAL", "09", "001", "02") for d in range(1, 6)]
NAME_FIXES = [("2024-01-10", "LOCAL", "01", "001", "CORRECTED NAME ONE"),
              (None, "NATIONAL", "00", "002", "CORRECTED NAME TWO")]
OFFICIAL_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def region_fixes(spark: SparkSession) -> DataFrame:
    from rollcall.plans.staging import REGION_CORRECTION_SCHEMA
    return spark.createDataFrame(REGION_FIXES, "d string, t string, r string, n string, f string") \
        .select(F.to_date("d").alias("snapshot_date"), F.col("t").alias("entity_type"),
                F.col("r").alias("region_code"), F.col("n").alias("entity_no"),
                F.col("f").alias("region_code_fixed")).to(REGION_CORRECTION_SCHEMA)


def name_fixes(spark: SparkSession) -> DataFrame:
    from rollcall.plans.staging import NAME_CORRECTION_SCHEMA
    return spark.createDataFrame(NAME_FIXES, "d string, t string, r string, n string, f string") \
        .select(F.to_date("d").alias("snapshot_date"), F.col("t").alias("entity_type"),
                F.col("r").alias("region_code"), F.col("n").alias("entity_no"),
                F.col("f").alias("entity_name_fixed")).to(NAME_CORRECTION_SCHEMA)
