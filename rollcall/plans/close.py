"""The monthly close as one call: land -> raw -> staged -> clean -> marts ->
checks -> publication. Each step stops the run on failure, as the original
shell runner does; the counters it printed are returned instead.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators import checks as K
from rollcall.plans import ingest as I
from rollcall.plans import staging as S
from rollcall.sources import export as EX
from rollcall.sources import raw_store as R
from rollcall.session import materialize


@dataclass
class CloseResult:
    plan: dict = field(default_factory=dict)        # files per status (I3)
    rows_loaded: int = 0
    checks: list = field(default_factory=list)      # one row per check (K11)
    marts: dict = field(default_factory=dict)       # mart name -> output path
    publication: str | None = None


def seed_checks(region_lookup: DataFrame | None = None, region_fixes: DataFrame | None = None,
                name_fixes: DataFrame | None = None) -> list:
    """Checks on the seed tables: lookup codes unique and present, every
    correction row complete (a name correction's date may be empty)."""
    C, out = K.Check, []
    if region_lookup is not None:
        out += [C("lookup_code_unique", K.check_unique(region_lookup, "region_code")),
                K.not_null_check("lookup_code_not_null", region_lookup, "region_code"),
                K.not_null_check("lookup_name_not_null", region_lookup, "region_name")]
    if region_fixes is not None:
        out += [K.not_null_check(f"region_fix_{c}_not_null", region_fixes, c)
                for c in ("snapshot_date", "region_code", "entity_no", "region_code_fixed")]
    if name_fixes is not None:
        out += [K.not_null_check(f"name_fix_{c}_not_null", name_fixes, c)
                for c in ("entity_type", "region_code", "entity_no", "entity_name_fixed")]
    return out


def registry_checks(staged: DataFrame, clean: DataFrame, hist: DataFrame) -> list:
    """The checks attached to the registry layers (error unless marked warn).
    Row-level checks of one table share one pass over it."""
    C = K.Check
    return [
        K.not_null_check("hist_key_not_null", hist, "entity_key"),
        K.not_null_check("hist_from_not_null", hist, "valid_from"),
        K.not_null_check("hist_to_not_null", hist, "valid_to"),
        K.not_null_check("hist_current_not_null", hist, "is_current"),
        K.not_null_check("stg_key_not_null", staged, "entity_key"),
        K.not_null_check("stg_region_not_null", staged, "region_code"),
        K.not_null_check("stg_number_not_null", staged, "entity_no"),
        K.accepted_check("stg_type_accepted", staged, "entity_type", ["LOCAL", "NATIONAL"]),
        C("stg_key_unique_per_snapshot", K.check_unique(staged, ["entity_key", "snapshot_date"], nulls_count=True)),
        # the leader rule joins on (date, number): two leaders there would fan out
        C("leader_unique_per_snapshot", K.check_unique(
            staged.where(F.col("entity_type") == "NATIONAL"), ["snapshot_date", "entity_no"])),
        C("hist_grain_unique", K.check_unique(hist, ["entity_key", "valid_from"], nulls_count=True)),
        K.interval_check("hist_interval_valid", hist),
        C("hist_no_overlap", K.check_no_overlap(hist)),
        C("hist_single_current", K.check_single_current(hist)),
        C("warn_regions", K.warn_regions(staged), K.WARN),
        C("warn_names", K.warn_names(clean), K.WARN),
    ]


def monthly_close(spark: SparkSession, landing: str, store: str, marts_dir: str,
                  region_lookup: DataFrame | None = None, region_fixes: DataFrame | None = None,
                  name_fixes: DataFrame | None = None, geo: DataFrame | None = None,
                  ext: str = ".csv", publish_dir: str | None = None,
                  rules: S.Rules = S.Rules(), stop_on_error: bool = True) -> CloseResult:
    """Run the whole close. Only snapshot dates the raw store does not hold
    are loaded (first file by name wins for a date). Error-level check
    failures raise before any mart is written (``stop_on_error=False`` only
    reports them); the raw load itself is kept, as it is immutable and a rerun
    skips it."""
    res = CloseResult()
    done = I.load_landing(spark, landing, store, ext=ext)
    res.plan, res.rows_loaded = done.plan, done.rows
    build_marts(spark, store, marts_dir, region_lookup, region_fixes, name_fixes, geo, rules,
                stop_on_error, res)
    if publish_dir:
        res.publication = EX.export_current(spark.read.parquet(res.marts["current"]), publish_dir,
                                            order=S.PUBLICATION_ORDER)
    return res


def build_marts(spark: SparkSession, store: str, marts_dir: str,
                region_lookup: DataFrame | None = None, region_fixes: DataFrame | None = None,
                name_fixes: DataFrame | None = None, geo: DataFrame | None = None,
                rules: S.Rules = S.Rules(), stop_on_error: bool = True,
                res: CloseResult | None = None) -> CloseResult:
    """Raw store -> staged -> clean -> the five marts written under
    ``marts_dir``, with the checks run before anything is written."""
    res = res or CloseResult()
    staged = S.stage(R.read_raw(spark, store), region_lookup, region_fixes, name_fixes, rules)
    clean = materialize(S.clean(staged, rules), "clean")
    marts = S.marts(clean, geo)
    report = K.run_checks(seed_checks(region_lookup, region_fixes, name_fixes)
                          + registry_checks(staged, clean, marts["history"]))
    res.checks = K.gate(report) if stop_on_error else report.collect()
    for name, df in marts.items():
        path = f"{marts_dir.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        res.marts[name] = path
    return res
