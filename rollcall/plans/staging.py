"""The registry chain: raw snapshots -> staged -> clean panel -> history and
marts (C15 and the full chain).

Order matters and follows the original models: normalise; correct the region
code (matching the raw, pre-backfill number); correct names (matching the
corrected region); compare the region name with the official one; backfill
missing numbers within (region, name); build the key; then the leader rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions import text as X
from rollcall.operators import canonical as C
from rollcall.operators import history as H
from rollcall.operators import marts as M
from rollcall.operators.corrections import apply_corrections
from rollcall.operators.gaps import backfill
from rollcall.session import materialize, small_table

# The column layout of the registry at each layer.
RAW_COLUMNS = ["entity_type", "region_code", "region_name", "entity_no", "entity_name",
               "acronym", "recognised_on", "member_flag"]
STAGED_COLUMNS = ["entity_key", "entity_type", "region_code", "region_name",
                  "needs_region_review", "suggested_region", "entity_no", "entity_name",
                  "acronym", "recognised_on", "is_member", "snapshot_date"]
CLEAN_COLUMNS = ["entity_key", "entity_type", "region_code", "region_name", "entity_no",
                 "entity_name", "needs_name_review", "suggested_name", "acronym",
                 "recognised_on", "is_member", "snapshot_date"]
PANEL_COLUMNS = [c for c in CLEAN_COLUMNS if c not in ("needs_name_review", "suggested_name")]
PUBLICATION_ORDER = ["region_code", "entity_type", "entity_no"]
HISTORY_ATTRS = ["entity_type", "region_code", "region_name", "entity_no", "entity_name",
                 "acronym", "recognised_on", "is_member"]

REGION_CORRECTION_SCHEMA = T.StructType([
    T.StructField("snapshot_date", T.DateType()), T.StructField("entity_type", T.StringType()),
    T.StructField("region_code", T.StringType()), T.StructField("entity_no", T.StringType()),
    T.StructField("region_code_fixed", T.StringType())])
NAME_CORRECTION_SCHEMA = T.StructType([
    T.StructField("snapshot_date", T.DateType()), T.StructField("entity_type", T.StringType()),
    T.StructField("region_code", T.StringType()), T.StructField("entity_no", T.StringType()),
    T.StructField("entity_name_fixed", T.StringType())])
REGION_LOOKUP_SCHEMA = "region_code string, region_name string, latitude double, longitude double"


@dataclass
class Rules:
    region_width: int = 2
    number_width: int = 3
    region_threshold: float = 0.20
    leader_threshold: float = 0.40
    national: str = "NATIONAL"
    yes: str = "YES"
    strict_codes: bool = False


def normalise(raw: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """C1, C2, X8-X10 on the raw text columns; extra raw columns are ignored
    (``_row_number`` is kept as a tie-break when present)."""
    keep = ["_row_number"] if "_row_number" in raw.columns else []
    have = set(raw.columns)
    col = (lambda c: F.col(c) if c in have else F.lit(None).cast("string"))
    return raw.select(
        col("entity_type").alias("entity_type"),
        X.pad_code(col("region_code"), rules.region_width, rules.strict_codes).alias("region_code"),
        X.clean_name(col("region_name")).alias("region_name"),
        X.pad_code(col("entity_no"), rules.number_width, rules.strict_codes).alias("entity_no"),
        X.clean_name(col("entity_name")).alias("entity_name"),
        col("acronym").alias("acronym"),
        X.parse_datetime_date(col("recognised_on")).alias("recognised_on"),
        X.flag_to_bool(col("member_flag"), rules.yes).alias("is_member"),
        F.col("snapshot_date"),
        *keep)


def correct(df: DataFrame, region_fixes: DataFrame | None, name_fixes: DataFrame | None) -> DataFrame:
    """C4 then C5 (the name fix matches the corrected region code)."""
    keys = ["entity_type", "region_code", "entity_no"]
    if region_fixes is not None:
        df = apply_corrections(df, region_fixes, keys, "region_code", "region_code_fixed")
    if name_fixes is not None:
        df = apply_corrections(df, name_fixes, keys, "entity_name", "entity_name_fixed",
                               date_optional=True)
    return df


def stage(raw: DataFrame, region_lookup: DataFrame | None = None,
          region_fixes: DataFrame | None = None, name_fixes: DataFrame | None = None,
          rules: Rules = Rules(), persist: bool = True) -> DataFrame:
    """The staged registry with ``STAGED_COLUMNS``.

    The backfill reads its input three times (rows with a number, rows without,
    the places that its carries run over). With ``persist`` (default) that input
    is written once, the carries are a segmented scan, and the staged table - read
    twice by the leader rule - is written once too; ``persist=False`` keeps
    everything one lazy plan, with one window a group.
    """
    df = correct(normalise(raw, rules), region_fixes, name_fixes)
    if region_lookup is not None:
        df = C.canonicalise(df, region_lookup, on="region_code", value="region_name",
                            threshold=rules.region_threshold,
                            flag="needs_region_review", suggestion="suggested_region")
    else:
        df = df.withColumn("needs_region_review", F.lit(False)) \
            .withColumn("suggested_region", F.lit(None).cast("string"))
    tiebreak = ["entity_type"] + (["_row_number"] if "_row_number" in df.columns else [])
    if persist:
        df = materialize(df, "corrected")
    df = backfill(df, "entity_no", ["region_code", "entity_name"], "snapshot_date", tiebreak, scan=persist)
    df = df.withColumn("entity_key", X.entity_key("entity_type", "region_code", "entity_no",
                                                  national_value=rules.national))
    df = df.select(*STAGED_COLUMNS)
    return materialize(df, "staged") if persist else df


def clean(staged: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """C8 on the staged registry: the intermediate layer (``CLEAN_COLUMNS``)."""
    df = C.canonicalise_to_leader(staged, leader_value=rules.national,
                                  threshold=rules.leader_threshold)
    return df.select(*CLEAN_COLUMNS)


def history(clean_df: DataFrame, cal: DataFrame | None = None) -> DataFrame:
    """C10 on the clean panel; one version per run of presence per key."""
    return H.scd2_presence(clean_df, "entity_key", "snapshot_date", HISTORY_ATTRS, cal=cal)


def marts(clean_df: DataFrame, geo: DataFrame | None = None,
          persist: bool = True) -> dict[str, DataFrame]:
    """History, current picture, movements, detail and summary from one clean
    panel and one calendar. The caller should materialise ``clean_df`` once
    (checkpoint or written table) - it feeds four marts; with ``persist`` the
    calendar and the history (read by the current view and the movements) are
    written once too."""
    cal = H.calendar(clean_df)
    if persist:
        cal = small_table(cal, "calendar")            # one row per loaded snapshot
    hist = history(clean_df, cal)
    if persist:
        hist = materialize(hist, "history")
    return {
        "history": hist,
        "current": H.current_view(hist, key="entity_key", flag_col="is_member"),
        "movements": H.movements(hist, cal),
        "panel": M.panel(clean_df.select(*PANEL_COLUMNS), geo, cal=cal),
        "summary": M.summary(clean_df),
    }
