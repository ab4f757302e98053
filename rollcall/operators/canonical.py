"""Guarded canonicalisation (C6, C8): replace a value by its canonical form
only when the two are close (normalised edit distance <= threshold); a gross
mismatch is kept, flagged and the canonical value suggested."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import within_distance
from rollcall.session import bounded_broadcast

LOOKUP_BROADCAST_BYTES = 64 << 20


def _guard(df: DataFrame, value: str, official: str, threshold: float,
           flag: str, suggestion: str) -> DataFrame:
    off = F.col(official)
    close = within_distance(F.col(value), off, threshold)
    has = off.isNotNull()
    return (df.withColumn(flag, has & ~close)
              .withColumn(suggestion, F.when(has & ~close, off))
              .withColumn(value, F.when(has & close, off).otherwise(F.col(value))))


def canonicalise(df: DataFrame, lookup: DataFrame, on: str, value: str,
                 lookup_value: str | None = None, threshold: float = 0.20,
                 flag: str = "needs_review", suggestion: str = "suggested") -> DataFrame:
    """Canonical value looked up by code ``on``.

    distance <= threshold -> the official value; > threshold -> keep, flag
    true, suggest the official one; no official value -> keep, flag false.
    A NULL incoming value with an official one gives a NULL flag (3-valued).
    """
    lv = lookup_value or value
    lk = bounded_broadcast(lookup.select(F.col(on).alias("_lk_on"), F.col(lv).alias("_official")),
                           LOOKUP_BROADCAST_BYTES, "lookup")
    j = df.join(lk, df[on] == lk["_lk_on"], "left").drop("_lk_on")
    return _guard(j, value, "_official", threshold, flag, suggestion).drop("_official")


def canonicalise_to_leader(df: DataFrame, type_col: str = "entity_type",
                           leader_value: str = "NATIONAL", date_col: str = "snapshot_date",
                           no_col: str = "entity_no", name_col: str = "entity_name",
                           member_col: str = "is_member", threshold: float = 0.40,
                           flag: str = "needs_name_review",
                           suggestion: str = "suggested_name") -> DataFrame:
    """Rows flagged as members take the name of the leader (a row of type
    ``leader_value``) with the same date and number, when close enough.

    The member condition sits in the join condition, so non-members are kept
    unmatched (never filtered). Of several leaders with one (date, number) the
    smallest name counts, so no row is doubled; ``checks.check_unique`` on the
    leaders reports the surplus. The leader side is itself data, so the join is
    left to the planner (AQE broadcasts it when small, splits skewed keys
    otherwise). The input is read twice (rows and leaders), so pipelines pass a
    materialised table.
    """
    leaders = (df.where((F.col(type_col) == leader_value) & F.col(date_col).isNotNull() & F.col(no_col).isNotNull())
               .groupBy(F.col(date_col).alias("_l_date"), F.col(no_col).alias("_l_no"))
               .agg(F.min(name_col).alias("_leader")))
    cond = (df[date_col] == leaders["_l_date"]) & (df[no_col] == leaders["_l_no"]) & \
        (df[member_col] == F.lit(True))
    j = df.join(leaders, cond, "left").drop("_l_date", "_l_no")
    return _guard(j, name_col, "_leader", threshold, flag, suggestion).drop("_leader")
