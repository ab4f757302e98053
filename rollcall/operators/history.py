"""Snapshot calendar, type-2 history by presence, current view, movements.

Plan shape of ``scd2_presence`` (checked with ``explain``):

1. ``groupBy(key, date)`` collapses duplicate rows of one entity in one
   snapshot with a map-side partial aggregate, so a hot key (even one holding a
   third of all rows, e.g. a NULL key) is combined before the shuffle and each
   key keeps at most one row per loaded snapshot afterwards.
2. The calendar (distinct dates, one row per loaded snapshot, so bounded by the
   days there are) is broadcast: no exchange on the date.
3. One hash exchange on the key: ``period - row_number()`` is constant inside
   an unbroken run of periods (gaps-and-islands), then ``groupBy(key, island)``
   reuses that distribution, so no second shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.text import bool_to_flag, month_text, year_of

PERIOD = "period"


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def calendar(df: DataFrame, date_col: str = "snapshot_date") -> DataFrame:
    """Loaded snapshot dates with a dense index (missing months are not
    gaps), plus the next loaded date and a flag for the last one.

    The window runs on the distinct dates only (one row per snapshot), never on
    the data rows.
    """
    dates = df.select(F.col(date_col).alias("snapshot_date")) \
        .where(F.col("snapshot_date").isNotNull()).distinct()
    w = Window.orderBy("snapshot_date")
    return (dates
            .withColumn(PERIOD, F.row_number().over(w).cast("bigint"))
            .withColumn("next_date", F.lead("snapshot_date").over(w))
            .withColumn("is_last", F.col("next_date").isNull()))


def scd2_presence(df: DataFrame, key, date_col: str, attrs: Sequence[str],
                  order_by: Sequence[str] | None = None,
                  cal: DataFrame | None = None) -> DataFrame:
    """One row per unbroken run of loaded snapshots per key.

    Attribute changes do not split a run; the attributes come from the run's
    last snapshot. ``order_by`` breaks ties between duplicate rows of one key in
    one snapshot (the last row in that order wins); without it the greatest
    attribute tuple wins, which is deterministic too.

    Returns ``key…, attrs…, valid_from, valid_to, is_current``.
    """
    keys = _cols(key)
    attrs = list(attrs)
    a = F.struct(*[F.col(c) for c in attrs]) if attrs else F.struct(F.lit(0).alias("_"))
    if order_by:
        pick = F.max_by(a, F.struct(*[F.col(c) for c in order_by]))
    else:
        pick = F.max(a)
    per_snapshot = (df.groupBy(*keys, F.col(date_col).alias("snapshot_date"))
                    .agg(pick.alias("_a")))
    if cal is None:
        cal = calendar(per_snapshot, "snapshot_date")
    cal = cal.select("snapshot_date", PERIOD, "is_last")
    with_period = per_snapshot.join(F.broadcast(cal), "snapshot_date")
    w = Window.partitionBy(*keys).orderBy(PERIOD)
    runs = with_period.withColumn(
        "_island", F.col(PERIOD) - F.row_number().over(w))
    versions = runs.groupBy(*keys, "_island").agg(
        F.min("snapshot_date").alias("valid_from"),
        F.max("snapshot_date").alias("valid_to"),
        F.max_by(F.struct("_a", "is_last"), F.col(PERIOD)).alias("_last"))
    out = [F.col(k) for k in keys] + \
        [F.col(f"_last._a.{c}").alias(c) for c in attrs] + \
        [F.col("valid_from"), F.col("valid_to"),
         F.col("_last.is_last").alias("is_current")]
    return versions.select(*out)


def current_view(history: DataFrame, key: str = "entity_key",
                 id_name: str = "entity_id", flag_col: str | None = "is_member",
                 updated_name: str = "updated") -> DataFrame:
    """C11: current versions, key renamed, flag as YES/NO text, ``valid_to``
    as the update date."""
    cols = []
    for c in history.columns:
        if c in ("valid_from", "is_current"):
            continue
        if c == key:
            cols.append(F.col(c).alias(id_name))
        elif c == "valid_to":
            cols.append(F.col(c).alias(updated_name))
        elif flag_col and c == flag_col:
            cols.append(bool_to_flag(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return history.where(F.col("is_current")).select(*cols)


def movements(history: DataFrame, cal: DataFrame) -> DataFrame:
    """Per loaded snapshot, additions (runs starting there, the first
    snapshot excluded), removals (closed runs, booked on the next loaded
    snapshot) and net; zero-filled over the calendar.

    The history is read once: a version counts on its first date and, when
    closed, on the loaded date after its last. Counts are pre-aggregated, so one
    row per date and task is shuffled; calendar and counts have one row per
    loaded snapshot and are broadcast.
    """
    after = cal.select(F.col("snapshot_date").alias("valid_to"), "next_date")
    moves = history.select("valid_from", "valid_to").join(F.broadcast(after), "valid_to") \
        .select(F.explode(F.array(
            F.struct(F.col("valid_from").alias("snapshot_date"), F.lit(1).alias("came"), F.lit(0).alias("went")),
            F.struct(F.col("next_date").alias("snapshot_date"), F.lit(0).alias("came"), F.lit(1).alias("went")),
        )).alias("m")).select("m.*").where("snapshot_date is not null")      # the last snapshot has no next one
    counts = moves.groupBy("snapshot_date").agg(F.sum("came").alias("came"), F.sum("went").alias("went"))
    came = F.when(F.col(PERIOD) > 1, F.coalesce("came", F.lit(0))).otherwise(0).cast("bigint")
    went = F.coalesce("went", F.lit(0)).cast("bigint")
    return (cal.select("snapshot_date", PERIOD)
            .join(F.broadcast(counts), "snapshot_date", "left")
            .select("snapshot_date",
                    year_of("snapshot_date").alias("year"),
                    month_text("snapshot_date").alias("month"),
                    came.alias("additions"), went.alias("removals"),
                    (came - went).alias("net")))


def expand_versions(history: DataFrame, cal: DataFrame, key) -> DataFrame:
    """Inverse of ``scd2_presence`` used by the property test: every version
    expanded over the loaded snapshots it covers, as ``(key…, snapshot_date)``.
    Versions are joined with the calendar by period numbers, never by a range.
    """
    keys = _cols(key)
    c = F.broadcast(cal.select("snapshot_date", PERIOD))
    span = history.join(c.toDF("valid_from", "_first"), "valid_from").join(c.toDF("valid_to", "_last"), "valid_to")
    return span.select(*keys, F.explode(F.sequence("_first", "_last")).alias(PERIOD)) \
        .join(c, PERIOD).select(*keys, "snapshot_date")
