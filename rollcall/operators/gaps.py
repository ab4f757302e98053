"""Identity gap fill (C7): a missing value is taken from the entity's own
history - the most recent earlier non-null value, else the nearest later one.

Skew-safe plan. A window over a whole (region, name) group, or over one date of
it, would put a hot group (e.g. all rows with an empty name) into one task.
Instead:

1. rows that have a value pass straight through: no shuffle, no window;
2. per (group, date, tie-break) one summary row, with map-side partial
   aggregation, so a hot group is combined before its shuffle: the least and
   greatest value there, and whether a value is missing there;
3. running carries over that summary in both directions. Where the tie-break
   makes rows single (a row number), the summary is as long as the input; then
   the carries are a segmented scan (``scanned_carries``): the summary is dealt
   by ranges of (group, date, tie-break), each range is scanned by itself, and
   what one range hands on to the next is found over one row a range and group,
   so a hot group is as many tasks as it has ranges;
4. the rows without a value look their place up in it; one join on the summary's
   keys, which carry NULL as a flag (AQE splits a hot key on the rows' side).

The input is read per branch (rows with a value, rows without, the summary's
few columns); pipelines hand it a materialised table (``session.materialize``)
when it is expensive to compute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.session import materialize

BEFORE = Window.unboundedPreceding


def carries(summary: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """W6/W7 in one window a group: ``_prev``, the last ``_last`` before a row, ``_next``, the first ``_first`` after it."""
    # ascending with NULL first, as a window orders them, and the exact reverse
    up = Window.partitionBy(*group).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(BEFORE, -1)
    down = Window.partitionBy(*group).orderBy(*[F.col(c).desc_nulls_last() for c in order]).rowsBetween(BEFORE, -1)
    return summary.withColumn("_prev", F.last("_last", ignorenulls=True).over(up)) \
        .withColumn("_next", F.last("_first", ignorenulls=True).over(down))


def in_ranges(summary: DataFrame, group: Sequence[str], order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """The summary dealt by ranges of (group, order), with the range's number, written once: all steps see the same cuts."""
    ranges = ranges or int(summary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    return materialize(summary.repartitionByRange(ranges, *by).withColumn("_range", F.spark_partition_id()), "ranges")


def scanned_carries(ranged: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """W6/W7 as a segmented scan over ``in_ranges``: no task holds more of a group than one range of it.

    Each range of a group is scanned by itself. One row a range and group - its
    last and its first value - then tells what earlier ranges hand on and
    later ones hand back; a group that lies in one range gets nothing. The group
    columns must not be NULL (``backfill`` carries NULL as a flag).
    """
    place = F.struct(*order)
    edges = ranged.groupBy("_range", *group).agg(
        F.max_by("_last", F.when(F.col("_last").isNotNull(), place)).alias("_last"),
        F.min_by("_first", F.when(F.col("_first").isNotNull(), place)).alias("_first"))
    handed = carries(edges, group, ["_range"]).where("_prev IS NOT NULL OR _next IS NOT NULL") \
        .select("_range", *group, F.col("_prev").alias("_handed_on"), F.col("_next").alias("_handed_back"))
    within = carries(ranged, ["_range", *group], order)
    return within.join(handed, ["_range", *group], "left") \
        .withColumn("_prev", F.coalesce("_prev", "_handed_on")).withColumn("_next", F.coalesce("_next", "_handed_back")) \
        .drop("_range", "_handed_on", "_handed_back")


def backfill(df: DataFrame, col: str, partition: Sequence[str], order: str = "snapshot_date",
             tiebreak: Sequence[str] = (), scan: bool = False) -> DataFrame:
    """``coalesce(own, last non-null before, first non-null after)`` within
    ``partition``, in (order, tiebreak…) order. Without tie-break columns, rows
    of one date are ordered by the value itself, a missing one first. Of rows
    with equal order and tie-break those without a value come first, then by
    value, which keeps it deterministic.

    NULL group values form their own group (as a window partition does).
    ``scan=True`` finds the carries by the segmented scan, for tie-breaks that
    leave as many places as rows; it writes the summary once.
    """
    v = F.col(col)
    places = list(partition) + [order] + (list(tiebreak) or [col])
    keyed = df
    keys = []
    for i, c in enumerate(places):
        keyed = (keyed.withColumn(f"_k{i}", F.coalesce(F.col(c).cast("string"), F.lit("")))
                      .withColumn(f"_n{i}", F.col(c).isNull()))
        keys += [f"_k{i}", f"_n{i}"]
    group = keys[:2 * len(partition)]
    inner = places[len(partition):]         # the order within a group: date, then the tie-break
    summary = keyed.groupBy(*keys).agg(
        *[F.max(c).alias(f"_o{i}") for i, c in enumerate(inner)],
        F.max(v).alias("_last"), F.min(v).alias("_first"), F.max(v.isNull()).alias("_asked"))

    within = [f"_o{i}" for i in range(len(inner))]
    if scan:
        carried = scanned_carries(in_ranges(summary, group, within), group, within)
    else:
        carried = carries(summary, group, within)
    found = carried.where("_asked").select(*keys, F.coalesce("_prev", "_first", "_next").alias("_found"))
    filled = keyed.where(v.isNull()).join(found, keys, "left") \
        .select(*[F.col("_found").alias(c) if c == col else F.col(c) for c in df.columns])
    return df.where(v.isNotNull()).unionByName(filled)
