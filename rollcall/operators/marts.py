"""Report marts on top of the cleaned panel: detail (C13) and summary (C14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import lat_long_text, month_text, year_of
from rollcall.operators.history import calendar
from rollcall.session import bounded_broadcast


def panel(df: DataFrame, geo: DataFrame | None = None, on: str = "region_code",
          date_col: str = "snapshot_date", cal: DataFrame | None = None) -> DataFrame:
    """Every row of every snapshot, with coordinates, year / month text and
    ``is_current`` (row belongs to the latest loaded snapshot).

    The latest-snapshot flag comes from the calendar, one row per snapshot date
    and so bounded by the days there are: it is broadcast, the panel isn't
    shuffled. ``geo`` is a lookup ``(on, latitude, longitude)``, unique on
    ``on`` and broadcast behind its size check.
    """
    if cal is None:
        cal = calendar(df, date_col)
    flags = cal.select(F.col("snapshot_date").alias(date_col),
                       F.col("is_last").alias("is_current"))
    out = df
    if geo is not None:
        g = bounded_broadcast(geo.select(on, "latitude", "longitude"), what="coordinates")
        out = out.join(g, on, "left") \
            .withColumn("location", lat_long_text("latitude", "longitude"))
    return (out.join(F.broadcast(flags), date_col)
            .withColumn("year", year_of(date_col))
            .withColumn("month", month_text(date_col)))


def summary(df: DataFrame, type_col: str = "entity_type", date_col: str = "snapshot_date",
            national: str = "NATIONAL", local: str = "LOCAL") -> DataFrame:
    """C14: per snapshot, counts by type and the total (one row per date)."""
    t = F.col(type_col)
    return (df.groupBy(F.col(date_col).alias("snapshot_date"))
            .agg(F.count_if(t == national).alias("nationals"),
                 F.count_if(t == local).alias("locals"),
                 F.count(F.lit(1)).alias("total"))
            .select("snapshot_date", year_of("snapshot_date").alias("year"),
                    month_text("snapshot_date").alias("month"),
                    "nationals", "locals", "total"))
