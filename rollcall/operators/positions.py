"""Global positions of a sort order (O1-O3): the order as data, so it can be stored and checked.

A stored table has no order, and a row number over all rows is one task. Here rows
are dealt by ranges of the order and written once; a position is the row's place in its
range plus the rows of the ranges before it, a running sum over one row a range.
Rows that are equal in the order are dealt by a number of their own as well, so that a
value which most rows have is many tasks; such rows follow one another in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.session import materialize


def _column(c: Column | str) -> Column:
    return F.col(c).asc_nulls_first() if isinstance(c, str) else c


def with_positions(df: DataFrame, order: Sequence[Column | str], name: str = "position", ranges: int | None = None) -> DataFrame:
    """``df`` with each row's position, 1 to n, in the order of columns or sort expressions (NULL first by default)."""
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*map(_column, order), F.col("_tie")]
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(ranges, *by)
    dealt = materialize(dealt.withColumn("_range", F.spark_partition_id()), "positions")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)          # over one row a range
    before = dealt.groupBy("_range").agg(F.count("*").alias("n")).select(
        "_range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*by))
    return dealt.withColumn("_place", place).join(before, "_range") \
        .select(*df.columns, (F.col("_before") + F.col("_place")).alias(name))
