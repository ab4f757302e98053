"""Publication of the current picture (S12): the caller's columns under
presentable headers, dates as dd-MM-yyyy text (NULL -> ''), sorted, written as
CSV under a name taken from the latest cut-off date; nothing is written when
empty."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rollcall.functions.names import canonical_label
from rollcall.functions.text import date_text_or_empty
from rollcall.operators.positions import with_positions


def heading(column: str) -> str:
    """A column's name in capitals with blanks."""
    return column.upper().replace("_", " ")


def publication_frame(current: DataFrame, columns: Mapping[str, str] | Sequence[str] | None = None) -> DataFrame:
    """``columns`` maps columns to headers, or lists columns (default: all),
    whose headers are then their names in capitals with blanks."""
    if not isinstance(columns, Mapping):
        columns = {c: heading(c) for c in columns or current.columns}
    dates = {c for c, kind in current.dtypes if kind == "date"}
    return current.select(*[(date_text_or_empty(F.col(c)) if c in dates else F.col(c)).alias(h)
                            for c, h in columns.items()])


def export_current(current: DataFrame, out_dir: str, prefix: str = "entities_current_",
                   single_file: bool = False, columns: Mapping[str, str] | Sequence[str] | None = None,
                   order: Sequence[str] | None = None, position: str | None = None) -> str | None:
    """Write the publication, sorted by ``order`` (default: all columns), under
    a folder named after ``max(updated)``; nothing is written when the current
    picture is empty.

    The sort is a range partitioning, so the part files read in name order are
    the sorted publication and many tasks write it. ``single_file=True``
    funnels it through one task instead (only for small pictures). ``position`` names
    a first column with each row's place in the order, 1 to n.
    """
    latest = current.agg(F.max("updated").alias("d")).select(
        canonical_label("d", prefix).alias("label")).first()
    if latest is None or latest["label"] is None:
        return None
    target = f"{out_dir.rstrip('/')}/{latest['label']}"
    seen = Observation("export")
    columns = columns if isinstance(columns, Mapping) else {c: heading(c) for c in columns or current.columns}
    if position:
        current = with_positions(current, [*(order or []), *current.columns], "_position")
        columns = {"_position": position, **columns}
    by = ["_position"] if position else order or current.columns
    pub = publication_frame(current.orderBy(*by), columns).observe(seen, F.count(F.lit(1)).alias("rows"))
    if single_file:
        pub = pub.coalesce(1)
    pub.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(target)
    export_current.last_rows = int(seen.get.get("rows", 0))   # A6: rows written
    return target
