"""Auditable correction tables applied as overlays.

Only listed rows change; all others pass through untouched. Correction
tables are small user-maintained seeds, so they are broadcast after a size
check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.session import bounded_broadcast

SEED_BROADCAST_BYTES = 64 << 20


def apply_corrections(df: DataFrame, corr: DataFrame, keys: Sequence[str], target: str,
                      value: str, date_col: str = "snapshot_date",
                      date_optional: bool = False) -> DataFrame:
    """Overwrite ``target`` with ``corr[value]`` where a correction row
    matches on ``keys`` (and on ``date_col``).

    With ``date_optional=True`` a correction whose date is NULL applies to every
    snapshot of the entity; a dated row beats an undated one for its snapshot,
    so each input row matches at most one correction (no fan-out).
    Key values are compared as they are at this step (before any backfill), so
    rows whose key part is NULL are never corrected.
    """
    keys = list(keys)
    c = corr.select(*keys, date_col, value)
    dated = bounded_broadcast(
        c.where(F.col(date_col).isNotNull())
         .select(*[F.col(k).alias(f"_c_{k}") for k in keys],
                 F.col(date_col).alias("_c_date"), F.col(value).alias("_c_dated")),
        SEED_BROADCAST_BYTES, "dated corrections")
    cond = [df[k] == dated[f"_c_{k}"] for k in keys] + [df[date_col] == dated["_c_date"]]
    out = df.join(dated, cond, "left").drop(*[f"_c_{k}" for k in keys], "_c_date")
    fixed = F.col("_c_dated")
    if date_optional:
        undated = bounded_broadcast(
            c.where(F.col(date_col).isNull())
             .select(*[F.col(k).alias(f"_u_{k}") for k in keys], F.col(value).alias("_c_undated")),
            SEED_BROADCAST_BYTES, "undated corrections")
        cond = [out[k] == undated[f"_u_{k}"] for k in keys]
        out = out.join(undated, cond, "left").drop(*[f"_u_{k}" for k in keys])
        fixed = F.coalesce(F.col("_c_dated"), F.col("_c_undated"))
    cols = [F.coalesce(fixed, F.col(target)).alias(target) if x == target else F.col(x)
            for x in df.columns]
    return out.select(*cols)
