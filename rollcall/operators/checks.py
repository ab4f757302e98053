"""Data checks (K1-K11). Each check returns the offending rows; zero rows
means pass. ``run_checks`` counts them all in one job and labels each
PASS / FAIL (error) / WARN (warn)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ERROR, WARN = "error", "warn"


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """K1: rows where ``col`` is NULL."""
    return df.where(F.col(col).isNull())


def check_unique(df: DataFrame, cols: Sequence[str] | str, nulls_count: bool = False) -> DataFrame:
    """K2/K4/K5 (A5): key values occurring more than once, with their count.
    Rows with a NULL key part are ignored, as a uniqueness test does (K2);
    the grain checks K4 and K5 count them as any other value."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    if not nulls_count:
        df = df.dropna(subset=cols)
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def check_accepted(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """K3: rows whose value is outside the accepted set (NULL passes)."""
    return df.where(~F.col(col).isin(list(values)))


def check_interval(df: DataFrame, key: str = "entity_key", start: str = "valid_from",
                   end: str = "valid_to") -> DataFrame:
    """K6: versions whose start is after their end."""
    return df.where(F.col(start) > F.col(end)).select(key, start, end)


def check_no_overlap(df: DataFrame, key: str = "entity_key", start: str = "valid_from",
                     end: str = "valid_to") -> DataFrame:
    """K7: versions that start inside an earlier-starting version of the same
    key (closed intervals), each offending version once with the latest end
    among versions starting strictly earlier (``overlaps_until``).

    ``b`` overlaps some ``a`` with ``a.start < b.start <= a.end`` exactly when
    ``b.start`` is at or before the latest end among versions starting
    strictly earlier, so no pairs are built. Skew-safe: ends are first reduced
    to one row per (key, start day) with a map-side partial aggregate; the
    running maximum runs over those day rows; one equi-join brings it back to
    the versions (AQE splits a hot key on the large side). NULL keys never
    match, as in the pairwise form.
    """
    day = F.unix_date(F.col(start)).cast("bigint")
    rows = df.select(key, start, end).withColumn("_day", day)
    per_day = rows.where(F.col(key).isNotNull()).groupBy(key, "_day").agg(F.max(end).alias("_day_end"))
    w = Window.partitionBy(key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_day.select(key, "_day", F.max("_day_end").over(w).alias("overlaps_until"))
    return (rows.join(carry, [key, "_day"])
            .where(F.col(start) <= F.col("overlaps_until"))
            .select(key, start, end, "overlaps_until"))


def check_single_current(df: DataFrame, key: str = "entity_key",
                         flag: str = "is_current") -> DataFrame:
    """K8: keys with more than one current version."""
    return (df.where(F.col(flag)).groupBy(key).agg(F.count(F.lit(1)).alias("current_versions"))
            .where(F.col("current_versions") > 1))


def warn_regions(staged: DataFrame) -> DataFrame:
    """K9: region code / name contradictions, grouped with their count."""
    return (staged.where(F.col("needs_region_review"))
            .groupBy("region_code", "region_name", "suggested_region")
            .agg(F.count(F.lit(1)).alias("n")))


def warn_names(clean_df: DataFrame) -> DataFrame:
    """Member names too far from their leader's name."""
    return clean_df.where(F.col("needs_name_review")).select(
        "entity_key", "snapshot_date", "entity_name", "suggested_name")


@dataclass
class Check:
    """A named check: ``rows`` are the offending rows. ``predicate`` and
    ``source`` are set for row-level checks (``source`` rows where the
    predicate holds), which ``run_checks`` counts in one pass per source."""
    name: str
    rows: DataFrame
    severity: str = ERROR
    predicate: Column | None = None
    source: DataFrame | None = None


def not_null_check(name: str, df: DataFrame, col: str, severity: str = ERROR) -> Check:
    """K1 as a row-level check."""
    return Check(name, check_not_null(df, col), severity, F.col(col).isNull(), df)


def accepted_check(name: str, df: DataFrame, col: str, values: Sequence[str],
                   severity: str = ERROR) -> Check:
    """K3 as a row-level check (NULL passes)."""
    return Check(name, check_accepted(df, col, values), severity, ~F.col(col).isin(list(values)), df)


def interval_check(name: str, df: DataFrame, key: str = "entity_key", start: str = "valid_from",
                   end: str = "valid_to", severity: str = ERROR) -> Check:
    """K6 as a row-level check."""
    return Check(name, check_interval(df, key, start, end), severity, F.col(start) > F.col(end), df)


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """One row per check - name, severity, failing-row count, status.

    Row-level checks on the same table are counted together in one pass
    (``count_if`` per predicate, unpivoted with ``stack``); the others are
    one aggregate each. Everything is unioned into a single plan, so one
    action runs all checks. An error with failures should stop the caller's
    run (see ``gate``); a warn only reports.
    """
    parts, by_source = [], {}
    for c in checks:
        if c.predicate is not None and c.source is not None:
            by_source.setdefault(id(c.source), (c.source, []))[1].append(c)
        else:
            parts.append(c.rows.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), "failures"))
    for source, group in by_source.values():
        counts = source.agg(*[F.count_if(c.predicate).alias(f"_c{i}") for i, c in enumerate(group)])
        pairs = ", ".join(f"'{c.name}', '{c.severity}', _c{i}" for i, c in enumerate(group))
        parts.append(counts.select(F.expr(f"stack({len(group)}, {pairs})")
                                   .alias("check", "severity", "failures")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = (F.when(F.col("failures") == 0, F.lit("PASS"))
              .when(F.col("severity") == ERROR, F.lit("FAIL")).otherwise(F.lit("WARN")))
    return out.withColumn("failures", F.col("failures").cast("bigint")).withColumn("status", status)


def gate(report: DataFrame) -> list:
    """Stop a run when an error-level check failed; returns the report rows
    (one per check - metadata, not data)."""
    rows = report.collect()
    failed = [r["check"] for r in rows if r["status"] == "FAIL"]
    if failed:
        raise RuntimeError(f"data checks failed: {failed}")
    return rows
