"""Scalar Column expressions (all JVM-side built-ins, no UDF).

Each function takes Columns (or names) and returns a Column, so it composes
into whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The RE2 ``\s`` set (space, tab, newline, form feed, carriage
# return) used when collapsing interior whitespace, and the shape a text
# date-time must have before it is parsed (date, optional time).
WS_RUN = r"[ \t\n\f\r]+"
DATETIME_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}:\d{1,2}(\.\d+)?)?$"
# The characters a Python / pandas ``str.strip()`` removes (every
# code point whose ``str.isspace()`` is true): tab, line feed, vertical tab,
# form feed, carriage return, the four information separators U+001C-U+001F,
# space, next line U+0085, no-break space U+00A0, ogham space mark U+1680, the
# spaces U+2000-U+200A, line and paragraph separators U+2028/U+2029, narrow
# no-break space U+202F, medium mathematical space U+205F, ideographic space
# U+3000. Spark's ``trim`` removes only U+0020.
UNICODE_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                      "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                      "\u2028\u2029\u202f\u205f\u3000")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def utrim(c) -> Column:
    """Trim Unicode whitespace at both ends; NULL stays NULL. A character-set
    trim (``btrim``), several times cheaper than an anchored regex."""
    return F.btrim(_c(c), F.lit(UNICODE_WHITESPACE))


def collapse_ws(c) -> Column:
    """Replace every run of whitespace by a single space."""
    return F.regexp_replace(_c(c), WS_RUN, " ")


def clean_name(c) -> Column:
    """Collapse whitespace, trim, upper case."""
    return F.upper(utrim(collapse_ws(c)))


def to_int_code(c) -> Column:
    """X1+X2: text number in any spelling -> BIGINT, rounding half away from
    zero like a NUMERIC->INT64 cast; unparseable -> NULL."""
    return F.round(_c(c).try_cast("decimal(38,9)"), 0).cast("bigint")


def pad_code(c, width: int, strict: bool = False) -> Column:
    """``2``, ``02``, ``2.0`` -> ``'02'`` for width 2; unparseable -> NULL.

    ``lpad`` cuts longer values (``1234`` at width 3 -> ``123``), as the
    reference does; ``strict=True`` keeps long codes whole instead.
    """
    s = to_int_code(c).cast("string")
    if strict:
        return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))
    return F.lpad(s, width, "0")


def entity_key(type_col, region_col, no_col, national_value: str = "NATIONAL",
               national_prefix: str = "N", other_prefix: str = "L") -> Column:
    """``N-02-154`` style business key; NULL when any part is NULL.

    A NULL type falls into the ``else`` branch (simple CASE semantics).
    """
    prefix = F.when(_c(type_col) == national_value, F.lit(national_prefix)) \
        .otherwise(F.lit(other_prefix))
    return F.concat(prefix, F.lit("-"), _c(region_col), F.lit("-"), _c(no_col))


def norm_distance(a, b) -> Column:
    """Levenshtein distance divided by the longer length (characters).

    Two empty strings give 0.0 instead of a zero division.
    """
    a, b = _c(a), _c(b)
    longest = F.greatest(F.length(a), F.length(b))
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .when(longest == 0, F.lit(0.0))
            .otherwise(F.levenshtein(a, b).cast("double") / longest.cast("double")))


def within_distance(a, b, threshold: float) -> Column:
    """Decision only: ``norm_distance(a, b) <= threshold`` (3-valued).

    Measured on 2.6M rows, the plain ratio is faster than Levenshtein with a
    threshold argument (which stops early but adds per-row arithmetic), so
    the exact ratio is compared directly - also the reference decision rule.
    """
    return norm_distance(a, b) <= F.lit(float(threshold))


def parse_datetime_date(c) -> Column:
    """X8+X9: text date-time -> DATE, NULL unless the full shape matches."""
    c = _c(c)
    return F.when(c.rlike(DATETIME_SHAPE),
                  c.try_cast("timestamp_ntz").cast("date"))


def flag_to_bool(c, yes: str = "YES") -> Column:
    """``= 'YES'`` (case-sensitive); NULL stays NULL."""
    return _c(c) == F.lit(yes)


def bool_to_flag(c, yes: str = "YES", no: str = "NO") -> Column:
    """X11: true -> yes, false or NULL -> no."""
    return F.when(_c(c), F.lit(yes)).otherwise(F.lit(no))


def year_of(c) -> Column:
    """X22 as BIGINT."""
    return F.year(_c(c)).cast("bigint")


def month_text(c) -> Column:
    """Two-digit month text."""
    return F.date_format(_c(c), "MM")


def date_text_or_empty(c, fmt: str = "dd-MM-yyyy") -> Column:
    """Date -> text, NULL -> ''."""
    return F.coalesce(F.date_format(_c(c), fmt), F.lit(""))


def lat_long_text(lat, lon) -> Column:
    """``lat,long`` text; NULL if either is NULL."""
    return F.concat(_c(lat).cast("string"), F.lit(","), _c(lon).cast("string"))
