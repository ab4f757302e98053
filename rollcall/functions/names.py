"""File-name scalars (F1-F3) and header normalisation (I4).

F1-F3 are Column expressions over a column of file names. I4 works on header
strings, which are file metadata (one list per file), never data rows.
"""

from __future__ import annotations

import re
import unicodedata
from urllib.parse import unquote

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date inside a snapshot file name is the first
# DD[_-]MM[_-]YYYY group anywhere in the name.
DATE_IN_NAME = r"(\d{2})[_-](\d{2})[_-](\d{4})"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def name_pattern(words: list[str], optional: list[str] = (), extension: str = ".csv") -> str:
    """Pattern of a naming convention for F1: the words, any of the optional
    words in their order, the date and the extension, parted by blanks."""
    must = "".join(re.escape(w) + " " for w in words)
    may = "".join(f"(?:{re.escape(w)} )?" for w in optional)
    return "^" + must + may + DATE_IN_NAME + re.escape(extension) + "$"


def is_valid_name(c, pattern: str) -> Column:
    """whole-name match, case-insensitive including accented capitals."""
    return _c(c).rlike("(?iu)" + pattern)


def snapshot_date_of(c) -> Column:
    """first ``DD[_-]MM[_-]YYYY`` in the name -> DATE; none or an impossible
    date (``31_02_2025``) -> NULL."""
    # one regex evaluation: the whole first match ('' when none), separators
    # unified by a character translation, then a strict date parse
    found = F.regexp_extract(_c(c), DATE_IN_NAME, 0)
    return F.try_to_date(F.translate(found, "_", "-"), "dd-MM-yyyy")


def canonical_label(date_col, prefix: str, suffix: str = "") -> Column:
    """standard label ``<prefix>DD_MM_YYYY<suffix>`` from the snapshot date."""
    return F.concat(F.lit(prefix), F.date_format(_c(date_col), "dd_MM_yyyy"), F.lit(suffix))


def has_extension(c, ext: str) -> Column:
    """Keep one extension, case-insensitively."""
    return F.lower(_c(c)).endswith(ext.lower())


def normalise_header(name: str) -> str:
    """I4: a header as a column name: plain lower-case letters, digits and ``_``.

    Decomposed, an accent is a mark of its own and no word character, so it
    goes with the punctuation; blanks become ``_`` first.
    """
    return re.sub(r"\W", "", "_".join(unicodedata.normalize("NFKD", str(name)).strip().lower().split(" ")))


def normalise_headers(names: list[str]) -> list[str]:
    """I4 over a header; duplicates after normalisation raise."""
    out = [normalise_header(n) for n in names]
    dup = sorted({n for n in out if out.count(n) > 1})
    if dup:
        raise ValueError(f"headers collide after normalisation: {dup}")
    return out


def reader_path(uri: str) -> str:
    """A ``_metadata.file_path`` URI as a literal path for the reader: decoded
    and with glob characters escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))
