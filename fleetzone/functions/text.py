"""Text helpers: year of a text date, labels, key parts, column names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def year_text(date_col) -> Column:
    """First four characters of a date as text (``"2018"``), NULL stays NULL."""
    return F.substring(_c(date_col).cast("string"), 1, 4)


def label(*parts, sep: str = "") -> Column:
    """Joined text label where a missing part reads ``NA`` (never NULL)."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("NA")) for c in cols])


def first_part(col, sep: str = ".") -> Column:
    """Text before the first ``sep`` (all of it when there is none)."""
    return F.substring_index(_c(col), sep, 1)


# Names that stay reserved after upper-casing and therefore
# get a trailing mark, as the name clean-up of the original analysis does.
RESERVED_UPPER = ("TRUE", "FALSE", "NULL", "NA")


def clean_name(name: str) -> str:
    """Upper-case a column name and make it a safe identifier.

    Characters other than letters, digits, ``_`` and ``.`` become ``_``; a
    dot also becomes ``_`` (it would need back-ticks in Spark).  A name that
    does not start with a letter gets an ``X`` prefix; reserved words get a
    trailing ``_``.
    """
    up = name.upper()
    out = re.sub(r"[^A-Z0-9_]", "_", up)
    if not out or not out[0].isalpha():
        out = "X" + out
    if out in RESERVED_UPPER:
        out += "_"
    return out


def clean_column_names(df: DataFrame) -> DataFrame:
    """Rename every column with ``clean_name`` (one projection, no data pass)."""
    return df.toDF(*[clean_name(c) for c in df.columns])
