"""Missing-value rules (one place for all of them).

The analyses this library reproduces were written against data-frame
semantics where a missing value behaves differently from SQL NULL.  Each
helper below returns a plain Spark ``Column`` (JVM side, code-generated)
that gives the data-frame answer:

* ``n_distinct``            distinct count that counts NULL as one value
* ``n_distinct_where``      the same, over the rows where a test is true
* ``sum_strict``            a sum that is NULL as soon as one input is NULL
* ``sum_skip``              a sum that skips NULL and gives 0 for none
* ``if_else``               a conditional whose NULL test gives NULL
* ``share``                 ``round(part / whole, 2)`` with ties to even, exact
* ``fill_missing``          NULL and NaN to 0 (numbers) and "0" (text)

Grouping keeps NULL as a group and filters drop NULL tests: Spark already
does both, so nothing is needed for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def n_distinct(col: Column | str) -> Column:
    """Distinct count with NULL counted as one more value (BIGINT)."""
    c = _c(col)
    has_null = F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))
    return (F.count_distinct(c) + has_null).cast("bigint")


def n_distinct_where(test: Column, col: Column | str) -> Column:
    """``n_distinct`` over the rows where ``test`` is true.

    Fusing several filtered distinct counts into one aggregate replaces
    one aggregate (and one join) per filter.  A NULL test drops the row,
    as a filter would.
    """
    c = _c(col)
    keep = F.coalesce(test, F.lit(False))
    has_null = F.coalesce(F.max((keep & c.isNull()).cast("int")), F.lit(0))
    return (F.count_distinct(F.when(keep, c)) + has_null).cast("bigint")


def sum_strict(col: Column | str) -> Column:
    """Sum that is NULL when any input is NULL (data-frame ``sum``)."""
    c = _c(col)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def sum_skip(col: Column | str) -> Column:
    """Sum that skips NULL; all-NULL (or no rows) gives 0."""
    c = _c(col)
    return F.coalesce(F.sum(c), F.lit(0).cast(T.DecimalType(1, 0)))


def if_else(test: Column, yes, no) -> Column:
    """``ifelse``: NULL test gives NULL, not the ``no`` branch."""
    yes_c = yes if isinstance(yes, Column) else F.lit(yes)
    no_c = no if isinstance(no, Column) else F.lit(no)
    return F.when(test.isNull(), F.lit(None)).when(test, yes_c).otherwise(no_c)


def share(part: Column | str, whole: Column | str, digits: int = 2,
          scale: int = 0) -> Column:
    """``round(part / whole, digits)`` with ties to even, computed exactly.

    ``part`` and ``whole`` are non-negative counts or fixed-point amounts
    with ``scale`` decimals (money in DECIMAL(p, 2) uses ``scale=2``).  Both
    are turned into whole units so the quotient and remainder are exact
    integers; a remainder of exactly half goes to the even neighbour.  A
    zero or NULL ``whole`` gives NULL.  Result: DOUBLE.
    """
    unit = 10 ** scale
    p = (_c(part) * F.lit(unit)).cast(T.DecimalType(38, 0))
    w = (_c(whole) * F.lit(unit)).cast(T.DecimalType(38, 0))
    scaled = p * F.lit(10 ** digits)
    q = _int_div(scaled, w)
    r = scaled - q * w
    bump = (F.lit(2) * r > w) | ((F.lit(2) * r == w) & (q % 2 == 1))
    rounded = q + bump.cast("bigint")
    return F.when(w == 0, F.lit(None).cast("double")).otherwise(
        rounded.cast("double") / F.lit(float(10 ** digits)))


def _int_div(a: Column, b: Column) -> Column:
    """Truncating integer division of two exact integers (BIGINT result)."""
    return F.when(b == 0, F.lit(None).cast("bigint")).otherwise(
        (a - a % b) / b).cast("bigint")


def fill_missing(df: DataFrame) -> DataFrame:
    """NULL/NaN to 0 in numeric columns and to "0" in text columns."""
    return df.na.fill(0).na.fill("0")


def sum_strict_where(test: Column, col: Column | str) -> Column:
    """``sum_strict`` over the rows where ``test`` is true."""
    c = _c(col)
    keep = F.coalesce(test, F.lit(False))
    return F.when(F.count(F.when(keep, c)) == F.count(F.when(keep, F.lit(1))),
                  F.sum(F.when(keep, c)))


def sum_skip_where(test: Column, col: Column | str) -> Column:
    """``sum_skip`` over the rows where ``test`` is true."""
    c = _c(col)
    keep = F.coalesce(test, F.lit(False))
    return F.coalesce(F.sum(F.when(keep, c)), F.lit(0).cast(T.DecimalType(1, 0)))
