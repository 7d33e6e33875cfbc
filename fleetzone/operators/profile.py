"""Profiling and checks: tallies, missing-value profiles, reconciliation."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.na import n_distinct


def frequency_table(df: DataFrame, col: str) -> DataFrame:
    """``table(x)``: count per value, missing values left out."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def columns_matching(df: DataFrame, pattern: str) -> list[str]:
    """Column names matching a regular expression (searched, not anchored)."""
    rx = re.compile(pattern)
    return [c for c in df.columns if rx.search(c)]


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: missing and present counts, as rows.

    One aggregate pass computes every count; ``stack`` turns the single
    result row into one row per column.
    """
    aggs = []
    for c in cols:
        isnull = F.col(c).isNull()
        if dict(df.dtypes)[c] in ("double", "float"):
            isnull = isnull | F.isnan(F.col(c))
        aggs += [F.sum(isnull.cast("bigint")).alias(f"m__{c}"),
                 F.sum((~isnull).cast("bigint")).alias(f"p__{c}")]
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{c}', coalesce(`m__{c}`, 0L), coalesce(`p__{c}`, 0L)" for c in cols)
    return wide.select(F.expr(f"stack({len(cols)}, {parts}) as (column_name, n_missing, n_present)"))


def value_tally(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column and value: row count (missing values left out)."""
    parts = ", ".join(f"'{c}', cast(`{c}` as string)" for c in cols)
    long = df.select(F.expr(f"stack({len(cols)}, {parts}) as (column_name, value)"))
    return (long.where(F.col("value").isNotNull()).groupBy("column_name", "value")
                .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def reconcile(left: DataFrame, right: DataFrame, key: str, measures: list[str]) -> DataFrame:
    """Full outer join of two per-key count tables plus a difference per
    measure (``left - right``).  Keys match null-safely."""
    l = left.select(F.col(key).alias("__lk"), *[F.col(m).alias(f"{m}_a") for m in measures])
    r = right.select(F.col(key).alias("__rk"), *[F.col(m).alias(f"{m}_b") for m in measures])
    j = l.join(r, l["__lk"].eqNullSafe(r["__rk"]), "full_outer")
    cols = [F.coalesce("__lk", "__rk").alias(key)]
    for m in measures:
        cols += [F.col(f"{m}_a"), F.col(f"{m}_b"), (F.col(f"{m}_a") - F.col(f"{m}_b")).alias(f"{m}_diff")]
    return j.select(*cols)


def preview(df: DataFrame, order_by: list[str], n: int = 6) -> DataFrame:
    """First ``n`` rows in a stated order (a top-n, never a bare ``limit``)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(n)
