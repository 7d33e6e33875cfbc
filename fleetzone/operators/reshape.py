"""Reshaping: pivots, unpivot of position pairs, unions by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_wide(df: DataFrame, id_cols: list[str], names_from: str, values_from: str,
               names: list) -> DataFrame:
    """One column per value of ``names_from``, in the order of ``names``.

    ``names`` must be given: a pivot without them would run ``df`` once more
    to find them.  Missing cells stay NULL.
    """
    return (df.groupBy(*id_cols).pivot(names_from, names)
              .agg(F.first(values_from, ignorenulls=False)))


def unpivot_positions(df: DataFrame, id_col: str, pairs: dict[str, tuple[str, str]],
                      lat: str = "lat_dd", lon: str = "lon_dd",
                      kind: str = "location_type") -> DataFrame:
    """Long form of several (lat, lon) pairs: ``(id, lat, lon, kind)``.

    One ``stack`` generator (no union of four scans).  Rows whose pair is
    all NULL are kept here; drop them with ``na.drop`` when needed.
    """
    parts = []
    for name, (la, lo) in pairs.items():
        parts += [f"'{name}'", f"`{la}`", f"`{lo}`"]
    expr = f"stack({len(pairs)}, {', '.join(parts)}) as (`{kind}`, `{lat}`, `{lon}`)"
    return df.select(id_col, F.expr(expr)).select(id_col, lat, lon, kind)


def union_by_name(*dfs: DataFrame, string_cols: list[str] = ()) -> DataFrame:
    """Append frames by column name; id columns are cast to STRING first."""
    out = None
    for d in dfs:
        for c in string_cols:
            if c in d.columns:
                d = d.withColumn(c, F.col(c).cast("string"))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out
