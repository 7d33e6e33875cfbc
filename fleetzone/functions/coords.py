"""Degrees and minutes to signed decimal degrees (plain column maths)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def dms_to_decimal(degrees, minutes, hemisphere, axis: str) -> Column:
    """Signed decimal degrees from degrees, minutes and a hemisphere letter.

    ``axis`` is ``"lat"`` or ``"lon"``.  S and W are negative.  A missing
    or empty hemisphere is read as the usual one for the survey area (N for
    latitude, W for longitude), so N/W data gives the same numbers as the
    hemisphere-blind formula; any other letter gives NULL.  The sign comes
    from the hemisphere column, never from a column name.
    """
    if axis not in ("lat", "lon"):
        raise ValueError("axis must be 'lat' or 'lon'")
    positive, negative, usual = ("N", "S", "N") if axis == "lat" else ("E", "W", "W")
    h = F.coalesce(F.nullif(F.upper(F.trim(_c(hemisphere))), F.lit("")), F.lit(usual))
    value = _c(degrees) + _c(minutes) / F.lit(60.0)
    return F.when(h == negative, -value).when(h == positive, value)


def lat_dd(degrees, minutes, hemisphere) -> Column:
    return dms_to_decimal(degrees, minutes, hemisphere, "lat")


def lon_dd(degrees, minutes, hemisphere) -> Column:
    return dms_to_decimal(degrees, minutes, hemisphere, "lon")
