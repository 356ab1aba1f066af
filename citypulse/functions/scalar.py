"""Scalar column expressions shared by the operators.

Everything here returns a ``Column`` made of built-in Spark functions, so
expressions stay inside whole-stage codegen and are ANSI-safe (no
division by zero, no failing casts or map lookups).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from citypulse import contract as C

__all__ = [
    "col_or", "hour_from_hhmm", "weekday_mon0", "is_weekend_expr",
    "report_lag_days_expr", "part_of_day_expr", "clean_age_expr",
    "victim_sex_expr", "in_bbox_expr", "flag_in", "status_group_expr",
    "parse_ts_ntz", "cyclic_sin", "cyclic_cos", "haversine_km", "safe_ratio",
]


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_from_hhmm(c) -> Column:
    """HHMM integer -> hour 0..23 (null -> 0, floor division, clipped)."""
    hh = F.floor(F.coalesce(col_or(c), F.lit(0)).cast("bigint") / F.lit(100))
    return F.greatest(F.lit(0), F.least(F.lit(23), hh)).cast("int")


def weekday_mon0(c) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(col_or(c)).cast("int")


def is_weekend_expr(dow) -> Column:
    return F.coalesce(col_or(dow).isin(5, 6), F.lit(False))


def report_lag_days_expr(reported, occurred) -> Column:
    """Whole days between two timestamps, floored (-1 hour -> -1)."""
    secs = F.timestamp_diff("SECOND", col_or(occurred), col_or(reported))
    return F.floor(secs / F.lit(86400)).cast("bigint")


def _hour_labels() -> list[str]:
    """Label of each hour 0..23 from the right-closed bins (-1,5] (5,11] ..."""
    labels = []
    for h in range(24):
        labels.append(next(lab for upper, lab in C.PART_OF_DAY if h <= upper))
    return labels


def part_of_day_expr(hour) -> Column:
    """Part-of-day label for an hour in 0..23 (null outside), as one lookup
    into a 24-entry literal array: the hour expression is evaluated once."""
    h = col_or(hour)
    table = F.array(*[F.lit(x) for x in _hour_labels()])
    return F.when(h.between(0, 23), F.element_at(table, h.cast("int") + 1))


def clean_age_expr(age) -> Column:
    a = col_or(age).cast("int")
    return F.when((a > 0) & (a <= 110), a).cast("int")


def victim_sex_expr(sex) -> Column:
    u = F.upper(col_or(sex))
    return F.when(u.isin("M", "F"), u).otherwise(F.lit("Unknown"))


def in_bbox_expr(lat, lon, bbox=None) -> Column:
    b = bbox or C.BBOX
    inside = (col_or(lat).between(b["lat_min"], b["lat_max"])
              & col_or(lon).between(b["lon_min"], b["lon_max"]))
    return F.coalesce(inside, F.lit(False))


def flag_in(c, values) -> Column:
    """1 when the value is in the set, else 0 (null -> 0)."""
    return F.coalesce(col_or(c).isin(list(values)), F.lit(False)).cast("int")


def status_group_expr(status, mapping=None) -> Column:
    m = mapping or C.STATUS_MAP
    s = col_or(status)
    expr = None
    for code, label in m.items():
        expr = F.when(s == code, label) if expr is None else expr.when(s == code, label)
    return expr.otherwise(F.lit("Unknown"))


def parse_ts_ntz(c, fmt: str = C.RAW_DATE_FORMAT) -> Column:
    """Parse text to TIMESTAMP_NTZ; unparsable text -> null (ANSI-safe)."""
    s = col_or(c)
    ok = F.try_to_timestamp(s, F.lit(fmt)).isNotNull()
    return F.when(ok, F.to_timestamp_ntz(s, F.lit(fmt)))


def cyclic_sin(c, period: float) -> Column:
    return F.sin(F.lit(2 * math.pi) * col_or(c).cast("double") / F.lit(float(period)))


def cyclic_cos(c, period: float) -> Column:
    return F.cos(F.lit(2 * math.pi) * col_or(c).cast("double") / F.lit(float(period)))


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = C.EARTH_RADIUS_KM) -> Column:
    p1, p2 = F.radians(col_or(lat1)), F.radians(col_or(lat2))
    dphi = p2 - p1
    dlmb = F.radians(col_or(lon2)) - F.radians(col_or(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * radius_km) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def safe_ratio(num, den) -> Column:
    """num / den with 0 when the denominator is 0 or null."""
    return F.coalesce(F.try_divide(col_or(num).cast("double"), col_or(den).cast("double")),
                      F.lit(0.0))
