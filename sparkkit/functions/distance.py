"""Distances as column expressions on two arrays (or on coordinates)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: mean radius of the earth in kilometres
EARTH_KM = 6371.0088


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(_total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def manhattan(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def minkowski(a: Column, b: Column, p: float = 2.0) -> Column:
    return F.pow(_total(F.zip_with(a, b, lambda x, y: F.pow(F.abs(x - y), F.lit(p)))), F.lit(1.0 / p))


def canberra(a: Column, b: Column) -> Column:
    """Terms whose denominator is zero count as zero."""
    def term(x, y):
        below = F.abs(x) + F.abs(y)
        return F.when(below == 0, F.lit(0.0)).otherwise(F.try_divide(F.abs(x - y), below))

    return _total(F.zip_with(a, b, term))


def cosine(a: Column, b: Column) -> Column:
    dot = _total(F.zip_with(a, b, lambda x, y: x * y))
    norms = F.sqrt(_total(F.transform(a, lambda x: x * x))) * F.sqrt(_total(F.transform(b, lambda x: x * x)))
    return 1.0 - F.try_divide(dot, norms)


def to_radians(lat: str, long: str) -> tuple[Column, Column]:
    return F.radians(F.col(lat)), F.radians(F.col(long))


def haversine(lat1: Column, long1: Column, lat2: Column, long2: Column) -> Column:
    """Angle in radians between two points given in radians; times `EARTH_KM` for kilometres."""
    h = F.pow(F.sin((lat2 - lat1) / 2), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((long2 - long1) / 2), 2)
    return 2 * F.asin(F.least(F.sqrt(h), F.lit(1.0)))


METRICS = {
    "euclidean": euclidean, "l2": euclidean, "manhattan": manhattan, "cityblock": manhattan, "l1": manhattan,
    "minkowski": minkowski, "canberra": canberra, "cosine": cosine,
}
