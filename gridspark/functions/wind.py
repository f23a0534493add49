"""Wind bearings as unit vectors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gridspark.dims import BEARING_DEGREES, lookup


def _component(function, bearing: Column, speed: Column) -> Column:
    value = F.round(function(F.radians(lookup(BEARING_DEGREES, bearing))), 4)
    # Calm air has no bearing; its vector is zero rather than unknown.
    return F.when(speed == 0, F.coalesce(value, F.lit(0.0))).otherwise(value)


def bearing_sin(bearing: Column, speed: Column) -> Column:
    return _component(F.sin, bearing, speed)


def bearing_cos(bearing: Column, speed: Column) -> Column:
    return _component(F.cos, bearing, speed)
