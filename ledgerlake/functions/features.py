"""Formulas of the fraud features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def net_amount(amount: Column, rate: Column) -> Column:
    """Amount after a discount rate (0.05 is 5 %), in exact decimal arithmetic."""
    keep = F.lit(1).cast("decimal(10,4)") - F.coalesce(rate.cast("decimal(10,4)"), F.lit(0).cast("decimal(10,4)"))
    return F.round(amount * keep, 2).cast("decimal(18,2)")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance. The inner term is clamped to [0, 1] against rounding."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    # least/greatest skip NULLs, so a missing coordinate must be kept missing explicitly
    clamped = F.when(a.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), a)))
    return F.lit(2.0 * radius) * F.asin(F.sqrt(clamped))


def features_valid(distance: str = "geo_distance_km", velocity: str = "velocity_1h") -> Column:
    return F.coalesce(F.col(distance).isNotNull() & (F.col(velocity) >= 1), F.lit(False))


def is_anomaly(
    v: int = 5, km: float = 500.0, distance: str = "geo_distance_km", velocity: str = "velocity_1h"
) -> Column:
    """Burst or far from home. A missing measure does not make a row anomalous."""
    return F.coalesce(F.col(velocity) >= v, F.lit(False)) | F.coalesce(F.col(distance) > km, F.lit(False))
