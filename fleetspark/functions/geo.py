"""Distances, point-in-ring tests and WKT, as column expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0

# WGS-84 ellipsoid.
WGS84_MAJOR_M = 6378137.0
WGS84_FLATTENING = 1 / 298.257223563


def milli(degrees: Column) -> Column:
    """Degrees as whole thousandths, an exact join key for 3-decimal coordinates."""
    return F.round(degrees * 1000).cast("int")


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lng = F.sin(F.radians(lng2 - lng1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lng * half_lng
    return 2 * EARTH_RADIUS_KM * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def vincenty_m(lat1: pd.Series, lng1: pd.Series, lat2: pd.Series, lng2: pd.Series) -> pd.Series:
    """Metres on the WGS-84 ellipsoid by Vincenty's inverse formula for series, to check ``geodesic_m`` with."""
    a, f = WGS84_MAJOR_M, WGS84_FLATTENING
    b = (1 - f) * a
    u1 = np.arctan((1 - f) * np.tan(np.radians(lat1.to_numpy(float))))
    u2 = np.arctan((1 - f) * np.tan(np.radians(lat2.to_numpy(float))))
    diff = np.radians(lng2.to_numpy(float) - lng1.to_numpy(float))
    lam = diff.copy()
    with np.errstate(all="ignore"):
        for _ in range(50):
            sin_s = np.hypot(
                np.cos(u2) * np.sin(lam),
                np.cos(u1) * np.sin(u2) - np.sin(u1) * np.cos(u2) * np.cos(lam),
            )
            cos_s = np.sin(u1) * np.sin(u2) + np.cos(u1) * np.cos(u2) * np.cos(lam)
            sigma = np.arctan2(sin_s, cos_s)
            sin_az = np.where(sin_s > 0, np.cos(u1) * np.cos(u2) * np.sin(lam) / sin_s, 0.0)
            cos2_az = 1 - sin_az**2
            mid = np.where(cos2_az > 1e-15, cos_s - 2 * np.sin(u1) * np.sin(u2) / cos2_az, 0.0)
            c = f / 16 * cos2_az * (4 + f * (4 - 3 * cos2_az))
            new = diff + (1 - c) * f * sin_az * (
                sigma + c * sin_s * (mid + c * cos_s * (2 * mid**2 - 1))
            )
            if np.nanmax(np.abs(new - lam), initial=0.0) < 1e-12:
                lam = new
                break
            lam = new
        k2 = cos2_az * (a**2 - b**2) / b**2
        big = 1 + k2 / 16384 * (4096 + k2 * (-768 + k2 * (320 - 175 * k2)))
        small = k2 / 1024 * (256 + k2 * (-128 + k2 * (74 - 47 * k2)))
        shift = small * sin_s * (
            mid
            + small / 4 * (cos_s * (2 * mid**2 - 1)
                           - small / 6 * mid * (4 * sin_s**2 - 3) * (4 * mid**2 - 3))
        )
        metres = b * big * (sigma - shift)
    return pd.Series(np.where(sin_s == 0, 0.0, metres), index=lat1.index)


def bound(value: Column, made) -> Column:
    """``made(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), made), F.lit(0))


STEPS = 50  # nearly antipodal points need more, or never settle
SETTLED = 1e-12


def geodesic_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Metres on the WGS-84 ellipsoid by Vincenty's inverse formula, as an expression.

    The longitude on the sphere is corrected until it settles, mostly in under ten steps. Where it does not in 50,
    within half a degree of the antipode, and for a null, the result is null.
    """
    a, f = WGS84_MAJOR_M, WGS84_FLATTENING
    b = (1 - f) * a
    reduced = lambda lat: F.atan((1 - f) * F.tan(F.radians(lat)))
    given = F.struct(
        F.sin(reduced(lat1)).alias("s1"), F.cos(reduced(lat1)).alias("c1"), F.sin(reduced(lat2)).alias("s2"),
        F.cos(reduced(lat2)).alias("c2"), F.radians(lng2 - lng1).alias("diff"))

    def arc(p: Column, lam: Column, made) -> Column:
        """``made`` of the arc between the points on the sphere, where its longitudes differ by ``lam``."""
        across, along = p.c2 * F.sin(lam), p.c1 * p.s2 - p.s1 * p.c2 * F.cos(lam)
        sides = F.struct(F.sqrt(across * across + along * along).alias("sin"), (p.s1 * p.s2 + p.c1 * p.c2 * F.cos(lam)).alias("cos"))

        def turned(q: Column) -> Column:
            # Equal points have no azimuth; along the equator there is no middle latitude.
            azimuth = F.coalesce(p.c1 * p.c2 * F.sin(lam) / F.nullif(q.sin, F.lit(0.0)), F.lit(0.0))
            return bound(azimuth, lambda z: bound(1 - z * z, lambda w: made(F.struct(
                q.sin.alias("sin"), q.cos.alias("cos"), F.atan2(q.sin, q.cos).alias("angle"), z.alias("azimuth"), w.alias("cos2"),
                F.when(w > 1e-15, q.cos - 2 * p.s1 * p.s2 / F.nullif(w, F.lit(0.0))).otherwise(0.0).alias("mid")))))

        return bound(sides, turned)

    def corrected(p: Column, q: Column) -> Column:
        c = f / 16 * q.cos2 * (4 + f * (4 - 3 * q.cos2))
        return bound(c, lambda c: p.diff + (1 - c) * f * q.azimuth * (
            q.angle + c * q.sin * (q.mid + c * q.cos * (2 * q.mid * q.mid - 1))))

    def step(p: Column, state: Column) -> Column:
        new = arc(p, state.lam, lambda q: bound(q, lambda q: corrected(p, q)))
        moved = bound(new, lambda n: F.struct(n.alias("lam"), (F.abs(n - state.lam) < SETTLED).alias("settled")))
        return F.when(state.settled, state).otherwise(moved)

    def metres(q: Column) -> Column:
        k = q.cos2 * ((a**2 - b**2) / b**2)
        big = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
        small = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
        twice = 2 * q.mid * q.mid - 1
        shift = small * q.sin * (q.mid + small / 4 * (
            q.cos * twice - small / 6 * q.mid * (4 * q.sin * q.sin - 3) * (4 * q.mid * q.mid - 3)))
        return b * big * (q.angle - shift)

    def solved(p: Column) -> Column:
        start = F.struct(p.diff.alias("lam"), F.lit(False).alias("settled"))
        last = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, lambda state, _: step(p, state))
        return bound(last, lambda s: F.when(s.settled, arc(p, s.lam, lambda q: bound(q, metres))))

    return bound(given, solved)


def ring_edges(rings: Column) -> Column:
    """array<ring<struct<x,y>>> to a flat array of edges; each ring is closed on itself."""

    def edges(ring: Column) -> Column:
        following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
        return F.zip_with(
            ring, following,
            lambda p, q: F.struct(p.x.alias("x1"), p.y.alias("y1"), q.x.alias("x2"), q.y.alias("y2")),
        )

    return F.flatten(F.transform(rings, edges))


def inside(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd test: is (x, y) inside the area bounded by ``edges``?"""
    crossed = F.filter(
        edges,
        lambda e: ((e.y1 > y) != (e.y2 > y))
        & (x < (e.x2 - e.x1) * (y - e.y1) / (e.y2 - e.y1) + e.x1),
    )
    return F.size(crossed) % 2 == 1


def wkt_point(lat: Column, lng: Column) -> Column:
    return F.concat(F.lit("POINT("), lng.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))


def swap_wkt_axes(wkt: Column) -> Column:
    """POINT(a b) to POINT(b a); anything else is left alone."""
    return F.regexp_replace(wkt, r"^POINT\s*\((\S+) (\S+)\)$", "POINT($2 $1)")
