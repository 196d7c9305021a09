"""Positions on the solar disc: text forms, coordinate changes, rotation, distances."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .times import micros

NUMBER = r"([+-]?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)"
POINT_PATTERN = rf"^(?:POINT\({NUMBER} {NUMBER}\)|\({NUMBER}, {NUMBER}\))$"
COMPASS_PATTERN = r"^\s*([NS])(\d+)([EW])(\d+)"
NO_LOCATION = "(0, 0)"

# Differential rotation in degrees per day.
ROTATION_A = 14.11
ROTATION_B = -1.7
ROTATION_C = -2.35

# Solar radius and astronomical unit in km, tilt of the solar axis in degrees.
SOLAR_RADIUS_KM = 695_700.0
AU_KM = 149_597_870.7
AXIS_TILT_DEG = 7.25
VIEW = ("__sun_distance", "__sun_tilt")
ARCSEC = 3600.0 * 180.0 / math.pi


def _group(text: Column, pattern: str, index: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, index), F.lit(""))


def parse_point(text: Column) -> tuple[Column, Column]:
    """(lon, lat) of ``POINT(lon lat)`` or ``(lon, lat)``; NULL for any other text."""
    lon = F.coalesce(_group(text, POINT_PATTERN, 1), _group(text, POINT_PATTERN, 3)).try_cast("double")
    lat = F.coalesce(_group(text, POINT_PATTERN, 2), _group(text, POINT_PATTERN, 4)).try_cast("double")
    return lon, lat


def parse_compass(text: Column, east_sign: int = -1) -> tuple[Column, Column]:
    """(lon, lat) of ``N16W54``; west is positive unless ``east_sign`` is 1."""
    lat = _group(text, COMPASS_PATTERN, 2).try_cast("double")
    lon = _group(text, COMPASS_PATTERN, 4).try_cast("double")
    lat = F.when(_group(text, COMPASS_PATTERN, 1) == "S", -lat).otherwise(lat)
    east = _group(text, COMPASS_PATTERN, 3) == "E"
    lon = F.when(east, lon * east_sign).otherwise(lon * -east_sign)
    return lon, lat


def format_point(lon: Column, lat: Column, style: str = "point") -> Column:
    """Text ``POINT(lon lat)`` or, with ``style='pair'``, ``(lon, lat)``."""
    if style == "point":
        return F.concat(F.lit("POINT("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))
    return F.concat(F.lit("("), lon.cast("string"), F.lit(", "), lat.cast("string"), F.lit(")"))


def disc_xy(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Position on the unit disc seen from straight above (0, 0)."""
    return F.sin(F.radians(lon)) * F.cos(F.radians(lat)), F.sin(F.radians(lat))


def with_earth_view(df: DataFrame, ts: str) -> DataFrame:
    """Add Sun-Earth distance in solar radii and tilt B0 in radians at ``ts`` (columns of ``VIEW``).

    Low-precision solar position (Meeus, Astronomical Algorithms, chapters 25 and 29), staged over
    columns so that each intermediate value is computed once.
    """
    c, m, e = F.col("__century"), F.col("__anomaly"), F.col("__centre")
    staged = df.withColumn("__century", (micros(F.col(ts)) / F.lit(86_400_000_000.0) - F.lit(10_957.5)) / F.lit(36_525.0))
    staged = staged.withColumn("__anomaly", F.radians(F.lit(357.52911) + c * 35_999.05029 - c * c * 0.0001537))
    centre = (
        (F.lit(1.914602) - c * 0.004817 - c * c * 0.000014) * F.sin(m)
        + (F.lit(0.019993) - c * 0.000101) * F.sin(m * 2)
        + F.lit(0.000289) * F.sin(m * 3)
    )
    staged = staged.withColumn("__centre", centre)
    eccentricity = F.lit(0.016708634) - c * 0.000042037 - c * c * 0.0000001267
    distance_au = F.lit(1.000001018) * (F.lit(1.0) - eccentricity * eccentricity) / (
        F.lit(1.0) + eccentricity * F.cos(m + F.radians(e))
    )
    longitude = F.radians(F.lit(280.46646) + c * 36_000.76983 + c * c * 0.0003032 + e - 0.00569)
    node = F.radians(F.lit(73.6667) + (c * 36_525.0 + 2_451_545.0 - 2_396_758.0) * (1.3958333 / 36_525.0))
    tilt = F.asin(F.sin(longitude - node) * math.sin(math.radians(AXIS_TILT_DEG)))
    staged = staged.withColumns({VIEW[0]: distance_au * (AU_KM / SOLAR_RADIUS_KM), VIEW[1]: tilt})
    return staged.drop("__century", "__anomaly", "__centre")


def hgs_to_hpc(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Stonyhurst degrees to helioprojective arcseconds as seen from Earth; needs ``with_earth_view``."""
    distance, tilt = (F.col(c) for c in VIEW)
    l, b = F.radians(lon), F.radians(lat)
    x = F.cos(b) * F.sin(l)
    y = F.sin(b) * F.cos(tilt) - F.cos(b) * F.cos(l) * F.sin(tilt)
    depth = distance - (F.sin(b) * F.sin(tilt) + F.cos(b) * F.cos(l) * F.cos(tilt))
    tx = F.atan2(x, depth)
    ty = F.asin(y / F.sqrt(x * x + y * y + depth * depth))
    return tx * ARCSEC, ty * ARCSEC


def hpc_to_hgs(tx: Column, ty: Column) -> tuple[Column, Column]:
    """Inverse of ``hgs_to_hpc`` on the visible side; NULL off the disc; needs ``with_earth_view``."""
    distance, tilt = (F.col(c) for c in VIEW)
    px, py = tx / ARCSEC, ty / ARCSEC
    along = distance * F.cos(px) * F.cos(py)
    radicand = along * along - distance * distance + 1.0
    ray = along - F.sqrt(F.when(radicand >= 0, radicand))
    x = ray * F.cos(py) * F.sin(px)
    y = ray * F.sin(py)
    z = distance - ray * F.cos(py) * F.cos(px)
    lat = F.asin(y * F.cos(tilt) + z * F.sin(tilt))
    lon = F.atan2(x, z * F.cos(tilt) - y * F.sin(tilt))
    return F.degrees(lon), F.degrees(lat)


def add_hpc(df: DataFrame, lon: str, lat: str, ts: str, out: tuple[str, str] = ("x_hpc", "y_hpc")) -> DataFrame:
    """Rows with the helioprojective position of a Stonyhurst position."""
    x, y = hgs_to_hpc(F.col(lon), F.col(lat))
    return with_earth_view(df, ts).withColumns({out[0]: x, out[1]: y}).drop(*VIEW)


def add_hgs(df: DataFrame, x: str, y: str, ts: str, out: tuple[str, str] = ("fl_lon", "fl_lat")) -> DataFrame:
    """Rows with the Stonyhurst position of a helioprojective position."""
    lon, lat = hpc_to_hgs(F.col(x), F.col(y))
    return with_earth_view(df, ts).withColumns({out[0]: lon, out[1]: lat}).drop(*VIEW)


def rotation_lon_delta(lat: Column, days: Column) -> Column:
    """Longitude gained by solar rotation at a latitude over a number of days."""
    s2 = F.pow(F.sin(F.radians(lat)), F.lit(2.0))
    return (F.lit(ROTATION_A) + s2 * ROTATION_B + s2 * s2 * ROTATION_C) * days


def advance_centroid(lon: Column, lat: Column, days: Column, clamp: float | None = None) -> Column:
    """Longitude of a region ``days`` after its record, optionally kept inside +-``clamp``."""
    moved = lon + rotation_lon_delta(lat, days)
    if clamp is None:
        return moved
    bounded = F.greatest(F.least(moved, F.lit(float(clamp))), F.lit(-float(clamp)))
    return F.when(moved.isNotNull(), bounded)


def great_circle_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Central angle between two points in degrees."""
    a, b = F.radians(lat1), F.radians(lat2)
    dl = F.radians(lon1) - F.radians(lon2)
    across = F.cos(b) * F.sin(dl)
    up = F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(dl)
    inner = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(dl)
    return F.degrees(F.atan2(F.sqrt(across * across + up * up), inner))


def heliocentric_angle(crval1: Column, crval2: Column, crln_obs: Column, crlt_obs: Column) -> Column:
    """Angle between a patch centre and the disc centre in degrees."""
    return great_circle_deg(crval2 - crlt_obs, crval1 - crln_obs, F.lit(0.0), F.lit(0.0))


def trust_flags(angle: Column, quality: Column, limit: float = 70.0) -> tuple[Column, Column]:
    """(inside the trusted disc, trusted field information); never NULL."""
    inside = F.coalesce(angle < limit, F.lit(False))
    return inside, inside & F.coalesce(quality == 0, F.lit(False))


def consolidate_location(*texts: Column, missing: str = NO_LOCATION) -> tuple[Column, Column, Column]:
    """First usable location text with its longitude and latitude."""
    text = F.coalesce(*[F.nullif(t, F.lit(missing)) for t in texts])
    return (text, *parse_point(text))


def fill_location_from_centroid(text: Column, centroid: Column) -> tuple[Column, Column, Column]:
    """Own location, or the centroid where the own text marks a missing one."""
    filled = F.when(text == NO_LOCATION, centroid).otherwise(text)
    return (filled, *parse_point(filled))


def location_with_source(
    df: DataFrame, own: tuple[str, str, str], second: tuple[str, str], third: tuple[str, str], ts: str
) -> DataFrame:
    """Own location (text, lon, lat columns), else the second source's x and y, else the third's, with a tag."""
    text, own_lon, own_lat = own
    has_own, has_second, has_third = (F.col(c).isNotNull() for c in (text, second[0], third[0]))
    x = F.when(has_second, F.col(second[0])).otherwise(F.col(third[0]))
    y = F.when(has_second, F.col(second[1])).otherwise(F.col(third[1]))
    moved = add_hgs(df.withColumns({"__lx": x, "__ly": y}), "__lx", "__ly", ts, ("__lon", "__lat"))
    lon = F.when(has_own, F.col(own_lon)).otherwise(F.col("__lon"))
    lat = F.when(has_own, F.col(own_lat)).otherwise(F.col("__lat"))
    source = F.when(has_own, "GOES").when(has_second, "SSW").when(has_third, "XRT").otherwise("NoLocation")
    shown = F.when(has_own, F.col(text)).otherwise(format_point(F.col("__lon"), F.col("__lat"), style="pair"))
    out = moved.withColumns({"__text": shown, "__flon": lon, "__flat": lat, "fl_loc_src": source})
    return out.drop("fl_location", "fl_lon", "fl_lat", "__lx", "__ly", "__lon", "__lat").withColumnsRenamed(
        {"__text": "fl_location", "__flon": "fl_lon", "__flat": "fl_lat"}
    )


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Euclidean distance; NULL when a coordinate is missing."""
    return F.sqrt(F.pow(x1 - x2, F.lit(2.0)) + F.pow(y1 - y2, F.lit(2.0)))


def minkowski_within(
    x1: Column, y1: Column, x2: Column, y2: Column, threshold: float, order: float = 2.0, null_is_match: bool = True
) -> Column:
    """Lp distance below a threshold; a missing coordinate counts as a match."""
    total = F.pow(F.abs(x1 - x2), F.lit(float(order))) + F.pow(F.abs(y1 - y2), F.lit(float(order)))
    near = F.pow(total, F.lit(1.0 / order)) < threshold
    return F.coalesce(near, F.lit(null_is_match))


def has_location(text: Column) -> Column:
    """Location text is given and not the missing marker."""
    return F.coalesce(text != NO_LOCATION, F.lit(False))
