"""Explicit schemas of the input tables. Nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

# Magnetic field parameters of a series, in file order.
FIELD_PARAMETERS = [
    "TOTUSJH", "TOTBSQ", "TOTPOT", "TOTUSJZ", "ABSNJZH", "SAVNCPP", "USFLUX", "TOTFZ", "MEANPOT", "EPSZ", "MEANSHR",
    "SHRGT45", "MEANGAM", "MEANGBT", "MEANGBZ", "MEANGBH", "MEANJZH", "TOTFY", "MEANJZD", "MEANALP", "TOTFX", "EPSY",
    "EPSX", "R_VALUE",
]
# The other columns of a finished series, in their order.
POSITION_COLUMNS = ["CRVAL1", "CRLN_OBS", "CRLT_OBS", "CRVAL2", "HC_ANGLE", "SPEI", "IS_TMFI"]
BOX_COLUMNS = ["LAT_MIN", "LON_MIN", "LAT_MAX", "LON_MAX", "QUALITY"]
HISTORY_COLUMNS = [
    f"{c}FLARE{part}{mode}" for mode in ("", "_LOC") for c in "BCMX" for part in ("", "_LABEL")
]
FLUX_COLUMNS = ["XR_MAX", "XR_QUAL"]
FINAL_COLUMNS = FIELD_PARAMETERS + POSITION_COLUMNS + BOX_COLUMNS + HISTORY_COLUMNS + FLUX_COLUMNS


def text_schema(names: list[str]) -> T.StructType:
    """All columns as text; readers cast with ``try_cast`` so that bad fields become NULL."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


SERIES_RAW = T.StructType(
    [T.StructField("Timestamp", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in [*FIELD_PARAMETERS, "CRVAL1", "CRLN_OBS"]]
)
# Fields of a header row, the time first.
HEADER_FIELDS = [
    "DATE__OBS", "LAT_MIN", "LAT_MAX", "LON_MIN", "LON_MAX", "QUALITY", "CRPIX1", "CRPIX2", "IMCRPIX1", "IMCRPIX2", "CDELT1",
    "DSUN_OBS", "CRLT_OBS", "CRVAL2",
]
# Character positions in the yearly region file.
REGION_FIXED_WIDTH = [  # name, first character (1-based), length, type
    ("year", 1, 4, "int"), ("month", 5, 2, "int"), ("day", 7, 2, "int"), ("t_in_t", 9, 4, "double"), ("noaa_ar_no", 13, 8, "int"),
    ("greenwich", 21, 4, "string"), ("mcintosh", 26, 4, "string"), ("obs_whole_spot_area", 31, 4, "double"),
    ("number_of_spots", 36, 4, "double"), ("corr_whole_spot_area", 41, 4, "double"), ("distance_from_center", 46, 5, "double"),
    ("position_angle_north", 52, 5, "double"), ("carrington_longitude", 58, 5, "double"), ("latitude", 64, 5, "double"),
    ("central_meridian_dist", 70, 5, "double"),
]
