"""Catalogue integration: primary events matched to two secondary sources and verified."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import normalize_key_number_offset, numeric_coerce
from ..functions.places import (
    add_hpc, consolidate_location, distance, fill_location_from_centroid, format_point, location_with_source, parse_compass,
)
from ..functions.times import combine_date_and_time, fix_midnight_rollover, parse_time
from ..operators.asof import attach_centroid
from ..operators.interval import EVENT, match_two_sources, verify_matches
from ..session import materialize

NO_POINT = "POINT(nan nan)"


def prepare_secondary(events: DataFrame, location: str = "ssw_location") -> DataFrame:
    """Numbers plus 10000, rows without a point dropped, location parsed and seen from Earth."""
    rows = events.where(F.coalesce(F.col(location) != NO_POINT, F.lit(True)))
    text, lon, lat = consolidate_location(F.col(location))
    rows = rows.withColumns({
        "noaa_active_region": normalize_key_number_offset(F.col("noaa_active_region")),
        "fl_location": text, "fl_lon": lon, "fl_lat": lat,
    })
    return add_hpc(rows, "fl_lon", "fl_lat", "start_time")


def prepare_primary(events: DataFrame, regions: DataFrame, region_key: str = "region_number", region_time: str = "date") -> DataFrame:
    """Missing locations filled from the region's moved centre, then seen from Earth."""
    keyed = regions.withColumnRenamed(region_key, "noaa_active_region")
    located = attach_centroid(events, keyed, ["noaa_active_region"], "peak_time", region_time)
    text, lon, lat = fill_location_from_centroid(F.col("goes_location"), F.col("centroid"))
    located = located.withColumns({"fl_location": text, "fl_lon": lon, "fl_lat": lat})
    return add_hpc(located, "fl_lon", "fl_lat", "start_time").drop("centroid", "centroid_lon", "centroid_lat")


def assemble_match_table(
    primary: DataFrame, second: DataFrame, third: DataFrame, threshold: float = 275.0, near: float = 50.0,
    radius: float | None = 275.0,
) -> DataFrame:
    """The integrated catalogue: one row per primary event with its matches, flags and location.

    All inputs have id, start_time, peak_time, end_time, goes_class, x_hpc, y_hpc and noaa_active_region; the primary
    also fl_location, fl_lon and fl_lat.
    """
    def matching(df: DataFrame, name: str) -> DataFrame:
        """The few columns the matching reads, stored once: several searches use them."""
        return materialize(df.withColumnsRenamed({"x_hpc": "x", "y_hpc": "y", "noaa_active_region": "ar"}).select(*EVENT), name)

    found = match_two_sources(
        matching(primary, "primary-points"), matching(second, "second-points"), matching(third, "third-points"), near, radius
    )
    flat = found.select(
        "id", F.col("second.id").alias("ssw_flare_id"), F.col("second_dist").alias("min_ssw_dist"),
        F.col("second.x").alias("ssw_x_hpc"), F.col("second.y").alias("ssw_y_hpc"), F.col("second.ar").alias("ssw_ar"),
        F.col("third.id").alias("hinode_flare_id"), F.col("third_dist").alias("min_hinode_dist"),
        F.col("third.x").alias("hinode_x_hpc"), F.col("third.y").alias("hinode_y_hpc"), F.col("third.ar").alias("hinode_ar"),
    )
    table = primary.join(flat, "id", "left")
    pair = distance(F.col("ssw_x_hpc"), F.col("ssw_y_hpc"), F.col("hinode_x_hpc"), F.col("hinode_y_hpc"))
    table = verify_matches(table.withColumn("ssw_hinode_dist", pair), "min_ssw_dist", "min_hinode_dist", "ssw_hinode_dist", threshold)
    table = location_with_source(
        table, ("fl_location", "fl_lon", "fl_lat"), ("ssw_x_hpc", "ssw_y_hpc"), ("hinode_x_hpc", "hinode_y_hpc"), "peak_time"
    )
    ars = F.array(*[F.col(c).cast("int") for c in ("noaa_active_region", "ssw_ar", "hinode_ar")])
    return table.withColumn("candidate_ars", ars)


def clean_scraped_events(raw: DataFrame, time_format: str = "yyyy/MM/dd HH:mm:ss") -> DataFrame:
    """Scraped event rows to catalogue rows.

    Peak and stop come as clock times and take the start's date, passing midnight where needed.
    The region number stands in parentheses and is 0 when unreadable; the compass position becomes a point text.
    """
    start = parse_time(F.trim("Start"), time_format)
    peak = combine_date_and_time(F.col("Start"), F.col("Peak"), time_format)
    end = combine_date_and_time(F.col("Start"), F.col("Stop"), time_format)
    timed = raw.withColumns({"start_time": start, "peak_time": peak, "end_time": end})
    fixed_peak, fixed_end = fix_midnight_rollover(F.col("start_time"), F.col("peak_time"), F.col("end_time"))
    timed = timed.withColumns({"end_time": fixed_end, "peak_time": fixed_peak})
    lon, lat = parse_compass(F.col("Derived Position"))
    number = numeric_coerce(F.regexp_replace("NOAA_AR", "[() ]", ""), "bigint")
    timed = timed.withColumns({
        "noaa_active_region": F.coalesce(number, F.lit(0)), "goes_class": F.col("GOES Class"),
        "goes_location": format_point(lon.cast("int"), lat.cast("int")),
    })
    return timed.drop("Derived Position", "Peak", "Start", "Stop", "GOES Class", "NOAA_AR")
