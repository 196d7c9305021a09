"""As-of joins: nearest, previous and next record in time, per key."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.places import advance_centroid, disc_xy, distance, format_point, parse_compass
from ..functions.times import micros, us
from ..sources.schemas import HEADER_FIELDS
from .scan import CELL, T, carry_scan, halo_scan

SIDE, LEFT, RIGHT = "__side", "__left", "__right"


def _both_sides(left, right, by, left_on, right_on, cols, unique) -> DataFrame:
    """One table of left rows (side 1) and right rows (side 0) on a shared time axis.

    A missing key matches nothing: such right rows go, and such left rows get no place on the axis, which spreads
    them over many cells and gives NULL columns in the end.
    """
    record = F.struct(F.col(right_on).alias("__ts"), *[F.col(c) for c in cols])
    keyed = F.lit(True)
    for c in by:
        keyed = keyed & F.col(c).isNotNull()
    recs = right.where(keyed & F.col(right_on).isNotNull()).select(*by, micros(F.col(right_on)).alias(T), record.alias(RIGHT))
    if unique:
        recs = recs.groupBy(*by, T).agg(F.min(RIGHT).alias(RIGHT), F.count(F.lit(1)).alias("__dups"))
    else:
        recs = recs.withColumn("__dups", F.lit(1).cast("long"))
    recs = recs.select(*by, T, F.lit(0).alias(SIDE), F.struct(RIGHT, "__dups").alias(RIGHT))
    rows = left.select(*by, F.when(keyed, micros(F.col(left_on))).alias(T), F.lit(1).alias(SIDE), F.struct("*").alias(LEFT))
    return rows.unionByName(recs, allowMissingColumns=True)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    left_on: str,
    right_on: str,
    cols: list[str],
    *,
    direction: str = "nearest",
    tolerance: timedelta | None = None,
    closed: bool = True,
    tie: str = "later",
    prefix: str = "",
    match_time: str | None = None,
    delta_days: str | None = None,
    cell: timedelta = CELL,
    most: int | None = None,
) -> DataFrame:
    """Every left row with the columns of one right row of the same key, NULL when none fits.

    ``direction``: ``nearest``, ``prev`` (at or before) or ``next`` (strictly after).
    ``tolerance`` limits the distance, inclusive when ``closed``. ``tie`` decides between an
    earlier and a later row at the same distance: ``later``, ``earlier`` or ``null``; with
    ``null`` several right rows at the chosen time also give NULL.
    ``match_time`` and ``delta_days`` name optional outputs: the time of the right row and its
    signed distance in days. ``most`` bounds the rows of a time cell: crowded cells are cut at measured times.
    """
    both = _both_sides(left, right, by, left_on, right_on, cols, unique=tie == "null")
    order = (SIDE, RIGHT)
    source = F.col(RIGHT)
    if tolerance is not None and most is None:
        scanned = halo_scan(both, by, source, us(tolerance), order=order, cell=cell)
    else:
        want = {"nearest": ("prev", "next"), "prev": ("prev",), "next": ("next",)}[direction]
        scanned = carry_scan(both, by, {"r": source}, order=order, want=want, cell=cell, sparse=True, most=most)

    scanned = scanned.where(F.col(SIDE) == 1)
    have = set(scanned.columns)
    prev = F.col("prev_r") if "prev_r" in have else None
    nxt = F.col("next_r") if "next_r" in have else None
    if direction == "prev":
        chosen = prev
    elif direction == "next":
        chosen = nxt
    else:
        back, ahead = F.col(T) - prev[T], nxt[T] - F.col(T)
        take_next = prev.isNull() | F.coalesce((ahead < back) | ((ahead == back) & F.lit(tie == "later")), F.lit(False))
        chosen = F.when(take_next, nxt).otherwise(prev)
        if tie == "null":
            chosen = F.when(F.coalesce(ahead == back, F.lit(False)), None).otherwise(chosen)
    scanned = scanned.withColumn("__hit", F.when(F.col(T).isNotNull(), chosen))
    gap = F.abs(F.col(f"__hit.{T}") - F.col(T))
    usable = F.col("__hit").isNotNull()
    if tolerance is not None:
        limit = us(tolerance)
        usable = usable & ((gap <= limit) if closed else (gap < limit))
    if tie == "null":
        usable = usable & (F.col("__hit.v.__dups") == 1)
    record = F.when(usable, F.col(f"__hit.v.{RIGHT}"))
    out = scanned.withColumn("__rec", record)
    extra = [F.col(f"__rec.{c}").alias(prefix + c) for c in cols]
    if match_time:
        extra.append(F.col("__rec.__ts").alias(match_time))
    if delta_days:
        signed = (F.col(f"__hit.{T}") - F.col(T)) / F.lit(86_400_000_000.0)
        extra.append(F.when(usable, signed).alias(delta_days))
    return out.select(f"{LEFT}.*", *extra)


def between_join(
    left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str, *, start: str = "slot", following: str = "next_slot",
    cell: timedelta = CELL, most: int | None = None,
) -> DataFrame:
    """Left rows with the right times around them: ``start <= left_on < following``; NULL outside."""
    both = _both_sides(left, right, by, left_on, right_on, [], unique=False)
    scanned = carry_scan(both, by, {"r": F.col(RIGHT)}, order=(SIDE, RIGHT), cell=cell, sparse=True, most=most).where(F.col(SIDE) == 1)
    return scanned.select(
        f"{LEFT}.*",
        F.when(F.col(T).isNotNull(), F.col(f"prev_r.v.{RIGHT}.__ts")).alias(start),
        F.when(F.col(T).isNotNull(), F.col(f"next_r.v.{RIGHT}.__ts")).alias(following),
    )


HEADER_COLUMNS = HEADER_FIELDS[1:]


def attach_header(
    series: DataFrame, header: DataFrame, by: list[str], series_on: str, header_on: str, cols: list[str] | None = None,
    tolerance: timedelta = timedelta(minutes=6), check_lengths: bool = False,
) -> DataFrame:
    """Header attributes of the nearest header row within the tolerance, both ends included.

    With ``check_lengths`` only series whose header has the same number of rows are kept.
    """
    if check_lengths:
        series = series.join(matching_lengths(series, header, by), by, "left_semi")
    return asof_join(series, header, by, series_on, header_on, cols or HEADER_COLUMNS, tolerance=tolerance)


def matching_lengths(series: DataFrame, header: DataFrame, by: list[str]) -> DataFrame:
    """Keys whose series and header have the same number of rows."""
    have = series.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return have.join(header.groupBy(*by).agg(F.count(F.lit(1)).alias("n")), [*by, "n"], "left_semi").select(*by)


def nearest_region(
    events: DataFrame, regions: DataFrame, by: list[str], event_on: str, region_on: str, cols: list[str],
    max_age: timedelta = timedelta(hours=72), prefix: str = "", delta_days: str = "delta_days",
) -> DataFrame:
    """Nearest daily record of the event's region, younger than ``max_age``; exact ties give NULL."""
    return asof_join(
        events, regions, by, event_on, region_on, cols, tolerance=max_age, closed=False, tie="null", prefix=prefix,
        delta_days=delta_days, cell=timedelta(days=12),
    )


def attach_centroid(
    events: DataFrame, regions: DataFrame, by: list[str], event_on: str, region_on: str, location: str = "location",
    east_sign: int = -1, clamp: float = 90.0, out: str = "centroid",
) -> DataFrame:
    """Region centre moved to the event time, as ``(lon, lat)`` text and two columns."""
    near = nearest_region(events, regions, by, event_on, region_on, [location], prefix="__", delta_days="__delta")
    lon, lat = parse_compass(F.col("__" + location), east_sign)
    moved = near.withColumns({"__lon": lon, "__lat": lat})
    moved = moved.withColumn(f"{out}_lon", advance_centroid(F.col("__lon"), F.col("__lat"), -F.col("__delta"), clamp))
    moved = moved.withColumnRenamed("__lat", f"{out}_lat")
    text = format_point(F.col(f"{out}_lon"), F.col(f"{out}_lat"), style="pair")
    return moved.withColumn(out, text).drop("__" + location, "__delta", "__lon")


def distance_to_region(
    events: DataFrame, regions: DataFrame, by: list[str], event_on: str, region_on: str, event_lonlat: tuple[str, str],
    region_lonlat: tuple[str, str], out: str = "region_dist",
) -> DataFrame:
    """Distance in disc units between an event and the nearest record of its region."""
    near = nearest_region(events, regions, by, event_on, region_on, list(region_lonlat), prefix="__", delta_days="__delta")
    ex, ey = disc_xy(*[F.col(c) for c in event_lonlat])
    rx, ry = disc_xy(*[F.col("__" + c) for c in region_lonlat])
    return near.withColumn(out, distance(ex, ey, rx, ry)).drop("__delta", *["__" + c for c in region_lonlat])


def region_distance_to_center(
    events: DataFrame, regions: DataFrame, by: list[str], event_on: str, region_on: str, region_lonlat: tuple[str, str],
    out: str = "center_dist",
) -> DataFrame:
    """Distance in disc units between the disc centre and the nearest record of the event's region."""
    near = nearest_region(events, regions, by, event_on, region_on, list(region_lonlat), prefix="__", delta_days="__delta")
    rx, ry = disc_xy(*[F.col("__" + c) for c in region_lonlat])
    return near.withColumn(out, distance(rx, ry, F.lit(0.0), F.lit(0.0))).drop("__delta", *["__" + c for c in region_lonlat])
