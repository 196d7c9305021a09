"""Series annotation: headers, regular grid, trust flags, event history, flux."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.places import heliocentric_angle, trust_flags
from ..operators.asof import attach_header, matching_lengths
from ..operators.history import event_history
from ..operators.interval import regions_in_box
from ..operators.series import CADENCE, drop_time_range, regrid, regrid_rejects, slot_stats_join
from ..session import materialize
from ..sources.schemas import FINAL_COLUMNS
from .dataset import BEST


def add_trust_flags(series: DataFrame, limit: float = 70.0) -> DataFrame:
    """Heliocentric angle, inside-disc flag and trusted-field flag."""
    angle = heliocentric_angle(F.col("CRVAL1"), F.col("CRVAL2"), F.col("CRLN_OBS"), F.col("CRLT_OBS"))
    rows = series.withColumn("HC_ANGLE", angle)
    inside, trusted = trust_flags(F.col("HC_ANGLE"), F.col("QUALITY"), limit)
    return rows.withColumns({"SPEI": inside, "IS_TMFI": trusted})


def annotation_rejects(series: DataFrame, header: DataFrame | None, by: list[str], on: str, cadence: timedelta = CADENCE) -> DataFrame:
    """Keys that ``annotate_series`` leaves out, each with its reason.

    ``grid``: the span is no multiple of the cadence, or times repeat. ``header length``: with a ``header``, the rows
    of series and header differ in number.
    """
    bad = regrid_rejects(series, by, on, cadence).select(*by, F.lit("grid").alias("reason"))
    if header is None:
        return bad
    short = series.select(*by).distinct().join(matching_lengths(series, header, by), by, "left_anti")
    return bad.unionByName(short.select(*by, F.lit("header length").alias("reason")))


def annotate_series(
    series: DataFrame, header: DataFrame, events: DataFrame, key_map: DataFrame, flux: DataFrame, key: str = "harpnum",
    on: str = "ts", cadence: timedelta = CADENCE, aligned: bool = False, final: bool = True, check_lengths: bool = False,
    regions: DataFrame | None = None, without: tuple | None = None, best: bool = False,
) -> DataFrame:
    """All annotation stages; gap rows of the regular grid have no header values and are never trusted.

    With ``aligned`` (series times are multiples of the cadence) slots follow from times alone. The gridded series
    is stored once, since both event histories and the flux statistics read it. Optional stages: ``check_lengths`` leaves out series
    whose header has another number of rows, ``regions`` adds the numbers of the regions in each row's box, ``without`` drops the rows of
    a time range at the end, ``best`` adds the greatest event of each slot, which ``labelled_slices`` then uses. What the grid and the lengths leave out is in ``annotation_rejects``.
    """
    located = attach_header(series, header, [key], on, on, check_lengths=check_lengths)
    gridded = materialize(add_trust_flags(regrid(located, [key], on, cadence, placed=True)), "gridded-series")
    grid = cadence if aligned else None
    history = event_history(gridded, events, key_map, key, on, "key", grid=grid, best=best)
    places = gridded.select(key, on, "lat_min", "lat_max", "lon_min", "lon_max", "pos", "n")
    by_place = event_history(places, events, key_map, key, on, "location", grid=grid)
    history = history.join(by_place.select(key, on, *[c for c in by_place.columns if c.endswith("_LOC")]), [key, on])
    fluxed = slot_stats_join(history, flux, on, "ts", "b_avg", grid=grid)
    fluxed = fluxed.withColumnsRenamed({"xr_max": "XR_MAX", "xr_qual": "XR_QUAL"})
    if regions is not None:
        fluxed = regions_in_box(fluxed, regions, [key], on)
    if without is not None:
        fluxed = drop_time_range(fluxed, on, *without)
    extra = [*([] if regions is None else ["region_numbers"]), *(BEST if best else [])]
    return fluxed.select(key, on, *FINAL_COLUMNS, *extra) if final else fluxed
