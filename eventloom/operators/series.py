"""Operators on keyed series: regular grid, slot statistics, quality, smoothing."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import cell_start, micros, rows_to_hours, shift, us
from ..session import materialize
from .scan import CELL, T, carry_scan, key_stats, neighbours, positions

CADENCE = timedelta(minutes=12)
UNTRUSTED = -99999.0
GRID_CHUNK = 20_000
"""Grid points that one task makes at once."""


def series_spans(series: DataFrame, by: list[str], on: str) -> DataFrame:
    """First and last time, rows and the largest number of rows at one time, per key."""
    times = series.groupBy(*by, on).agg(F.count(F.lit(1)).alias("__n"))
    return times.groupBy(*by).agg(
        F.min(on).alias("first_ts"), F.max(on).alias("last_ts"), F.sum("__n").alias("rows"), F.max("__n").alias("per_time")
    )


def regrid_rejects(series: DataFrame, by: list[str], on: str, cadence: timedelta = CADENCE) -> DataFrame:
    """Keys that cannot be put on the grid: span not a multiple of the cadence, or repeated times."""
    return series_spans(series, by, on).where(~_griddable(cadence))


def _griddable(cadence: timedelta) -> Column:
    return (F.pmod(micros(F.col("last_ts")) - micros(F.col("first_ts")), F.lit(us(cadence))) == 0) & (F.col("per_time") == 1)


def regrid(series: DataFrame, by: list[str], on: str, cadence: timedelta = CADENCE, placed: bool = False) -> DataFrame:
    """Rows on a regular grid from the first to the last time; gaps become NULL rows.

    Rows between grid points disappear. Keys listed by ``regrid_rejects`` are left out. With ``placed``
    every row carries its position ``pos`` and the series length ``n``, which spares later
    operators the search for them. Spark takes the points for as small as the chunks they are made of; the hints
    keep joins from broadcasting them, here and in what is built on the grid.
    """
    step = us(cadence)
    spans = series_spans(series, by, on).where(_griddable(cadence))
    length = (F.floor((micros(F.col("last_ts")) - micros(F.col("first_ts"))) / step) + 1).cast("long")
    spans = spans.select(*by, "first_ts", length.alias("n"))
    # a long series is many chunks of points, dealt out before the points are made
    chunks = spans.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / GRID_CHUNK))))
    session = series.sparkSession
    parts = max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism)
    begin = F.col("__chunk") * GRID_CHUNK
    positions_ = F.sequence(begin, F.least(begin + GRID_CHUNK, F.col("n")) - 1)
    grid = chunks.repartition(parts, *by, "__chunk").withColumn("pos", F.explode(positions_))
    grid = grid.select(*by, *(["n", "pos"] if placed else []), shift(F.col("first_ts"), F.col("pos") * step).alias(on))
    return grid.hint("merge").join(series, [*by, on], "left").hint("merge")


def _minutes_of_slots(slots, flux, slot_on, flux_on, value, before, after) -> DataFrame:
    """(slot, flux time, flux value) for every distinct slot time and flux row in its window."""
    width = before + after + timedelta(minutes=1)
    times = slots.select(F.col(slot_on).alias("__slot")).where(F.col("__slot").isNotNull()).distinct()
    low, high = micros(F.col("__slot")) - us(before), micros(F.col("__slot")) + us(after)
    cells = F.sequence(cell_start(low, width), cell_start(high, width), F.lit(us(width)))
    spread = times.withColumn("__cell", F.explode(cells))
    minutes = flux.select(F.col(flux_on).alias("__ft"), F.col(value).alias("__fv")).withColumn(
        "__cell", cell_start(micros(F.col("__ft")), width)
    )
    hit = F.col("__ft").between(F.col("__slot") - F.lit(before), F.col("__slot") + F.lit(after))
    return spread.join(minutes, "__cell").where(hit)


def _minutes_of_grid(flux, flux_on, value, before, after, grid: timedelta) -> DataFrame:
    """The same for all slots that are multiples of ``grid``, from the flux alone."""
    t = micros(F.col(flux_on))
    first = cell_start(t - us(after) + (us(grid) - 1), grid)
    last = cell_start(t + us(before), grid)
    slots = F.when(first <= last, F.sequence(first, last, F.lit(us(grid))))
    rows = flux.where(F.col(flux_on).isNotNull()).select(
        F.col(flux_on).alias("__ft"), F.col(value).alias("__fv"), t.alias("__us"), F.explode(slots).alias("__at")
    )
    return rows.select(shift(F.col("__ft"), F.col("__at") - F.col("__us")).alias("__slot"), "__ft", "__fv")


def slot_flux_stats(
    slots: DataFrame | None, flux: DataFrame, slot_on: str, flux_on: str, value: str, before: timedelta = timedelta(minutes=6),
    after: timedelta = timedelta(minutes=5), untrusted: float = UNTRUSTED, grid: timedelta | None = None,
) -> DataFrame:
    """Per distinct slot time: trusted average and maximum, all values, trusted count, 0/1 text.

    The window is ``[t - before, t + after]``. NULL, NaN and ``untrusted`` values count as not trusted.
    With ``grid`` the slots are all multiples of that width and ``slots`` is not read.
    """
    found = (
        _minutes_of_slots(slots, flux, slot_on, flux_on, value, before, after) if grid is None
        else _minutes_of_grid(flux, flux_on, value, before, after, grid)
    )
    trusted = F.col("__fv").isNotNull() & ~F.isnan("__fv") & (F.col("__fv") != untrusted)
    rows = found.withColumn("__ok", F.coalesce(trusted, F.lit(False)))
    ordered = F.sort_array(F.collect_list(F.struct("__ft", "__fv", "__ok")))
    stats = rows.groupBy("__slot").agg(
        F.avg(F.when(F.col("__ok"), F.col("__fv"))).alias("xr_avg"),
        F.max(F.when(F.col("__ok"), F.col("__fv"))).alias("xr_max"),
        F.count_if("__ok").alias("xr_qual"),
        ordered.alias("__all"),
    )
    return stats.select(
        F.col("__slot").alias(slot_on),
        F.coalesce("xr_avg", F.lit(untrusted)).alias("xr_avg"),
        F.coalesce("xr_max", F.lit(untrusted)).alias("xr_max"),
        "xr_qual",
        F.array_join(F.transform("__all", lambda e: F.coalesce(e["__fv"].cast("string"), F.lit("NaN"))), ";").alias("xr_all"),
        F.array_join(F.transform("__all", lambda e: F.when(e["__ok"], "1").otherwise("0")), "").alias("xr_qual_str"),
    )


def slot_stats_join(
    series: DataFrame, flux: DataFrame, on: str, flux_on: str, value: str, cols: tuple[str, ...] = ("xr_max", "xr_qual"),
    before: timedelta = timedelta(minutes=6), after: timedelta = timedelta(minutes=5), untrusted: float = UNTRUSTED,
    grid: timedelta | None = None,
) -> DataFrame:
    """Series rows with the flux statistics of their slot.

    Statistics depend on the slot time alone, so they are computed once per distinct time, however
    many series share it. With ``grid`` (series times are multiples of it) the series is read once only.
    """
    stats = slot_flux_stats(series, flux, on, flux_on, value, before, after, untrusted, grid).select(on, *cols)
    out = series.join(stats, on, "left")
    fill = {"xr_avg": F.lit(untrusted), "xr_max": F.lit(untrusted), "xr_qual": F.lit(0).cast("long"), "xr_all": F.lit(""), "xr_qual_str": F.lit("")}
    return out.withColumns({c: F.coalesce(F.col(c), fill[c]) for c in cols})


def null_counts(series: DataFrame, by: list[str], cols: list[str], zeros: bool = False) -> DataFrame:
    """Missing (with ``zeros``: missing or zero) values per key and column, long form."""
    def bad(c: str) -> Column:
        missing = F.col(c).isNull()
        return missing | (F.col(c) == 0) if zeros else missing

    counts = series.groupBy(*by).agg(*[F.count_if(bad(c)).alias(c) for c in cols])
    return counts.unpivot(by, cols, "column_name", "n_missing")


def null_totals(series: DataFrame, cols: list[str], zeros: bool = False) -> DataFrame:
    """The same counts over all keys."""
    return null_counts(series.withColumn("__all", F.lit(1)), ["__all"], cols, zeros).drop("__all")


def series_length(series: DataFrame, by: list[str], cadence: timedelta = CADENCE) -> DataFrame:
    """Rows and hours per key."""
    return series.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")).withColumn("hours", rows_to_hours(F.col("rows"), cadence))


def step_diff(series: DataFrame, by: list[str], on: str, out: str = "step_us", cell: timedelta = CELL) -> DataFrame:
    """Microseconds since the previous row of the key; NULL on the first."""
    near = neighbours(series, by, on, [on], want=("prev",), cell=cell)
    return near.withColumn(out, micros(F.col(on)) - micros(F.col(f"prev_{on}"))).drop(f"prev_{on}")


def irregular_step_ratio(series: DataFrame, by: list[str], on: str, cadence: timedelta = CADENCE) -> DataFrame:
    """Share of rows whose step differs from the cadence; a first row counts as different."""
    odd = F.coalesce(F.col("step_us") != us(cadence), F.lit(True))
    return step_diff(series.select(*by, on), by, on).groupBy(*by).agg((F.count_if(odd) / F.count(F.lit(1))).alias("irregular_ratio"))


def availability_ratio(series: DataFrame, by: list[str], on: str, cadence: timedelta = CADENCE) -> DataFrame:
    """Rows divided by the grid points between first and last time; above 1 or undefined is flagged."""
    spans = series.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.min(on).alias("first_ts"), F.max(on).alias("last_ts"))
    points = (micros(F.col("last_ts")) - micros(F.col("first_ts"))) / us(cadence) + 1
    out = spans.withColumn("availability", F.col("rows") / points)
    return out.withColumn("flagged", F.coalesce(F.col("availability") > 1, F.lit(True))).drop("first_ts", "last_ts")


def _has_place(series: DataFrame) -> bool:
    return {"pos", "n"} <= set(series.columns)


def _placed(series: DataFrame, by: list[str], on: str, cell: timedelta = CELL, most: int | None = None) -> DataFrame:
    """Series with ``pos`` and ``n``, computed only when they are not there yet."""
    return series if _has_place(series) else positions(series, by, on, cell=cell, most=most)


def interpolate_linear(series: DataFrame, by: list[str], on: str, cols: list[str], cell: timedelta = CELL, most: int | None = None) -> DataFrame:
    """Gaps filled linearly by row position, then forward, then backward; ``most`` bounds the rows of a time cell."""
    placed = _placed(series, by, on, cell, most).withColumn(T, micros(F.col(on)))
    sources = {c: F.when(F.col(c).isNotNull(), F.struct(F.col("pos").alias("p"), F.col(c).alias("x"))) for c in cols}
    scanned = carry_scan(placed, by, sources, cell=cell, most=most)

    def filled(c: str) -> Column:
        a, b = F.col(f"prev_{c}.v"), F.col(f"next_{c}.v")
        share = (F.col("pos") - a["p"]) / (b["p"] - a["p"])
        return F.coalesce(F.col(c), a["x"] + (b["x"] - a["x"]) * share, a["x"], b["x"])

    out = scanned.withColumns({c: filled(c) for c in cols})
    added = [] if _has_place(series) else ["pos", "n"]
    return out.drop(T, *added, *[f"{d}_{c}" for c in cols for d in ("prev", "next")])


def scale(series: DataFrame, by: list[str], on: str, cols: list[str], cell: timedelta = CELL) -> DataFrame:
    """Min-max scaling per series; a constant column becomes 0."""
    stats = {f"__{kind}_{c}": (kind, F.col(c)) for c in cols for kind in ("min", "max")}
    rows = key_stats(series, by, cell_start(micros(F.col(on)), cell), stats)

    def scaled(c: str) -> Column:
        low, high = F.col(f"__min_{c}"), F.col(f"__max_{c}")
        return (F.col(c) - low) / F.when(high == low, 1.0).otherwise(high - low)

    return rows.withColumns({c: scaled(c) for c in cols}).drop(*stats)


def chunked(placed: DataFrame, reach_back: int, reach_ahead: int, pos: str = "pos", total: str = "n", rows: int = 4096) -> DataFrame:
    """Copy rows into position chunks so that every home row sees its whole frame in one chunk.

    A frame over ``pos - reach_back .. pos + reach_ahead`` then needs only a window over
    (key, ``__chunk``), whatever the length of the series. ``__home`` marks the rows to keep.
    """
    size = rows if rows >= 8 * (reach_back + reach_ahead) else 8 * (reach_back + reach_ahead)
    low = F.greatest(F.floor((F.col(pos) - reach_ahead) / size), F.lit(0))
    high = F.least(F.floor((F.col(pos) + reach_back) / size), F.floor((F.col(total) - 1) / size))
    return placed.withColumn("__chunk", F.explode(F.sequence(low, high))).withColumn(
        "__home", F.floor(F.col(pos) / size) == F.col("__chunk")
    )


def rolling_mean(series: DataFrame, by: list[str], on: str, cols: list[str], n: int = 11, keep_place: bool = False) -> DataFrame:
    """Mean of the last ``n`` rows; missing until ``n`` values exist. With ``keep_place`` rows keep ``pos`` and ``n``."""
    rows = chunked(_placed(series, by, on), n - 1, 0)
    frame = Window.partitionBy(*by, "__chunk").orderBy("pos").rowsBetween(-(n - 1), 0)
    means = {f"{c}_mean": F.when(F.count(c).over(frame) == n, F.avg(c).over(frame)) for c in cols}
    return rows.withColumns(means).where("__home").drop("__chunk", "__home", *([] if keep_place else ["pos", "n"]))


def trim_edges(series: DataFrame, by: list[str], on: str, head: int, tail: int, keep_place: bool = False) -> DataFrame:
    """Series without their first ``head`` and last ``tail`` rows. With ``keep_place`` rows have their ``pos`` and ``n`` in what is left."""
    placed = _placed(series, by, on)
    kept = placed.where((F.col("pos") >= head) & (F.col("pos") < F.col("n") - tail))
    return kept.withColumns({"pos": F.col("pos") - head, "n": F.col("n") - (head + tail)}) if keep_place else kept.drop("pos", "n")


def drop_time_range(series: DataFrame, on: str, start, end) -> DataFrame:
    """Rows outside ``[start, end]``."""
    return series.where(~F.col(on).between(start, end))


def time_range_report(series: DataFrame, by: list[str], on: str, start, end) -> DataFrame:
    """Number of series outside, fully inside and partly inside ``[start, end]``."""
    inside = F.count_if(F.col(on).between(start, end))
    per = series.groupBy(*by).agg(inside.alias("inside"), F.count(F.lit(1)).alias("rows"))
    return per.agg(
        F.count_if(F.col("inside") == 0).alias("out_of_range"),
        F.count_if((F.col("inside") > 0) & (F.col("inside") == F.col("rows"))).alias("fully_in_range"),
        F.count_if((F.col("inside") > 0) & (F.col("inside") < F.col("rows"))).alias("partially_in_range"),
    )


def scan_time_range(table: DataFrame, on: str, start, end) -> DataFrame:
    """Rows of ``[start, end]``; a table partitioned by ``day`` is pruned to the days it touches."""
    rows = table.where(F.col(on).between(start, end))
    if "day" in table.columns:
        rows = rows.where(F.col("day").between(F.to_date(start), F.to_date(end)))
    return rows


def max_in_interval(series: DataFrame, on: str, value: str, start, end, out: str = "max_class") -> DataFrame:
    """Largest flux in a time range, with its class."""
    from ..functions.classes import flux_to_class

    peak = scan_time_range(series, on, start, end).agg(F.max(value).alias("max_flux"))
    return peak.withColumn(out, flux_to_class(F.col("max_flux")))


def max_in_intervals(
    series: DataFrame, intervals: DataFrame, by: list[str], on: str, value: str, span: tuple[str, str], interval_id: str = "id",
    block: timedelta = timedelta(hours=6), out: str = "max_class",
) -> DataFrame:
    """Largest flux of each interval's key in [start, end], with its class: interval_id, max_flux, ``out``.

    A sparse table holds, for each key and level, the maximum of 2^level neighbouring blocks of time. The blocks inside an interval are covered
    by two entries of one level, which may overlap; only the rows of its first and last block are read one by one. Intervals without a
    value in them (also NULL or inverted ones) get NULL; NULL and NaN values count for nothing.
    """
    from ..functions.classes import flux_to_class

    width = us(block)
    number = lambda t: F.floor(micros(F.col(t)) / width).cast("long")
    rows = series.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(*by, F.col(on).alias("__t"), F.col(value).alias("__v"), number(on).alias("__block"))
    spans = intervals.select(interval_id, *by, F.col(span[0]).alias("__s"), F.col(span[1]).alias("__e"), number(span[0]).alias("__bs"), number(span[1]).alias("__be"))
    spans = materialize(spans.where("__s <= __e"), "interval-spans")
    inner = spans.where("__be - __bs > 1").select(interval_id, *by, (F.col("__bs") + 1).alias("__from"), (F.col("__be") - F.col("__bs") - 1).alias("__n"))
    inner = inner.withColumn("__level", (F.length(F.conv(F.col("__n").cast("string"), 10, 2)) - 1).cast("int"))
    top = inner.agg(F.max("__level")).first()[0]
    level = materialize(rows.groupBy(*by, "__block").agg(F.max("__v").alias("__v")), "block-maxima")
    table = level.withColumn("__level", F.lit(0))
    for k in range(top or 0):  # entry b of the next level holds entries b and b + 2^k of this one
        earlier = level.withColumn("__block", F.col("__block") - (1 << k))
        level = materialize(level.unionByName(earlier).groupBy(*by, "__block").agg(F.max("__v").alias("__v")), "block-maxima")
        table = table.unionByName(level.withColumn("__level", F.lit(k + 1)))
    last = F.col("__from") + F.col("__n") - F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__level"))
    two = inner.withColumn("__block", F.explode(F.array_distinct(F.array(F.col("__from"), last))))
    whole = two.join(table, [*by, "__level", "__block"]).select(interval_id, "__v")
    ends = spans.withColumn("__block", F.explode(F.array_distinct(F.array("__bs", "__be"))))
    edges = ends.join(rows, [*by, "__block"]).where(F.col("__t").between(F.col("__s"), F.col("__e"))).select(interval_id, "__v")
    best = whole.unionByName(edges).groupBy(interval_id).agg(F.max("__v").alias("max_flux"))
    return intervals.select(interval_id).join(best, interval_id, "left").withColumn(out, flux_to_class(F.col("max_flux")))


def active_slots(series: DataFrame, count: str) -> DataFrame:
    """Rows whose event count is not 0."""
    return series.where(F.col(count) != 0)
