"""Operators on event tables: filters, de-duplication, counts, distance statistics."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..functions.classes import class_compare, class_letter
from ..functions.keys import has_key
from ..functions.places import has_location
from ..functions.times import days_between
from ..session import materialize

DUPLICATE_KEYS = ["start_time", "end_time", "peak_time", "noaa_active_region", "goes_class", "goes_location"]


def select_columns(df: DataFrame, cols: list[str], renames: dict[str, str] | None = None) -> DataFrame:
    """Fixed projection with optional renames."""
    return df.select(*cols).withColumnsRenamed(renames or {})


def class_at_least(df: DataFrame, threshold: str, op: str = ">", order: str = "text", cls: str = "goes_class") -> DataFrame:
    """Events above a class; by text (default) ``X10.0`` sorts before ``X9.3``."""
    return df.where(class_compare(F.col(cls), op, threshold, order))


def same_magnitude(df: DataFrame, magnitude: str, cls: str = "goes_class") -> DataFrame:
    """Events of exactly one class text."""
    return df.where(F.col(cls) == magnitude)


def by_source(df: DataFrame, name: str, col: str = "frm_name") -> DataFrame:
    """Events of one detection module."""
    return df.where(F.col(col) == name)


def after(df: DataFrame, on: str, t) -> DataFrame:
    """Events strictly after a date."""
    return df.where(F.col(on) > t)


def before(df: DataFrame, on: str, t) -> DataFrame:
    """Events strictly before a date."""
    return df.where(F.col(on) < t)


def split_by_location(df: DataFrame, own: str = "goes_location", centroid: str = "centroid") -> tuple[DataFrame, DataFrame]:
    """(with a usable location, without): own location or centroid."""
    usable = has_location(F.col(own)) | F.col(centroid).isNotNull()
    return df.where(usable), df.where(~usable)


def time_anomalies(df: DataFrame, long_hours: tuple[int, ...] = (6, 8), peaks: tuple[str, str] | None = None, ids: str = "id") -> DataFrame:
    """One row per event and time rule it breaks."""
    start, peak, end = F.col("start_time"), F.col("peak_time"), F.col("end_time")
    rules = {
        "peak_before_start": peak < start, "peak_not_after_start": peak <= start,
        "end_before_start": end < start, "end_before_peak": end < peak,
    }
    for hours in long_hours:
        rules[f"longer_than_{hours}h"] = (end - start) > F.lit(timedelta(hours=hours))
    if peaks:
        apart = F.abs(days_between(F.col(peaks[0]), F.col(peaks[1])))
        rules["source_peaks_differ"] = apart > F.lit(timedelta(minutes=40) / timedelta(days=1))
    broken = F.array_compact(F.array(*[F.when(rule, name) for name, rule in rules.items()]))
    return df.select(ids, F.explode(broken).alias("anomaly"))


def validation_status(first: Column, second: Column, threshold: float) -> Column:
    """validated by the first distance, rescued by the second, else invalid."""
    return (
        F.when(F.coalesce(first <= threshold, F.lit(False)), "validated")
        .when(F.coalesce(second < threshold, F.lit(False)), "rescued")
        .otherwise("invalid")
    )


def validate_by_distance(df: DataFrame, first: str, second: str, threshold: float = 163.18, out: str = "status") -> DataFrame:
    """Events with their validation status."""
    return df.withColumn(out, validation_status(F.col(first), F.col(second), threshold))


def source_split(df: DataFrame, first_key: str, second_key: str) -> DataFrame:
    """Unmatched events by the sources that gave a region number, each with a number other than 0."""
    a, b = F.col(first_key), F.col(second_key)
    origin = F.when(a.isNull() & b.isNull(), None).when(b.isNull(), "first_only").when(a.isNull(), "second_only").otherwise("both")
    usable = F.coalesce(a != 0, F.lit(False)) | F.coalesce(b != 0, F.lit(False))
    return df.withColumn("origin", origin).where(F.col("origin").isNotNull() & usable)


def union_all(*dfs: DataFrame) -> DataFrame:
    """Concatenation by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_checked(dfs: list[DataFrame], name: str, expected: list[int] | None = None) -> tuple[DataFrame, list[int]]:
    """``union_all``, stored, and the row count of each input; the counts are taken while the rows are written, in one pass.

    Raises ValueError when the stored rows are not as many as the inputs', or an input is not as long as ``expected`` says.
    """
    seen = [Observation(f"{name}-{i}") for i in range(len(dfs))]
    whole = Observation(f"{name}-all")
    rows = F.count(F.lit(1)).alias("n")
    stored = materialize(union_all(*[df.observe(o, rows) for df, o in zip(dfs, seen)]).observe(whole, rows), name)
    counts, total = [o.get.get("n", 0) for o in seen], whole.get.get("n", 0)
    if sum(counts) != total:
        raise ValueError(f"{total} rows of {sum(counts)} were concatenated")
    if expected is not None and counts != list(expected):
        raise ValueError(f"inputs have {counts} rows, not {list(expected)}")
    return stored, counts


def dedupe_first(df: DataFrame, keys: list[str] = DUPLICATE_KEYS, order: str = "id") -> tuple[DataFrame, DataFrame]:
    """(first row of every duplicate group by ``order``, all later duplicates).

    NULL keys count as equal, a NULL ``order`` comes last, and equal ``order`` is decided by the other columns. Exactly one row of a group
    stays, also when rows repeat whole. Repeated rows are counted and the first row is found by aggregates, which
    combine before the shuffle, so a group of copies of any size is safe.
    """
    columns = df.columns
    place = F.struct(F.col(order).isNull().alias("late"), F.col(order).alias("at"), F.struct(*columns).alias("row"))
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies")).withColumn("__place", place)
    firsts = counted.groupBy(*[F.col(k).alias(f"__key_{k}") for k in keys]).agg(F.min("__place").alias("__first"))
    kept = firsts.select("__first.row.*")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys])
    rest = counted.join(firsts, same).withColumn("__left", F.col("__copies") - (F.col("__place") == F.col("__first")).cast("long"))
    later = rest.where(F.col("__left") > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__left"))))
    return kept, later.select(*columns)


def set_difference(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """Distinct keys of ``a`` that are not in ``b``."""
    return a.select(on).subtract(b.select(on))


def tagged_union(groups: dict[str, DataFrame], order: str = "id") -> DataFrame:
    """Union of groups with one flag column per group, sorted."""
    parts = [df.withColumns({name: F.lit(name == own) for name in groups}) for own, df in groups.items()]
    return union_all(*parts).orderBy(order)


def unmatched_keys(events: DataFrame, matched: DataFrame, above: str = "B", key: str = "noaa_active_region", ids: str = "id") -> DataFrame:
    """Sorted distinct region numbers of unmatched events above a class."""
    rest = class_at_least(events.join(matched.select(ids), ids, "left_anti"), above)
    return rest.where(F.col(key).isNotNull()).select(key).distinct().orderBy(key)


def merge_sources_outer(a: DataFrame, b: DataFrame, on: list[str], tag: str = "provenance") -> DataFrame:
    """Full outer merge of two sources with first_only, second_only or both."""
    left, right = a.withColumn("__a", F.lit(1)), b.withColumn("__b", F.lit(1))
    merged = left.join(right, on, "full_outer")
    origin = F.when(F.col("__b").isNull(), "first_only").when(F.col("__a").isNull(), "second_only").otherwise("both")
    return merged.withColumn(tag, origin).drop("__a", "__b")


def nearest_one(df: DataFrame, group: list[str], metric: str, tie: str, cols: list[str]) -> DataFrame:
    """Row of least metric per group; the smaller ``tie`` wins."""
    best = df.groupBy(*group).agg(F.min(F.struct(metric, tie, *cols)).alias("__m"))
    return best.select(*group, "__m.*")


def sort_by(df: DataFrame, cols: list[str]) -> DataFrame:
    """Total order by the given columns."""
    return df.orderBy(*cols)


def head(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows in the given order."""
    return df.orderBy(*order).limit(n)


def max_label(df: DataFrame, labels: str, out: str = "max_label") -> DataFrame:
    """Greatest label of an array, by text."""
    return df.withColumn(out, F.array_max(labels))


def count_by_class(df: DataFrame, cls: str = "goes_class") -> DataFrame:
    """Events per class letter."""
    return df.groupBy(class_letter(F.col(cls)).alias("class")).agg(F.count(F.lit(1)).alias("n"))


def completeness_table(df: DataFrame, cls: str = "goes_class", key: str = "noaa_active_region", location: str = "goes_location") -> DataFrame:
    """Per class: events with and without a number and a location."""
    k, l = has_key(F.col(key)), has_location(F.col(location))
    return df.groupBy(class_letter(F.col(cls)).alias("class")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(k).alias("with_key"), F.count_if(~k).alias("without_key"),
        F.count_if(l).alias("with_location"), F.count_if(~l).alias("without_location"),
        F.count_if(k & l).alias("key_and_location"), F.count_if(~k & ~l).alias("no_key_no_location"),
    )


def nested_counts(df: DataFrame, cls: str = "goes_class", key: str = "noaa_active_region", location: str = "goes_location") -> DataFrame:
    """Counts by class, class and number, class and number and location; ``level`` 1 to 3."""
    flagged = df.select(
        class_letter(F.col(cls), {"A": "B", "X": "M"}).alias("class"), has_key(F.col(key)).alias("has_key"),
        has_location(F.col(location)).alias("has_location"),
    )
    out = flagged.rollup("class", "has_key", "has_location").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("__g"))
    level = F.when(F.col("__g") == 0, 3).when(F.col("__g") == 1, 2).when(F.col("__g") == 3, 1)
    return out.withColumn("level", level).where(F.col("level").isNotNull()).drop("__g")


def monthly_counts(df: DataFrame, on: str = "start_time", min_class: str = "C", cls: str = "goes_class") -> DataFrame:
    """Events per month and class letter above ``min_class``."""
    rows = df.select(F.date_format(on, "yyyy-MM").alias("year_month"), class_letter(F.col(cls)).alias("class"))
    return rows.where(F.col("class") > min_class).groupBy("year_month", "class").agg(F.count(F.lit(1)).alias("n"))


CLIMATOLOGY = ("x", "m", "c", "b", "mx", "bc")


def climatology(df: DataFrame, day: str = "start_time", peak: str = "peak_time", cls: str = "goes_class") -> DataFrame:
    """Share of days with at least one event, per group of classes.

    The denominator counts grid points from the first to the last day, the last day itself is
    not tested. ``mx`` and ``bc`` compare class text with ``M``.
    """
    c = F.col(cls)
    member = {
        "x": F.startswith(c, F.lit("X")), "m": F.startswith(c, F.lit("M")), "c": F.startswith(c, F.lit("C")),
        "b": F.startswith(c, F.lit("B")), "mx": c > "M", "bc": c < "M",
    }
    flags = [F.bool_or(member[g]).alias(g) for g in CLIMATOLOGY]
    days = df.groupBy(F.to_date(peak).alias("__peak_day")).agg(*flags)
    first = df.agg(F.to_date(F.min(day)).alias("d")).scalar()
    last = df.agg(F.to_date(F.max(day)).alias("d")).scalar()
    tested = days.where((F.col("__peak_day") >= first) & (F.col("__peak_day") < last))
    points = F.datediff(last, first) + 1
    wide = tested.agg(*[F.count_if(F.col(g)).alias(g) for g in CLIMATOLOGY]).select(*[(F.col(g) / points).alias(g) for g in CLIMATOLOGY])
    return wide.unpivot([], list(CLIMATOLOGY), "class_group", "share")


def exact_quantiles(df: DataFrame, value: str, qs: dict[str, float], pivots: int = 64) -> DataFrame:
    """Exact linear-interpolated quantiles in one row, by selection in several passes; NULL when there are no values.

    A pass takes ``pivots`` values of each interval that still holds a wanted rank as pivots, counts the values between them, and goes on with
    the part that holds the rank. A pivot is a part of its own, so every pass shortens the interval, whatever the ties. The passes
    aggregate map-side over a stored column: no value is shuffled, no task holds more than the counts of the parts, and the
    driver sees at most 2 * ``pivots`` + 1 rows per wanted rank and pass. NaN counts as the greatest value.
    """
    held = materialize(df.where(F.col(value).isNotNull()).select(F.col(value).alias("__v")), "quantiles")
    n = held.count()
    kind = held.schema["__v"].dataType
    ranks = {r for q in qs.values() for r in (floor((n - 1) * q), ceil((n - 1) * q)) if n}
    found: dict[int, object] = {}
    open_parts = {(None, None): (0, ranks)} if n else {}  # (least, greatest value): (values before it, ranks inside)
    while open_parts:
        parts = _count_parts(held, kind, list(open_parts), pivots)
        following: dict = {}
        for i, (before, wanted) in enumerate(open_parts.values()):
            for part in parts[i]:
                inside = {r for r in wanted if before <= r < before + part.n}
                if inside and part.single:
                    found |= dict.fromkeys(inside, part.low)
                elif inside:
                    following[part.low, part.high] = (before, inside)
                before += part.n
        open_parts = following
    out = []
    for name, q in qs.items():
        spot = (n - 1) * q
        low, high = (F.lit(found.get(r(spot))).cast(kind) for r in (floor, ceil))
        out.append((low + (high - low) * F.lit(spot - floor(spot))).alias(name))
    return df.sparkSession.range(1).select(*out)


def _count_parts(held: DataFrame, kind: DataType, intervals: list[tuple], pivots: int) -> list[list[Row]]:
    """For each interval the counts between and at its pivots, in order: n, low, high, single (only one value)."""
    v = F.col("__v")
    inside = [F.lit(True) if low is None else v.between(F.lit(low).cast(kind), F.lit(high).cast(kind)) for low, high in intervals]
    own = F.coalesce(*[F.when(test, F.lit(i)) for i, test in enumerate(inside)])
    rows = held.withColumn("__i", own).where(F.col("__i").isNotNull())
    shares = F.array(*[F.lit(i / pivots) for i in range(1, pivots)])
    sketched = rows.groupBy("__i").agg(F.array_distinct(F.percentile_approx("__v", shares, 20 * pivots)).alias("cuts"))
    cuts = {r["__i"]: r.cuts for r in sketched.collect()}
    arrays = F.array(*[F.array(*[F.lit(c).cast(kind) for c in cuts[i]]) for i in range(len(intervals))])
    mine = F.get(arrays, F.col("__i"))
    part = F.size(F.filter(mine, lambda c: c < v)) + F.size(F.filter(mine, lambda c: c <= v))
    counted = rows.groupBy("__i", part.alias("__p")).agg(F.count("__v").alias("n"), F.min("__v").alias("low"), F.max("__v").alias("high"))
    out: list[list[Row]] = [[] for _ in intervals]
    for row in counted.withColumn("single", F.col("low") == F.col("high")).sort("__i", "__p").collect():
        out[row["__i"]].append(row)
    return out


def distance_summary(df: DataFrame, first: str, second: str) -> DataFrame:
    """Mean, median, sample deviation and 0.95 quantile of the smaller distance where both exist."""
    both = df.where(F.col(first).isNotNull() & F.col(second).isNotNull()).select(F.least(first, second).alias("d"))
    moments = both.agg(F.count("d").alias("n"), F.avg("d").alias("mean"), F.stddev_samp("d").alias("std"))
    ranks = exact_quantiles(both, "d", {"median": 0.5, "q95": 0.95})
    one = F.lit(1).alias("__one")
    return moments.select(one, "*").join(ranks.select(one, "*"), "__one").drop("__one")


def histogram_fixed(df: DataFrame, value: str, width: float = 8.0, top: float = 400.0) -> DataFrame:
    """Counts in bins of ``width`` from the minimum, the last one open; empty bins are listed."""
    rows = df.where(F.col(value).isNotNull())
    least = rows.agg(F.min(value).alias("m")).scalar()
    last_bin = F.greatest(F.ceil((F.lit(top + width) - least) / width) - 1, F.lit(0)).cast("long")
    bins = rows.select(F.least(F.floor((F.col(value) - least) / width), last_bin).alias("bin"))
    counts = bins.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    edges = rows.agg(F.min(value).alias("m")).select(
        F.col("m"), F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil((F.lit(top + width) - F.col("m")) / width) - 1, F.lit(0)).cast("long"))).alias("bin")
    )
    return edges.join(counts, "bin", "left").select(
        "bin", (F.col("m") + F.col("bin") * width).alias("low"), F.coalesce("n", F.lit(0)).alias("n")
    )


def invalid_event_breakdown(df: DataFrame, status: str = "status", cls: str = "goes_class") -> DataFrame:
    """Class by validated, without location, removed."""
    letter = class_letter(F.col(cls), {"A": "B"})
    names = ["validated", "no_location", "removed"]
    return df.groupBy(letter.alias("class")).pivot(status, names).agg(F.count(F.lit(1))).fillna(0, names)
