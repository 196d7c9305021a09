"""Interval overlap joins, catalogue cross-matching and box searches.

Overlap has no equality condition of its own, so intervals are listed under time cells and the join runs on
the cell. Cells form levels, each twice as wide as the one below; an interval lives on the level whose cells are not shorter than itself,
where it touches two cells at most, and is also listed on the higher levels that the other side uses. A pair meets
on the higher of its two levels and is kept only in the first cell both sides share, so no later de-duplication is needed.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from math import pi

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.places import distance, rotation_lon_delta
from ..functions.times import DAY_US, cell_start, instant, micros, us
from ..session import aggregate_in_order, materialize
from . import sphere
from .asof import asof_join
from .scan import neighbours

TIME_CELL = timedelta(days=1)
SLOTS_OF_A_PART = 16_000
PARTS_OF_A_CELL = 4
"""A cell with more than so many slots is dealt into parts, each with a copy of the events of its time; so many at most, so that copies grow as the events."""
EVENTS_OF_A_PACK = (32, 4096)
STRETCHES_OF_A_CELL = 16
"""Fewer events than the first number leave cells of time whole; otherwise a cell is cut into a stretch for each so many as the second, some few at most."""


def placed(*cols: str) -> Column:
    """All coordinates are given; NaN and infinite ones count as missing."""
    found = F.lit(True)
    for c in cols:
        x = F.col(c).cast("double")
        found = found & x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return found


def overlaps(start: Column, end: Column, q_start: Column, q_end: Column, closed: str = "none") -> Column:
    """Interval overlap: ``none`` strict, ``both`` inclusive, ``left`` includes start = q_end only."""
    before = start < q_end if closed == "none" else start <= q_end
    after = end >= q_start if closed == "both" else end > q_start
    return before & after


def _cells(start: Column, end: Column, width: timedelta) -> Column:
    low, high = F.least(micros(start), micros(end)), F.greatest(micros(start), micros(end))
    return F.sequence(cell_start(low, width), cell_start(high, width), F.lit(us(width)))


def cell_level(start: Column, end: Column, width: timedelta) -> Column:
    """Level whose cells, ``width`` * 2^level wide, are not shorter than the interval."""
    span = F.abs(micros(end) - micros(start))
    return F.when(span > us(width), F.ceil(F.log2(span / us(width)))).otherwise(F.when(span.isNotNull(), 0)).cast("int")


def _levels_of(df: DataFrame, span: tuple[str, str], width: timedelta) -> Column:
    """The levels that a side uses (some forty at most), as an array."""
    return df.select(cell_level(F.col(span[0]), F.col(span[1]), width).alias("level")).agg(F.collect_set("level").alias("levels")).scalar()


def listed(df: DataFrame, span: tuple[str, str], width: timedelta, others: Column, left: bool, tag: str) -> DataFrame:
    """Rows under their cells: columns role, level, cell and first (the first cell on that level), each with ``tag`` before it.

    Role 0 meets on the right side's level, role 1 on the left side's where that is higher. A row has at most two cells on each level.
    """
    start, end = F.col(span[0]), F.col(span[1])
    own = cell_level(start, end, width)
    low, high = F.least(micros(start), micros(end)), F.greatest(micros(start), micros(end))
    df, others = df.withColumn(f"{tag}others", others), F.col(f"{tag}others")
    above = F.filter(others, lambda v: v >= own if left else v > own)
    needed = F.exists(others, lambda v: v < own if left else v <= own)
    up = F.transform(above, lambda v: F.struct(F.lit(0 if left else 1).alias("role"), v.alias("level")))
    entries = F.concat(up, F.when(needed, F.array(F.struct(F.lit(1 if left else 0).alias("role"), own.alias("level")))).otherwise(F.slice(up, 1, 0)))
    out = df.withColumns({f"{tag}low": low, f"{tag}high": high, f"{tag}at": F.explode(entries)})
    size = F.lit(us(width)) * F.call_function("shiftleft", F.lit(1).cast("long"), F.col(f"{tag}at.level"))

    def cell(t: str) -> Column:
        return F.col(t) - F.pmod(F.col(t), size)

    cells = F.sequence(cell(f"{tag}low"), cell(f"{tag}high"), size)
    out = out.withColumns({f"{tag}role": F.col(f"{tag}at.role"), f"{tag}level": F.col(f"{tag}at.level"), f"{tag}first": cell(f"{tag}low"), f"{tag}cell": F.explode(cells)})
    return out.drop(f"{tag}low", f"{tag}high", f"{tag}at", f"{tag}others")


def overlap_pairs(
    left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str],
    eq: list[tuple[str, str]] = (), closed: str = "none", width: timedelta = TIME_CELL, copies: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Pairs of rows whose intervals overlap and whose ``eq`` columns are equal. ``copies`` may multiply the listed left rows.

    Column names of the two sides must differ. The result is meant to be reduced at once by
    an aggregate per left row, so pairs are combined in the join task and never shuffled.
    """
    l = listed(left, left_span, width, _levels_of(right, right_span, width), True, "__l")
    l = copies(l) if copies else l
    r = listed(right, right_span, width, _levels_of(left, left_span, width), False, "__r")
    on = (F.col("__lcell") == F.col("__rcell")) & (F.col("__llevel") == F.col("__rlevel")) & (F.col("__lrole") == F.col("__rrole"))
    for a, b in eq:
        on = on & (F.col(a) == F.col(b))
    first_shared = F.col("__lcell") == F.greatest("__lfirst", "__rfirst")
    hit = overlaps(F.col(right_span[0]), F.col(right_span[1]), F.col(left_span[0]), F.col(left_span[1]), closed)
    return l.join(r, on & first_shared & hit).drop(*[f"__{side}{c}" for side in "lr" for c in ("role", "level", "cell", "first")])


EVENT = ["id", "start_time", "end_time", "goes_class", "x", "y", "ar"]


def _as_right(right: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    return right.select(*[F.col(c).alias("r_" + c) for c in (*EVENT, *more)])


def _space_cells(rows: DataFrame, radius: float | Column) -> DataFrame:
    """Rows under the space cell of their position and its eight neighbours."""
    for name, c in (("__sx", "x"), ("__sy", "y")):
        near = F.floor(F.col(c) / radius)
        rows = rows.withColumn(name, F.explode(F.array(near - 1, near, near + 1)))
    return rows


def overlap_candidates(
    left: DataFrame, right: DataFrame, eq_class: bool = True, closed: str = "none", radius: float | None = None, more: tuple[str, ...] = (),
) -> DataFrame:
    """All overlapping right events per left event with their distance (NULL without a location).

    Both sides have the columns id, start_time, end_time, goes_class, x, y, ar; ``more`` names further ones of the right side. With ``radius``
    only located events are searched, and only in the space cells of that size around them: every candidate up to that distance is
    found, farther ones only by chance. NaN counts as a missing coordinate, on both sides.
    """
    eq = [("goes_class", "r_goes_class")] if eq_class else []
    l, r = left.select("id", "start_time", "end_time", "goes_class", "x", "y"), _as_right(right, more)
    copies = None
    if radius is not None:
        l = l.where(placed("x", "y"))

        def copies(rows: DataFrame) -> DataFrame:
            return _space_cells(rows, radius)

        r = r.where(placed("r_x", "r_y")).withColumns({"__rx": F.floor(F.col("r_x") / radius), "__ry": F.floor(F.col("r_y") / radius)})
        eq = [*eq, ("__sx", "__rx"), ("__sy", "__ry")]
    pairs = overlap_pairs(l, r, ("start_time", "end_time"), ("r_start_time", "r_end_time"), eq, closed, copies=copies)
    gap = F.when(placed("x", "y", "r_x", "r_y"), distance(F.col("r_x"), F.col("r_y"), F.col("x"), F.col("y")))
    located = placed("x", "y")
    return pairs.select(
        "id", located.alias("located"), gap.alias("dist"),
        *[F.col("r_" + c).alias(f"c_{c}") for c in ("start_time", "id", "x", "y", "ar", *more)],
    )


def _candidate(*lead: Column) -> Column:
    return F.struct(*lead, *[F.col(f"c_{c}").alias(c) for c in ("start_time", "id", "x", "y", "ar")])


def summarize_candidates(candidates: DataFrame, near: float = 50.0) -> DataFrame:
    """Per left event: nearest, first and last candidate, their number, and the near-duplicate flag."""
    far = F.coalesce(F.col("dist"), F.lit(float("inf")))
    out = candidates.groupBy("id").agg(
        F.first("located").alias("located"),
        F.count(F.lit(1)).alias("n"),
        F.count("c_x").alias("n_located"),
        F.min(_candidate(far.alias("dist"))).alias("nearest"),
        F.min(_candidate()).alias("first"),
        F.max(_candidate()).alias("last"),
    )
    return out.withColumn("near_duplicate", is_near_duplicate(F.col("n"), F.col("first"), F.col("last"), near))


def is_near_duplicate(n: Column, first: Column, last: Column, threshold: float = 50.0) -> Column:
    """One point: true. Two points: closer than the threshold. More: false."""
    close = F.coalesce(distance(first["x"], first["y"], last["x"], last["y"]) < threshold, F.lit(False))
    return (n == 1) | ((n == 2) & close)


def match_overlap_nearest(
    left: DataFrame, right: DataFrame, eq_class: bool = True, closed: str = "none", radius: float | None = None
) -> DataFrame:
    """Closest overlapping event per located left event; for unlocated ones every candidate.

    Columns: id, located, match_id, dist, match_x, match_y, match_ar.
    """
    one = nearest_overlap(left, right, eq_class, closed, radius).select(
        "id", F.lit(True).alias("located"), F.col("m.id").alias("match_id"),
        F.nullif(F.col("m.dist"), F.lit(float("inf"))).alias("dist"),
        F.col("m.x").alias("match_x"), F.col("m.y").alias("match_y"), F.col("m.ar").alias("match_ar"),
    )
    unlocated = left.where(~placed("x", "y"))
    many = overlap_candidates(unlocated, right, eq_class, closed).select(
        "id", "located", F.col("c_id").alias("match_id"), "dist", F.col("c_x").alias("match_x"),
        F.col("c_y").alias("match_y"), F.col("c_ar").alias("match_ar"),
    )
    return one.unionByName(many)


def min_distance_overlap(
    left: DataFrame, right: DataFrame, out: str, eq_class: bool = True, closed: str = "left", radius: float | None = None
) -> DataFrame:
    """Smallest distance to an overlapping right event, per left event that has one (NULL if none is located).

    ``radius`` works as in ``nearest_overlap``.
    """
    def least(candidates: DataFrame) -> DataFrame:
        return candidates.groupBy("id").agg(F.min("dist").alias(out))

    if radius is None:
        return least(overlap_candidates(left, right, eq_class, closed))
    found, rest = ring_search(left, right, least, out, radius, eq_class, closed)
    left = left.select(*EVENT)
    return found.unionByName(least(overlap_candidates(rest.unionByName(left.where(~placed("x", "y"))), right, eq_class, closed)))


def ring_search(left: DataFrame, right: DataFrame, reduce, gap: str, radius: float, eq_class: bool, closed: str, growth: int = 4) -> tuple[DataFrame, DataFrame]:
    """Answers of located left events, and the events without any located candidate.

    Round by round the radius grows and only unanswered events go on. A round looks into the space cells around an event, which hold every
    candidate up to the radius, so the best one found within it (column ``gap`` of ``reduce``) is the nearest of all. The first radius is
    ``radius`` or, where right events are sparse, what holds about one of a day and class. The last round needs no space cells: what it leaves overlaps no located event.
    """
    def extent(df: DataFrame) -> DataFrame:
        return df.agg(F.max(F.greatest(F.abs("x"), F.abs("y"))).alias("far"))

    left, right = (materialize(df.where(placed("x", "y")).select(*EVENT), "ring-events") for df in (left, right))  # read in every round
    farthest = extent(left).unionByName(extent(right)).agg(F.coalesce(F.max("far"), F.lit(0.0))).first()[0]
    crowds = right.groupBy(*(["goes_class"] if eq_class else []), cell_start(micros(F.col("start_time")), TIME_CELL).alias("day")).count()
    crowd = crowds.agg(F.coalesce(F.sum(F.col("count") * F.col("count")) / F.sum("count"), F.lit(1.0))).first()[0]
    typical = right.agg(F.coalesce(F.percentile_approx(F.greatest(F.abs("x"), F.abs("y")).cast("double"), 0.5), F.lit(0.0))).first()[0]  # not moved by a far outlier
    radius = max(radius, 2 * typical / crowd**0.5)
    rest, found = left, None
    while True:
        last = radius > farthest
        near = reduce(overlap_candidates(rest, right, eq_class, closed, None if last else radius))
        answers = materialize(near if last else near.where(F.col(gap) <= radius), "ring-answers")
        found = answers if found is None else found.unionByName(answers)
        rest = materialize(rest.join(answers.select("id"), "id", "left_anti"), "ring-rest")
        if last or rest.isEmpty():
            return found, rest
        radius *= growth


def nearest_overlap(
    left: DataFrame, right: DataFrame, eq_class: bool = True, closed: str = "none", radius: float | None = None
) -> DataFrame:
    """Closest overlapping event of each located left event: id and the struct ``m``.

    With ``radius`` partners are searched by ``ring_search``, from that radius on; events that overlap unlocated events only get the
    first of those. The result does not depend on the radius.
    """
    def nearest(candidates: DataFrame) -> DataFrame:
        far = F.coalesce(F.col("dist"), F.lit(float("inf")))
        return candidates.where("located").groupBy("id").agg(F.min(_candidate(far.alias("dist"))).alias("m"))

    if radius is None:
        return nearest(overlap_candidates(left, right, eq_class, closed))
    found, rest = ring_search(left, right, nearest, "m.dist", radius, eq_class, closed)
    return found.unionByName(nearest(overlap_candidates(rest, right.where(~placed("x", "y")), eq_class, closed)))


PAIR_SIDE = ("start_time", "id", "x", "y", "ar")


def closest_pair(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per event, the candidate pair of two sources at the smallest squared distance (infinite without a located pair).

    Two-colour closest pair over a pyramid of space cells. The finest cells hold about one candidate of an event; pairs
    meet in neighbouring cells only, and a pair no farther apart than a cell is wide is the closest of all. Events without one go on with
    cells twice as wide, until one cell spans all their candidates. Events with no located candidate on one side get the first of each.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("id", F.struct(*[F.col(f"c_{c}").alias(c) for c in PAIR_SIDE]).alias(name))

    def located(df: DataFrame, name: str) -> DataFrame:
        return df.where(placed(f"{name}.x", f"{name}.y")).withColumns({"px": F.col(f"{name}.x").cast("double"), "py": F.col(f"{name}.y").cast("double")})

    a, b = side(a, "a"), side(b, "b")
    one, other = materialize(located(a, "a"), "pair-a"), materialize(located(b, "b"), "pair-b")
    both = one.select("id", "px", "py", F.lit(1).alias("of_a")).unionByName(other.select("id", "px", "py", F.lit(0).alias("of_a")))
    spread = F.greatest(F.max("px") - F.min("px"), F.max("py") - F.min("py"))
    shape = both.groupBy("id").agg(spread.alias("spread"), F.sum("of_a").alias("na"), F.sum(1 - F.col("of_a")).alias("nb")).where("na > 0 and nb > 0")
    rest = materialize(shape.select("id", "spread", F.when(F.col("spread") > 0, F.col("spread") / F.sqrt(F.greatest("na", "nb"))).otherwise(1.0).alias("size")), "pair-sizes")
    shapes, found = rest, None
    steps = F.array(F.lit(-1), F.lit(0), F.lit(1))
    while not rest.isEmpty():
        pairs = cell_pairs(one.join(rest, "id"), other.join(rest.select("id", "size"), "id"), steps)
        best = pairs.where(F.col("d2") <= F.col("size") * F.col("size")).groupBy("id").agg(F.min(F.struct("d2", "a", "b")).alias("p"))
        answers = materialize(best.select("id", F.col("p.d2").alias("d2"), F.col("p.a").alias("a"), F.col("p.b").alias("b")), "pair-answers")
        found = answers if found is None else found.unionByName(answers)
        rest = materialize(rest.join(answers.select("id"), "id", "left_anti").withColumn("size", 2 * F.col("size")), "pair-rest")
    first = a.join(shapes.select("id"), "id", "left_anti").groupBy("id").agg(F.min("a").alias("a")).join(b.groupBy("id").agg(F.min("b").alias("b")), "id")
    first = first.select("id", F.lit(float("inf")).alias("d2"), "a", "b")
    return first if found is None else found.unionByName(first)


PAIRS_WANTED = 8.0
"""Pairs of two sources within the first radius that an event of a class should overlap."""


def closest_overlapping_pair(left: DataFrame, second: DataFrame, third: DataFrame, eq_class: bool = True, closed: str = "none", rounds: int = 2) -> DataFrame:
    """``closest_pair`` of the overlap candidates of each event in two sources, without listing all candidates.

    Near pairs of the two sources come first: same class, within a radius that follows the density of the class, and in time no farther apart
    than the longest event of the class can span. They are stored in the order of their distance (and of ties), so that the best pair of
    an event is the least number among the pairs it overlaps, which the join task reduces. Events without a pair within the radius go on
    with one four times as large; after ``rounds``, and in classes too sparse for that, the candidates of the events that are left are compared.
    """
    kind = F.col("goes_class") if eq_class else F.lit("")
    left, second, third = (materialize(df.select(*EVENT, kind.alias("kind")), "pair-events") for df in (left, second, third))  # read in every round
    one, other = (df.where(placed("x", "y")) for df in (second, third))
    scales, typical = _pair_scales(left, one, other)
    rest, found = left, None
    for grown in (4.0**i for i in range(rounds)):
        near = scales.withColumn("radius", F.col("radius") * grown).where(F.col("radius") < typical / 2)
        if near.isEmpty() or rest.isEmpty():
            break
        pairs = materialize(_near_pairs(one, other, near), "near-pairs")
        spans = pairs.select("r_kind", "q_start", "q_end", "rank")
        met = overlap_pairs(rest.select("id", "start_time", "end_time", "kind"), spans, ("start_time", "end_time"), ("q_start", "q_end"), [("kind", "r_kind")], closed)
        best = met.groupBy("id").agg(F.min("rank").alias("rank"))
        answers = materialize(best.join(pairs.select("rank", "d2", "a", "b"), "rank").select("id", "d2", "a", "b"), "pair-answers")
        found = answers if found is None else found.unionByName(answers)
        rest = materialize(rest.join(answers.select("id"), "id", "left_anti"), "pair-rest")
    open_pairs = closest_pair(overlap_candidates(rest, second, eq_class, closed), overlap_candidates(rest, third, eq_class, closed))
    return open_pairs if found is None else found.unionByName(open_pairs)


def _pair_scales(left: DataFrame, one: DataFrame, other: DataFrame) -> tuple[DataFrame, float]:
    """For each class in all three tables the radius that holds some pairs of an event and the longest event; and the median coordinate."""
    length = F.greatest(micros(F.col("end_time")) - micros(F.col("start_time")), F.lit(0))
    spans = left.groupBy("kind").agg(F.avg(length).alias("span"), F.max(length).alias("reach"))

    def met(df: DataFrame, name: str) -> DataFrame:
        days = df.groupBy("kind", cell_start(micros(F.col("start_time")), TIME_CELL).alias("day")).agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(length).alias("long"))
        return days.groupBy("kind").agg((F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("crowd"), (F.sum("long") / F.sum("n")).alias("own")).join(
            spans.select("kind", "span"), "kind").select("kind", (F.col("crowd") * (F.col("span") + F.col("own")) / float(DAY_US)).alias(name))

    size = F.greatest(F.abs("x"), F.abs("y")).cast("double")
    typical = one.select(size.alias("at")).unionByName(other.select(size.alias("at"))).agg(F.coalesce(F.percentile_approx("at", 0.5), F.lit(0.0))).first()[0]
    radius = 2 * typical * F.sqrt(F.lit(PAIRS_WANTED / pi) / (F.col("met_a") * F.col("met_b")))
    scales = met(one, "met_a").join(met(other, "met_b"), "kind").join(spans.select("kind", "reach"), "kind")
    return materialize(scales.where("met_a > 0 and met_b > 0").select("kind", "reach", radius.alias("radius")), "pair-scales"), typical


def _near_pairs(one: DataFrame, other: DataFrame, scales: DataFrame) -> DataFrame:
    """Pairs of a class up to its radius that one event can overlap: r_kind, rank (numbers in their order), d2, a, b, and the span that such an event must overlap."""
    record = F.struct(*PAIR_SIDE)
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    sides = [df.join(scales, "kind").select("kind", "reach", "radius", "start_time", "end_time", x.alias("x"), y.alias("y"), record.alias("of")) for df in (one, other)]
    reach = F.make_dt_interval(secs=F.col("reach") / 1e6)
    a = sides[0].withColumns({"from": F.col("start_time") - reach, "to": F.col("end_time") + reach}).withColumnsRenamed({"of": "a"})
    b = sides[1].withColumns({"cx": F.floor(F.col("x") / F.col("radius")), "cy": F.floor(F.col("y") / F.col("radius"))})
    b = b.select(*[F.col(c).alias(f"r_{c}") for c in ("kind", "start_time", "end_time", "x", "y", "cx", "cy")], F.col("of").alias("b"))
    pairs = overlap_pairs(
        a, b, ("from", "to"), ("r_start_time", "r_end_time"), [("kind", "r_kind"), ("__sx", "r_cx"), ("__sy", "r_cy")], "both",
        copies=lambda rows: _space_cells(rows, F.col("radius")),
    )
    d2 = F.pow(F.col("x") - F.col("r_x"), F.lit(2.0)) + F.pow(F.col("y") - F.col("r_y"), F.lit(2.0))
    sure = F.pow(0.999 * F.col("radius"), F.lit(2.0))  # cells hold every pair up to the radius, but for the rounding of the last digit
    pairs = pairs.withColumn("d2", d2).where(F.col("d2") <= sure)
    pairs = pairs.select(
        "r_kind", F.greatest("start_time", "r_start_time").alias("q_start"), F.least("end_time", "r_end_time").alias("q_end"), "d2", "a", "b",
    )
    return pairs.orderBy("d2", "a", "b").withColumn("rank", F.monotonically_increasing_id())


def cell_pairs(one: DataFrame, other: DataFrame, steps: Column) -> DataFrame:
    """Pairs of each id in the same or neighbouring cells, with their squared distance."""
    def cell(c: str) -> Column:
        return F.floor(F.col(c) / F.col("size"))

    near = one.withColumn("cx", F.explode(F.transform(steps, lambda d: cell("px") + d))).withColumn("cy", F.explode(F.transform(steps, lambda d: cell("py") + d)))
    own = other.select("id", "b", F.col("px").alias("qx"), F.col("py").alias("qy"), cell("px").alias("cx"), cell("py").alias("cy"))
    d2 = F.pow(F.col("px") - F.col("qx"), F.lit(2.0)) + F.pow(F.col("py") - F.col("qy"), F.lit(2.0))
    return near.join(own, ["id", "cx", "cy"]).withColumn("d2", d2)


def resolve_secondary_matches(
    second: DataFrame, third: DataFrame, near: float = 50.0, base: DataFrame | None = None, radius: float | None = None,
) -> DataFrame:
    """One candidate of each secondary source per event, as structs ``second`` and ``third``.

    Located events keep their nearest candidates. Unlocated events: near-duplicates collapse to
    the first; otherwise the pair of the two sources that lies closest decides; without a
    counterpart the first by start time is taken.

    ``second`` and ``third`` are the candidates or, with ``base``, the two sources of events themselves. The candidates of the events in ``base``
    are then only counted and reduced where they are found: located events search their nearest (``radius`` as in ``nearest_overlap``),
    the others keep the first and the last, and the closest pair is ``closest_overlapping_pair``.
    """
    if base is not None:
        base, second, third = (materialize(df.select(*EVENT), "matched-points") for df in (base, second, third))  # read in several searches
        unlocated = base.where(~placed("x", "y"))
        summaries = [summarize_overlaps(unlocated, df, near) for df in (second, third)]
        open_events = _decide(*summaries, lambda contested: closest_overlapping_pair(unlocated.join(contested, "id", "left_semi"), second, third))
        return _nearest_of_each(base.where(placed("x", "y")), second, third, radius).unionByName(open_events)
    second, third = materialize(second, "second-candidates"), materialize(third, "third-candidates")  # read for the summaries and for the pairs

    def closest(contested: DataFrame) -> DataFrame:
        return closest_pair(second.join(contested, "id", "left_semi"), third.join(contested, "id", "left_semi"))

    return _decide(summarize_candidates(second, near), summarize_candidates(third, near), closest)


def summarize_overlaps(unlocated: DataFrame, right: DataFrame, near: float = 50.0) -> DataFrame:
    """``summarize_candidates`` of the overlapping events of unlocated events; candidates are reduced to four numbers in the join task.

    The right events are numbered in their order, so the first and the last of an event are numbers too, and the first is the nearest.
    """
    plain = [F.col(c) for c in PAIR_SIDE]
    ranked = materialize(right.select(*EVENT).orderBy(*plain).withColumn("rank", F.monotonically_increasing_id()), "ranked-events")
    out = overlap_candidates(unlocated, ranked, more=("rank",)).groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.count("c_x").alias("n_located"), F.min("c_rank").alias("low"), F.max("c_rank").alias("high"),
    )
    for name, at in (("first", "low"), ("last", "high")):
        out = out.join(ranked.select(F.col("rank").alias(at), F.struct(*plain).alias(name)), at)
    nearest = F.struct(F.lit(float("inf")).alias("dist"), *[F.col(f"first.{c}").alias(c) for c in PAIR_SIDE])
    out = out.select("id", F.lit(False).alias("located"), "n", "n_located", nearest.alias("nearest"), "first", "last")
    return out.withColumn("near_duplicate", is_near_duplicate(F.col("n"), F.col("first"), F.col("last"), near))


def _decide(second: DataFrame, third: DataFrame, closest: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The choice of ``resolve_secondary_matches`` from the summaries of two sources; ``closest`` finds the closest pairs of some events."""
    s = second.select("id", F.struct("*").alias("s"))
    h = third.select("id", F.struct("*").alias("h"))
    both = s.join(h, "id", "full_outer")
    located = F.coalesce(F.col("s.located"), F.col("h.located"))
    s_open = (F.col("s.n") > 1) & ~F.col("s.near_duplicate") & (F.col("s.n_located") > 0)
    h_open = (F.col("s.n") == 1) & (F.col("h.n") > 1) & ~F.col("h.near_duplicate") & (F.col("h.n_located") > 0)
    by_pair = F.coalesce(~located & F.col("h").isNotNull() & (s_open | h_open), F.lit(False))
    both = materialize(both.withColumns({"located": located, "by_pair": by_pair}), "secondary-summaries")
    pair = closest(both.where("by_pair").select("id"))
    joined = both.join(pair.withColumnRenamed("a", "pa").withColumnRenamed("b", "pb"), "id", "left")

    def choose(side: str, paired: str) -> Column:
        own = F.col(side)
        plain = ["start_time", "id", "x", "y", "ar"]
        nearest = F.struct(*[own["nearest"][c].alias(c) for c in plain])
        return F.when(F.col("located"), F.when(own.isNotNull(), nearest)).when(F.col("by_pair"), F.col(paired)).otherwise(own["first"])

    gap = {n: F.when(F.col("located"), F.nullif(F.col(f"{n}.nearest.dist"), F.lit(float("inf")))) for n in ("s", "h")}
    return joined.select(
        "id", choose("s", "pa").alias("second"), gap["s"].alias("second_dist"),
        choose("h", "pb").alias("third"), gap["h"].alias("third_dist"),
    )


def _nearest_of_each(located: DataFrame, second: DataFrame, third: DataFrame, radius: float | None) -> DataFrame:
    """The nearest candidate of each source per located event, searched by ``nearest_overlap``."""
    plain = F.struct(*[F.col(f"m.{c}").alias(c) for c in PAIR_SIDE])

    def side(right: DataFrame, name: str) -> DataFrame:
        gap = F.nullif(F.col("m.dist"), F.lit(float("inf")))
        return nearest_overlap(located, right, radius=radius).select("id", plain.alias(name), gap.alias(f"{name}_dist"))

    return side(second, "second").join(side(third, "third"), "id", "full_outer")


def match_two_sources(base: DataFrame, second: DataFrame, third: DataFrame, near: float = 50.0, radius: float | None = 275.0) -> DataFrame:
    """One candidate of each secondary source per event, searched by ``nearest_overlap`` for located events
    and by ``resolve_secondary_matches`` for the others."""
    return resolve_secondary_matches(second, third, near, base, radius)


def verify_matches(df: DataFrame, second_dist: str, third_dist: str, pair_dist: str, threshold: float = 275.0) -> DataFrame:
    """Verification flags by distance; a missing distance is False."""
    def near(name: str) -> Column:
        return F.coalesce(F.col(name) < threshold, F.lit(False))

    return df.withColumns({
        "ssw_verified": near(second_dist),
        "hinode_verified": near(third_dist),
        "primary_verified": near(second_dist) | near(third_dist),
        "secondary_verified": near(pair_dist),
    })


def exists_in_window(
    windows: DataFrame, events: DataFrame, win_start: str, win_end: str, event_on: str, event_cols: list[str], prefix: str = "ev_",
) -> DataFrame:
    """First event strictly inside each window, NULL columns when there is none.

    All windows with one start have the same next event. Each distinct start finds the event strictly after it by an as-of
    scan over time cells, the windows get it by an equality join on the start, and the end is compared last. No window meets more than one event.
    """
    times = events.where(F.col(event_on).isNotNull()).groupBy(F.col(event_on).alias("__et")).agg(
        F.min(F.struct(*event_cols)).alias("__rec")
    )
    starts = windows.where(F.col(win_start).isNotNull()).select(F.col(win_start).alias("__start")).distinct()
    found = asof_join(starts, times, [], "__start", "__et", ["__et", "__rec"], direction="next")
    joined = windows.join(found, F.col(win_start) == F.col("__start"), "left")
    inside = F.col("__et") < F.col(win_end)
    return joined.select(
        *[F.col(c) for c in windows.columns], F.when(inside, F.col("__et")).alias(f"{prefix}time"),
        *[F.when(inside, F.col(f"__rec.{c}")).alias(prefix + c) for c in event_cols],
    )


def pre_event_window(
    series: DataFrame, events: DataFrame, by: list[str], on: str, event_id: str, peak: str, span: timedelta = timedelta(hours=36),
    width: timedelta = timedelta(hours=12),
) -> DataFrame:
    """Series rows of the event's key in ``[peak - span, peak]``, once per event."""
    ev = events.select(*by, event_id, F.col(peak).alias("__peak")).withColumn(
        "__cell", F.explode(_cells(F.col("__peak") - F.lit(span), F.col("__peak"), width))
    )
    rows = series.withColumn("__cell", cell_start(micros(F.col(on)), width))
    hit = (F.col(on) >= F.col("__peak") - F.lit(span)) & (F.col(on) <= F.col("__peak"))
    return rows.join(ev, [*by, "__cell"]).where(hit).drop("__cell", "__peak")


BOX = ["lat_min", "lat_max", "lon_min", "lon_max"]
LATS, LONS = ("lat_min", "lat_max"), ("lon_min", "lon_max")


def _edges(slack: float = 0.0, wrap: bool = False) -> list[Column]:
    """The edges of a row's box widened by ``slack``, as doubles."""
    south, north, west, east = (F.col(c).cast("double") for c in BOX)
    east = sphere.unwrapped(west, east) if wrap else east
    return [south - slack, north + slack, west - slack, east + slack]


def _boxes(df: DataFrame, *keep: str | Column, slack: float = 0.0, wrap: bool = False) -> DataFrame:
    """Rows whose box is given in full, widened by ``slack``, as doubles."""
    return df.where(placed(*BOX)).select(*keep, *[e.alias(c) for e, c in zip(_edges(slack, wrap), BOX)])


def _region_cells(
    boxes: DataFrame, regions: DataFrame, window: timedelta, wrap: bool
) -> tuple[DataFrame, Callable[[Column], Column]]:
    """The region records under the cells that boxes of ``_boxes`` at ``__t`` can share with them, and their longitude at a time.

    Cells are time cells of a quarter of ``window``, and cells of the box's size. The few records are listed under the times they count for, each with
    the stretch that the region passes in that time.
    """
    step = window / 4
    at, a_day = F.col("__at"), rotation_lon_delta(F.col("lat"), F.lit(1.0))
    points = regions.where(placed("lat", "lon")).select(
        "region", micros(F.col("ar_time")).alias("__at"), F.col("lat").alias("__lat"), F.col("lon").alias("__lon"), a_day.alias("__a_day")
    )

    def passed(until: Column) -> Column:
        return F.col("__lon") + F.col("__a_day") * ((until - at) / float(DAY_US))

    cells = F.sequence(cell_start(at - us(window) + 1, step), cell_start(at + us(window), step), F.lit(us(step)))
    points = points.withColumn("__tc", F.explode(cells))
    ends = [passed(F.col("__tc")), passed(F.col("__tc") + us(step))]
    return sphere.point_cells(points, F.col("__lat"), F.least(*ends), sphere.shapes(boxes, LATS, LONS, wrap=wrap), wrap, F.greatest(*ends)), passed


def region_candidates(
    series: DataFrame, regions: DataFrame, by: list[str], on: str, window: timedelta, slack: float, wrap: bool = False
) -> DataFrame:
    """Boxes and the region records that share their cell: time cells of a quarter of ``window``, and cells of the box's size."""
    t = micros(F.col(on))
    boxes = _boxes(series, *by, on, t.alias("__t"), cell_start(t, window / 4).alias("__tc"), slack=slack, wrap=wrap)
    points, passed = _region_cells(boxes, regions, window, wrap)
    pairs = sphere.box_cells(boxes, LATS, LONS, wrap).join(points, ["__tc", *sphere.CELL])
    pairs = pairs.withColumn("__lon_at", passed(F.col("__t")))
    return pairs.where(F.col("__lo") == sphere.lon_cell(F.col("__lon_at"), F.col("__lo_level"), wrap)).drop("__tc", *sphere.CELL)


def regions_in_box(
    series: DataFrame, regions: DataFrame, by: list[str], on: str, window: timedelta = timedelta(hours=12), slack: float = 3.0,
    out: str = "region_numbers", keyed: DataFrame | None = None, wrap: bool = False,
) -> DataFrame:
    """Numbers of the region records in ``[t - window, t + window)`` inside each row's box widened by ``slack``, ``;``-joined.

    A record counts as often as it is listed, at the place to which rotation has moved it by ``t``. Boxes with a missing edge hold nothing.
    With ``keyed`` series that have no entry there get an empty text. Longitudes are plain numbers; with ``wrap`` they are
    angles, so that 180 and -180 are one meridian and a box whose ``lon_min`` is above its ``lon_max`` lies across it.

    Pairs of rows and records grow with the product of both sides, so none is shuffled, sorted or stored. The rows of one time lie in one part:
    of their time cell, which is dealt into at most ``PARTS_OF_A_CELL`` parts, each with the records of its time. A part is joined in
    one task on the cells of ``region_candidates``, its rows in order, so that each list is whole before the next one begins, and a row carries its own columns along.
    """
    aggregate_in_order(series.sparkSession)
    key, part, own = [*by, on], ["__tc", "__part"], [c for c in series.columns if c not in (*by, on)]
    timed = F.lit(True)
    for c in key:
        timed = timed & F.col(c).isNotNull()
    boxed = F.lit(True)
    owners = series.where(timed)
    if keyed is not None:
        owners, boxed = owners.join(keyed.select(*by).distinct().withColumn("__keyed", F.lit(True)), by, "left"), F.col("__keyed")
    t = micros(F.col(on))
    edges = _edges(slack, wrap)
    box = F.when(boxed & placed(*BOX), F.struct(*[e.alias(c) for e, c in zip(edges, BOX)]))
    owners = owners.select(*key, t.alias("__t"), cell_start(t, window / 4).alias("__tc"), F.struct(F.lit(True).alias("__row"), *own).alias("__own"), box.alias("__box"))
    cells = owners.groupBy("__tc").agg(F.least(F.ceil(F.count(F.lit(1)) / SLOTS_OF_A_PART), F.lit(PARTS_OF_A_CELL)).alias("__parts"))
    cells = materialize(cells, "row-cells")
    points, passed = _region_cells(owners.where(F.col("__box").isNotNull()).select("__box.*"), regions, window, wrap)
    points = points.join(cells, "__tc").withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__parts") - 1))).drop("__parts").repartition(*part)

    owners = owners.groupBy(*key, "__t", "__tc").agg(F.collect_list("__own").alias("__rows"), F.collect_list("__box").alias("__boxes"))
    owners = owners.join(cells, "__tc").withColumn("__part", F.pmod(F.xxhash64(*key), "__parts")).drop("__parts")
    rows = owners.select("*", F.posexplode_outer("__boxes").alias("__box_number", "__box")).select("*", "__box.*").drop("__box", "__boxes")
    rows = sphere.box_cells(rows, LATS, LONS, wrap, outer="__cell_number")
    first = F.coalesce("__box_number", F.lit(0)) + F.coalesce("__cell_number", F.lit(0)) == 0  # the row itself travels once
    rows = rows.withColumns({"__first": first, "__rows": F.when(first, F.col("__rows"))}).drop("__box_number", "__cell_number").repartition(*part)
    leads = F.row_number().over(Window.partitionBy(*part, *key).orderBy(F.desc("__first"))) == 1  # puts the rows in order, too
    rows = rows.withColumn("__rows", F.when(leads, F.col("__rows"))).drop("__first")

    points = points.withColumnsRenamed({c: f"__p_{c}" for c in (*part, *sphere.CELL)})
    lon_at = passed(F.col("__t"))
    meet = (F.col("__at") >= F.col("__t") - us(window)) & (F.col("__at") < F.col("__t") + us(window)) & sphere.in_box(F.col("__lat"), lon_at, LATS, LONS, wrap)
    for c in (*part, *sphere.CELL):
        meet = meet & (F.col(c) == F.col(f"__p_{c}"))
    meet = meet & (F.col("__lo") == sphere.lon_cell(lon_at, F.col("__lo_level"), wrap))
    met = rows.join(points.hint("shuffle_hash"), meet, "left").select(*part, *key, "__rows", "region")
    lists = met.groupBy(*part, *key).agg(F.first("__rows", True).alias("__rows"), F.collect_list("region").alias("__regions"))
    whole = lists.select(*key, "__rows", F.concat_ws(";", F.sort_array("__regions")).alias(out)).withColumn("__row", F.explode("__rows"))
    whole = whole.select(*key, *[F.col(f"__row.{c}").alias(c) for c in own], out)
    rest = series.where(~timed).withColumn(out, F.lit(""))
    return whole.unionByName(rest.select(*whole.columns))


def _row_boxes(series: DataFrame, by: list[str], on: str, wrap: bool) -> tuple[DataFrame, DataFrame]:
    """Rows with a whole box and the starts (``__from`` to ``__to``, microseconds) to which they are nearest, and the lifetime and first row of each series."""
    rows = _boxes(series, *by, F.col(on).alias("__ts"), wrap=wrap)
    lifetimes = rows.groupBy(*by).agg(
        F.min("__ts").alias("__first"), F.max("__ts").alias("__last"), F.min(F.struct("__ts", *BOX)).alias("__row")
    )
    near = neighbours(rows, by, "__ts", ["__ts"]).join(lifetimes.select(*by, "__first", "__last"), by)
    t, before, after = micros(F.col("__ts")), micros(F.col("prev___ts")), micros(F.col("next___ts"))
    near = near.withColumns({
        "__from": F.coalesce(F.ceil((before + t) / 2), t),
        "__to": F.coalesce(F.ceil((t + after) / 2) - 1, t),
    })
    return near, lifetimes


def match_by_location(
    events: DataFrame, series: DataFrame, by: list[str], on: str, width: timedelta = timedelta(minutes=1), wrap: bool = False,
    peak: str | None = None, entry: Callable[[Callable[[str], Column]], Column] | None = None, known: DataFrame | None = None,
) -> DataFrame:
    """(event id, series key) pairs: the event overlaps the series' lifetime and lies in the box
    of the series row nearest to the event start (the later row on ties).

    A row is nearest for starts between the midpoints to its neighbours, so each row with a whole box becomes a small region of time,
    latitude and longitude. It lies under the time cell of its first instant, on the level of its length (``width`` * 2^level), and under the
    cells of its box; events look at the two time cells in which such an instant can lie. Starts before the first row belong to the first row.
    Rows know the lifetime of their series before they meet events, so pairs are final where they are found and are never shuffled here.
    ``events``: id, start_time, end_time, lat, lon. ``series``: lat_min, lat_max, lon_min, lon_max. For ``wrap`` see ``regions_in_box``.
    With ``peak``, a time of the events, the result is no pairs but the series with the list of its events in each slot, see ``_lists_in_slots``,
    also for ``entry`` and ``known``.
    """
    near, lifetimes = _row_boxes(series, by, on, wrap)
    if peak is not None:
        return _lists_in_slots(events, series, near, lifetimes, by, on, peak, wrap, entry, known)
    ev = events.select("id", "start_time", "end_time", "lat", "lon", micros(F.col("start_time")).alias("__s")).where(placed("lat", "lon"))
    inside = sphere.in_box(F.col("lat"), F.col("lon"), LATS, LONS, wrap)

    def looking(df: DataFrame, found: Column) -> DataFrame:
        return sphere.point_cells(df, F.col("lat").cast("double"), F.col("lon").cast("double"), found, wrap)

    life = ["__first", "__last"]
    longer = (F.col("__to") - F.col("__from")) / us(width)
    near = near.select(*by, *BOX, *life, "__from", "__to", F.greatest(F.ceil(F.log2(F.greatest(longer, F.lit(1.0)))), F.lit(0)).cast("int").alias("__t_level"))
    size = F.lit(us(width)) * F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__t_level"))
    near = materialize(near, "row-boxes")
    alive = overlaps(F.col("start_time"), F.col("end_time"), F.col("__first"), F.col("__last"), "both")
    cells = sphere.box_cells(near.withColumn("__tc", F.col("__from") - F.pmod(F.col("__from"), size)), LATS, LONS, wrap)
    earliest = F.col("__s") - size
    found = sphere.shapes(near, LATS, LONS, "__t_level", wrap=wrap)
    anytime = F.array_distinct(F.transform(found, lambda s: s.dropFields("__t_level")))
    starts = F.sequence(earliest - F.pmod(earliest, size), F.col("__s") - F.pmod(F.col("__s"), size), size)
    during = (
        looking(ev, found)
        .withColumn("__tc", F.explode(starts))
        .join(cells, ["__t_level", "__tc", *sphere.CELL])
        .where(inside & alive & F.col("__s").between(F.col("__from"), F.col("__to")))
    )
    opening = lifetimes.select(*by, *life, "__row.*").withColumn("__te", F.col("__ts"))
    early = ev.where(F.col("end_time") >= F.col("start_time"))
    early = overlap_pairs(
        early, sphere.box_cells(opening, LATS, LONS, wrap).withColumnsRenamed({c: f"{c}_of" for c in sphere.CELL}),
        ("start_time", "end_time"), ("__ts", "__te"), [(c, f"{c}_of") for c in sphere.CELL], "both",
        copies=lambda df: looking(df, anytime),
    ).where(inside & alive & (F.col("start_time") < F.col("__ts")))
    return during.select("id", *by).unionByName(early.select("id", *by))


def _lists_in_slots(
    events: DataFrame, series: DataFrame, near: DataFrame, lifetimes: DataFrame, by: list[str], on: str, peak: str, wrap: bool,
    entry: Callable[[Callable[[str], Column]], Column] | None = None, known: DataFrame | None = None, width: timedelta = TIME_CELL,
) -> DataFrame:
    """Series rows with ``matched``, the unordered list of the matched events (less their times) whose ``peak`` lies in the row's slot: row <= peak < next row. The last row has no slot.

    With ``entry`` lists hold what it makes of an event, whose columns it asks for by name, and of the columns of ``known``; a series that has several rows there has an
    entry for each.

    Pairs grow with the product of both sides, so none is shuffled, sorted or stored. A slot lies in one part: of the time cell of its first instant, on
    the level of its length (``width`` * 4^n), which is dealt into at most ``PARTS_OF_A_CELL`` parts. Events are copied to the parts of
    the two cells of each level in which a slot with their peak can begin. A part is joined in one task on the cells of the boxes and on stretches of time, its
    slots in order, so that each list is whole before the next one begins, and only one list and the events of the part are in memory.
    A slot meets the boxes of the rows nearest to any start that the least and the greatest lag of a peak allow.
    """
    aggregate_in_order(series.sparkSession)
    key, part, own = [*by, on], ["__t_level", "__tc", "__part"], [c for c in series.columns if c not in (*by, on)]
    timed = F.lit(True)
    for c in key:
        timed = timed & F.col(c).isNotNull()
    ev = events.where(placed("lat", "lon")).withColumns({"__s": micros(F.col("start_time")), "__e": micros(F.col("end_time")), "__p": micros(F.col(peak))})
    ev = ev.where(F.col("__s").isNotNull() & F.col("__e").isNotNull() & F.col("__p").isNotNull()).drop("start_time", "end_time", peak)
    lag = F.col("__p") - F.col("__s")
    least, most, earliest, total = ev.agg(F.min(lag), F.max(lag), F.min("__s"), F.count(F.lit(1))).first()
    stretches = 1 if total < EVENTS_OF_A_PACK[0] else min(1 + total // EVENTS_OF_A_PACK[1], STRETCHES_OF_A_CELL)

    slots = series.where(timed).groupBy(*key).agg(F.collect_list(F.struct(F.lit(True).alias("__row"), *own)).alias("__rows"))
    slots = neighbours(slots, by, on, [on], want=("next",)).withColumns({"__p0": micros(F.col(on)), "__p1": micros(F.col(f"next_{on}")) - 1})
    size = F.lit(us(width)) * F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__t_level"))
    length = cell_level(F.col(on), F.col(f"next_{on}"), width)
    slots = slots.withColumn("__t_level", (F.ceil(length / 2) * 2).cast("int")).drop(f"next_{on}")
    slots = materialize(slots.withColumn("__tc", F.col("__p0") - F.pmod(F.col("__p0"), size)), "slots")

    box = [*by, *BOX, micros(F.col("__first")).alias("__born"), "__from", "__to"]
    opening = lifetimes.select(*by, "__first", "__row.*").withColumns({"__from": F.least(F.lit(earliest).cast("long"), micros(F.col("__first")) - 1), "__to": micros(F.col("__first")) - 1})
    real = (F.col(LATS[0]) <= F.col(LATS[1])) & (F.col(LONS[0]) <= F.col(LONS[1]))
    boxes = near.select(*box).unionByName(opening.select(*box)).where((F.col("__from") <= F.col("__to")) & real)
    boxes = boxes.withColumns({"__b0": instant(F.col("__from")), "__b1": instant(F.col("__to"))}).withColumnsRenamed({c: f"__b_{c}" for c in by})
    boxes = materialize(boxes, "row-boxes")
    asked = slots.where(F.col("__p1").isNotNull()).select(*key, "__p0", "__p1", instant(F.col("__p0") - F.lit(most or 0)).alias("__a0"), instant(F.col("__p1") - F.lit(least or 0)).alias("__a1"))
    pieces = overlap_pairs(asked, boxes, ("__a0", "__a1"), ("__b0", "__b1"), [(c, f"__b_{c}") for c in by], "both")
    during = {"__low": F.greatest("__p0", F.col("__from") + (least or 0)), "__high": F.least("__p1", F.col("__to") + (most or 0))}
    pieces = pieces.withColumns(during).where(F.col("__low") <= F.col("__high")).drop("__p0", "__p1", "__a0", "__a1", "__b0", "__b1", *[f"__b_{c}" for c in by])
    pieces = pieces if known is None else pieces.join(known, by, "left")
    slots = slots.join(pieces, key, "left").withColumn("__piece", F.row_number().over(Window.partitionBy(*key).orderBy("__from")))
    slots = materialize(slots.withColumn("__rows", F.when(F.col("__piece") == 1, F.col("__rows"))), "slot-boxes")  # the row itself travels once

    busy = slots.where(F.col("__from").isNotNull())
    found = sphere.shapes(busy, LATS, LONS, wrap=wrap)
    levels = busy.agg(F.collect_set("__t_level").alias("levels")).scalar()
    cells = busy.groupBy("__t_level", "__tc").agg(F.least(F.ceil(F.count(F.lit(1)) / SLOTS_OF_A_PART), F.lit(PARTS_OF_A_CELL)).alias("__parts"))
    cells = materialize(cells, "slot-cells")

    def stretch(t: str) -> Column:
        return F.floor(F.col(t) / F.floor(size / stretches))

    busy = busy.join(cells, ["__t_level", "__tc"]).withColumn("__part", F.pmod(F.xxhash64(*key), "__parts")).drop("__parts", "__p0", "__p1").repartition(*part)
    busy = busy.select("*", F.posexplode(F.sequence(stretch("__low"), stretch("__high"))).alias("__stretch_number", "__stretch"))
    busy = sphere.box_cells(busy, LATS, LONS, wrap, outer="__cell_number")
    first = (F.col("__piece") == 1) & (F.col("__stretch_number") + F.col("__cell_number") == 0)
    busy = busy.withColumns({"__leads": first, "__rows": F.when(first, F.col("__rows"))}).drop("__piece", "__stretch_number", "__cell_number")
    leads = F.row_number().over(Window.partitionBy(*part, *key).orderBy(F.desc("__leads"))) == 1  # puts the slots in order, too
    busy = busy.withColumn("__rows", F.when(leads, F.col("__rows"))).drop("__leads")

    copies = ev.withColumn("__t_level", F.explode(levels))
    starts = F.sequence(F.col("__p") - size - F.pmod(F.col("__p") - size, size), F.col("__p") - F.pmod(F.col("__p"), size), size)
    copies = copies.withColumn("__tc", F.explode(starts)).join(cells, ["__t_level", "__tc"])
    copies = copies.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__parts") - 1))).drop("__parts").repartition(*part)
    copies = sphere.point_cells(copies, F.col("lat").cast("double"), F.col("lon").cast("double"), found, wrap).withColumn("__stretch", stretch("__p"))
    copies = copies.withColumnsRenamed({c: f"__of_{c}" for c in copies.columns})

    def of(c: str) -> Column:
        return F.col(f"__of_{c}")

    in_box = sphere.in_box(of("lat").cast("double"), of("lon").cast("double"), LATS, LONS, wrap)
    meet = of("__p").between(F.col("__low"), F.col("__high")) & of("__s").between(F.col("__from"), F.col("__to")) & (of("__e") >= F.col("__born")) & in_box
    for c in (*part, *sphere.CELL, "__stretch"):
        meet = meet & (F.col(c) == of(c))
    made = entry(of) if entry else F.struct(*[of(c).alias(c) for c in ev.columns if c not in ("__s", "__e", "__p")])
    met = busy.join(copies.hint("shuffle_hash"), meet, "left").select(*part, *key, "__rows", F.when(of("__p").isNotNull(), made).alias("__hit"))
    lists = met.groupBy(*part, *key).agg(F.first("__rows", True).alias("__rows"), F.collect_list("__hit").alias("matched"))
    none = F.array().cast(lists.schema["matched"].dataType)
    idle = slots.where(F.col("__from").isNull()).select(*key, "__rows", none.alias("matched"))
    whole = lists.select(*key, "__rows", "matched").unionByName(idle).withColumn("__row", F.explode("__rows"))
    rest = series.where(~timed).withColumn("matched", none)
    names = [*series.columns, "matched"]
    return whole.select(*key, *[F.col(f"__row.{c}").alias(c) for c in own], "matched").select(*names).unionByName(rest.select(*names))
