"""Ordered per-key scans that never put a whole key into one task.

A window over ``PARTITION BY key ORDER BY time`` sorts every row of a key in one task, which
fails as soon as one key holds a large share of the data. Here a key is cut into time cells
and every window runs over (key, cell). What a cell needs from the cells around it is carried in by
extra boundary rows, computed from one summary row per (key, cell). The only window over a
whole key runs on those summary rows: at most time span / cell width of them per key,
however many rows the key has.

Cells of one width suit evenly spread rows. With ``most`` the cells are measured: one that holds more rows is cut at quantiles
of its times, so a burst inside one cell is several tasks, too.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import cell_start, micros
from ..session import materialize

CELL = timedelta(hours=12)
T, CELL_COL, ORD = "__t", "__cell", "__ord"
BEFORE = (Window.unboundedPreceding, -1)


def _cell(rows: DataFrame, width: timedelta) -> Column:
    """Time cell of a row; rows without a time are spread over small negative cells."""
    scattered = -F.pmod(F.xxhash64(*rows.columns), F.lit(1024)) - 1
    return F.coalesce(cell_start(F.col(T), width), scattered)


def measured_cells(rows: DataFrame, by: list[str], most: int, pieces: int = 64) -> DataFrame:
    """``rows`` with the cells in ``__cell`` that hold more than ``most`` rows cut into cells of about equal row counts.

    Crowded cells are counted, their times ``__t`` sketched, and the cuts kept as a stored boundary table with one row per crowded cell, until no cell
    is crowded; a round cuts a cell into at most ``pieces`` parts and the times at the cuts, which are cells of their own. A single
    instant stays one cell, however many rows it has. Cells still grow with time. Without crowded cells the cost is one count.
    """
    key = [*by, CELL_COL]
    shares = F.array(*[F.lit(i / pieces) for i in range(1, pieces)])
    while True:
        sizes = rows.where(F.col(T).isNotNull()).groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), F.min(T).alias("__lo"), F.max(T).alias("__hi"))
        crowded = materialize(sizes.where((F.col("__n") > most) & (F.col("__lo") < F.col("__hi"))).select(*key, "__n"), "crowded-cells")
        if crowded.isEmpty():
            return rows
        times = _join_cells(rows.select(*key, T), crowded, key, "inner").where(F.col(T).isNotNull())
        sketched = times.groupBy(*key, "__n").agg(F.percentile_approx(T, shares, 20 * pieces).alias("__q"))
        parts = F.least(F.ceil(F.col("__n") / most), F.lit(pieces))
        picked = F.transform(F.sequence(F.lit(1).cast("long"), parts - 1), lambda i: F.element_at("__q", F.floor(i * pieces / parts).cast("int")))
        edges = F.array_distinct(F.flatten(F.transform(picked, lambda c: F.array(c, c + 1))))
        cuts = materialize(sketched.select(*key, edges.alias("__cuts")), "cell-cuts")
        placed = _join_cells(rows, cuts, key, "left")
        cut = F.array_max(F.filter("__cuts", lambda c: c <= F.col(T)))
        rows = placed.withColumn(CELL_COL, F.coalesce(cut, CELL_COL)).drop("__cuts")


def _join_cells(rows: DataFrame, cells: DataFrame, key: list[str], how: str) -> DataFrame:
    """Join on (key, cell), where a missing key equals a missing key."""
    named = cells.withColumnsRenamed({c: f"__k_{c}" for c in key})
    same = [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in key]
    return rows.join(named, same, how).drop(*[f"__k_{c}" for c in key])


def _timed_cells(df: DataFrame, by: list[str], on: str, cell: timedelta, most: int | None) -> tuple[DataFrame, Column]:
    """``df`` and the cell of its rows, measured if ``most`` is given."""
    start = cell_start(micros(F.col(on)), cell)
    if most is None:
        return df, start
    timed = df.withColumns({T: micros(F.col(on)), CELL_COL: start})
    return measured_cells(timed, by, most).drop(T), F.col(CELL_COL)


def _desc(names: list[str]) -> list[Column]:
    return [F.col(n).desc() for n in names]


def carry_scan(
    rows: DataFrame,
    by: list[str],
    sources: dict[str, Column],
    *,
    order: tuple[str, ...] = (),
    inclusive: bool = True,
    want: tuple[str, ...] = ("prev", "next"),
    cell: timedelta = CELL,
    sparse: bool = False,
    most: int | None = None,
) -> DataFrame:
    """Latest earlier and earliest later non-NULL value of each source, per row.

    ``rows`` has the microsecond column ``__t``; ``order`` breaks its ties. For every source
    ``s`` the result has ``prev_s`` and/or ``next_s``, structs of (t, order columns, v).
    With ``inclusive`` a row's own value counts for ``prev``; ``next`` then starts after it.
    ``sparse`` suits sources that are NULL on most rows: the summary then sorts only rows with a value.
    ``most`` cuts cells with more rows than that (``measured_cells``).
    """
    key = [*by, CELL_COL]
    sort = [T, *order]
    slots = {name: f"__src_{name}" for name in sources}
    base = rows.withColumn(CELL_COL, _cell(rows, cell))
    if most is not None:
        base = measured_cells(base, by, most)
    for name, value in sources.items():
        packed = F.struct(*[F.col(c) for c in sort], value.alias("v"))
        base = base.withColumn(slots[name], F.when(value.isNotNull(), packed))

    held = base.where(F.col(next(iter(slots.values()))).isNotNull()) if sparse and len(slots) == 1 else base
    ends = held.groupBy(*key).agg(
        *[F.max(s).alias(f"{s}_last") for s in slots.values()],
        *[F.min(s).alias(f"{s}_first") for s in slots.values()],
    )
    if held is not base:
        ends = base.select(*key).distinct().unionByName(ends, allowMissingColumns=True)
    carried = {}
    if "prev" in want:
        earlier = Window.partitionBy(*by).orderBy(CELL_COL).rangeBetween(*BEFORE)
        carried |= {f"__in_prev_{n}": F.last(f"{s}_last", True).over(earlier) for n, s in slots.items()}
    if "next" in want:
        later = Window.partitionBy(*by).orderBy(F.desc(CELL_COL)).rangeBetween(*BEFORE)
        carried |= {f"__in_next_{n}": F.last(f"{s}_first", True).over(later) for n, s in slots.items()}
    # one boundary row per cell brings both directions and sorts first in its cell
    heads = ends.select(*key, F.lit(-1).alias(ORD), *[v.alias(n) for n, v in carried.items()])
    merged = base.withColumn(ORD, F.lit(0)).unionByName(heads, allowMissingColumns=True)
    scanned = _scan_cells(merged, key, [ORD, *sort], slots, inclusive, want)
    upto = Window.partitionBy(*key).orderBy(ORD, *sort).rowsBetween(Window.unboundedPreceding, 0)
    scanned = scanned.withColumns({n: F.first(n, True).over(upto) for n in carried})
    scanned = scanned.withColumns({f"{d}_{n}": F.coalesce(f"{d}_{n}", f"__in_{d}_{n}") for d in ("prev", "next") if d in want for n in slots})
    return scanned.where(F.col(ORD) == 0).drop(ORD, CELL_COL, *slots.values(), *carried)


def _scan_cells(rows, key, sort, slots, inclusive, want) -> DataFrame:
    forward = Window.partitionBy(*key).orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    backward = Window.partitionBy(*key).orderBy(*_desc(sort)).rowsBetween(*BEFORE)
    for direction, frame in (("prev", forward), ("next", backward)):
        if direction in want:
            rows = rows.withColumns({f"{direction}_{name}": F.last(s, True).over(frame) for name, s in slots.items()})
    return rows


def halo_scan(
    rows: DataFrame, by: list[str], source: Column, reach_us: int, *, order: tuple[str, ...], cell: timedelta
) -> DataFrame:
    """``carry_scan`` of one source named ``r`` when nothing farther than ``reach_us`` matters.

    Source rows near a cell border are copied into the neighbouring cell, so one shuffle of the
    rows is enough and no summary pass is needed. A cell is at least four reaches wide, which
    bounds the copies.
    """
    width = max(cell, timedelta(microseconds=4 * reach_us))
    step = F.lit(int(width / timedelta(microseconds=1)))
    key, sort = [*by, CELL_COL], [T, *order]
    packed = F.struct(*[F.col(c) for c in sort], source.alias("v"))
    cells = F.sequence(cell_start(F.col(T) - reach_us, width), cell_start(F.col(T) + reach_us, width), step)
    own = F.array(_cell(rows, width))
    spread = rows.withColumn("__src_r", F.when(source.isNotNull(), packed)).withColumn(
        CELL_COL, F.explode_outer(F.when(source.isNotNull(), cells).otherwise(own))
    )
    return _scan_cells(spread, key, sort, {"r": "__src_r"}, True, ("prev", "next")).drop(CELL_COL, "__src_r")


def neighbours(
    df: DataFrame, by: list[str], on: str, cols: list[str], *, order: tuple[str, ...] = (),
    want: tuple[str, ...] = ("prev", "next"), cell: timedelta = CELL, most: int | None = None,
) -> DataFrame:
    """Columns of the row before and after, as ``prev_<col>`` and ``next_<col>``."""
    packed = F.struct(*cols)
    out = carry_scan(df.withColumn(T, micros(F.col(on))), by, {"r": packed}, order=order, inclusive=False, want=want, cell=cell, most=most)
    for direction in want:
        out = out.withColumns({f"{direction}_{c}": F.col(f"{direction}_r.v.{c}") for c in cols})
    return out.drop(T, *[f"{d}_r" for d in want])


def with_cell_facts(
    df: DataFrame, by: list[str], cell: Column, partials: dict[str, Column], combine: dict[str, tuple[str, str]]
) -> DataFrame:
    """Give every row facts that depend on its whole key, without shuffling by the key alone.

    ``partials`` are aggregates per (key, cell). ``combine`` maps an output column to
    (scope, partial): scope ``before`` sums the partial over earlier cells, ``sum``, ``min`` and
    ``max`` combine it over all cells of the key. The facts travel to the rows as one
    extra row per (key, cell) that sorts first in its cell.
    """
    key = [*by, CELL_COL]
    based = df.withColumn(CELL_COL, cell)
    parts = based.groupBy(*key).agg(*[v.alias(n) for n, v in partials.items()])
    everything = Window.partitionBy(*by)
    earlier = Window.partitionBy(*by).orderBy(CELL_COL).rowsBetween(*BEFORE)
    fold = {"sum": F.sum, "min": F.min, "max": F.max}
    facts = {
        out: F.coalesce(F.sum(part).over(earlier), F.lit(0)) if scope == "before" else fold[scope](part).over(everything)
        for out, (scope, part) in combine.items()
    }
    heads = parts.select(*key, F.struct(*[v.alias(n) for n, v in facts.items()]).alias("__facts")).withColumn(ORD, F.lit(-1))
    return based.withColumn(ORD, F.lit(0)).unionByName(heads, allowMissingColumns=True)


def _spread_facts(rows: DataFrame, by: list[str], order: list[Column]) -> tuple[DataFrame, object]:
    in_cell = Window.partitionBy(*by, CELL_COL).orderBy(ORD, *order)
    facts = F.first("__facts", True).over(in_cell.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("__got", facts), in_cell


def ranked(
    df: DataFrame, by: list[str], cell: Column, order: list[str], *, pos: str = "pos", total: str = "n",
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """0-based position of every row in its key and the key's row count.

    ``cell`` must grow with ``order``. ``totals`` adds sums over the key, e.g. conditional counts.
    """
    extra = totals or {}
    rows = with_cell_facts(
        df, by, cell,
        {"__rows": F.count(F.lit(1)), **{f"__p_{n}": F.sum(v) for n, v in extra.items()}},
        {"__before": ("before", "__rows"), total: ("sum", "__rows"), **{n: ("sum", f"__p_{n}") for n in extra}},
    )
    rows, in_cell = _spread_facts(rows, by, [F.col(c) for c in order])
    position = F.row_number().over(in_cell) - 2 + F.col("__got.__before")
    return (
        rows.withColumn(pos, position.cast("long"))
        .withColumns({n: F.col(f"__got.{n}") for n in (total, *extra)})
        .where(F.col(ORD) == 0)
        .drop(ORD, CELL_COL, "__facts", "__got")
    )


def positions(
    df: DataFrame, by: list[str], on: str, *, tie: tuple[str, ...] = (), cell: timedelta = CELL, pos: str = "pos", total: str = "n",
    most: int | None = None,
) -> DataFrame:
    """0-based row position in time order and the length of the series."""
    df, cells = _timed_cells(df, by, on, cell, most)
    return ranked(df, by, cells, [on, *tie], pos=pos, total=total)


def running_sum(
    df: DataFrame, by: list[str], on: str, value: Column, out: str, *, tie: tuple[str, ...] = (), total: str | None = None,
    cell: timedelta = CELL, most: int | None = None,
) -> DataFrame:
    """Sum of ``value`` from the first row of the key up to this row."""
    based = df.withColumn("__value", value)
    combine = {"__before": ("before", "__sum")}
    if total:
        combine[total] = ("sum", "__sum")
    based, cells = _timed_cells(based, by, on, cell, most)
    rows = with_cell_facts(based, by, cells, {"__sum": F.sum("__value")}, combine)
    rows, in_cell = _spread_facts(rows, by, [F.col(on), *[F.col(c) for c in tie]])
    inside = F.coalesce(F.sum("__value").over(in_cell.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    rows = rows.withColumn(out, inside + F.col("__got.__before"))
    if total:
        rows = rows.withColumn(total, F.col(f"__got.{total}"))
    return rows.where(F.col(ORD) == 0).drop(ORD, CELL_COL, "__facts", "__got", "__value")


def key_stats(df: DataFrame, by: list[str], cell: Column, stats: dict[str, tuple[str, Column]]) -> DataFrame:
    """Minimum, maximum or sum over the key next to every row; ``stats`` maps name to (kind, column)."""
    fold = {"sum": F.sum, "min": F.min, "max": F.max}
    partials = {f"__p_{n}": fold[kind](v) for n, (kind, v) in stats.items()}
    rows = with_cell_facts(df, by, cell, partials, {n: (kind, f"__p_{n}") for n, (kind, _) in stats.items()})
    rows, _ = _spread_facts(rows, by, [])
    return (
        rows.withColumns({n: F.col(f"__got.{n}") for n in stats}).where(F.col(ORD) == 0).drop(ORD, CELL_COL, "__facts", "__got")
    )
