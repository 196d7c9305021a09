"""As-of joins against a plain search over all pairs."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventloom.operators.asof import asof_join, between_join
from eventloom.operators.scan import CELL_COL, T, measured_cells, neighbours, positions, running_sum

T0 = datetime(2020, 1, 1)
LEFT = "lid long, k long, t timestamp_ntz"
RIGHT = "rid long, k long, rt timestamp_ntz"


def at(minutes):
    return None if minutes is None else T0 + timedelta(minutes=minutes)


def tables(spark, seed=0, n=300, hot=0.5, grid=1):
    """Random rows; key 1 holds about half of them, some keys and times are missing."""
    rnd = random.Random(seed)

    def key():
        return 1 if rnd.random() < hot else rnd.choice([2, 3, 4, 5, None])

    left = [(i, key(), None if rnd.random() < 0.02 else at(rnd.randrange(0, 20000, grid))) for i in range(n)]
    times = set()
    while len(times) < n // 3:
        times.add((key() or 2, rnd.randrange(0, 20000, grid)))
    right = [(1000 + i, k, at(m)) for i, (k, m) in enumerate(sorted(times))]
    return left, right, spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)


def search(left, right, direction, tie, tolerance, closed):
    out = {}
    for lid, k, t in left:
        best = None
        mine = [(r[2], r[0]) for r in right if r[1] == k and k is not None] if t else []
        if direction == "prev":
            mine = [m for m in mine if m[0] <= t]
        elif direction == "next":
            mine = [m for m in mine if m[0] > t]
        if mine:
            gap = min(abs(m[0] - t) for m in mine)
            tied = sorted(m for m in mine if abs(m[0] - t) == gap)
            best = None if tie == "null" and len(tied) > 1 else tied[-1 if tie == "later" else 0]
            if best and tolerance is not None and (gap > tolerance or (not closed and gap == tolerance)):
                best = None
        out[lid] = best and best[1]
    return out


@pytest.mark.parametrize("direction", ["nearest", "prev", "next"])
@pytest.mark.parametrize("tie", ["later", "earlier", "null"])
@pytest.mark.parametrize("tolerance, closed", [(None, True), (timedelta(minutes=60), True), (timedelta(minutes=60), False)])
def test_asof_equals_search(spark, direction, tie, tolerance, closed):
    if direction != "nearest" and tie != "later":
        pytest.skip("ties only exist for nearest")
    left, right, l, r = tables(spark, grid=30)
    got = asof_join(l, r, ["k"], "t", "rt", ["rid"], direction=direction, tie=tie, tolerance=tolerance, closed=closed, cell=timedelta(hours=5))
    assert {x.lid: x.rid for x in got.collect()} == search(left, right, direction, tie, tolerance, closed)


@pytest.mark.parametrize("minutes, hit", [(6, True), (-6, True), (6.001, False)])
def test_tolerance_is_inclusive(spark, minutes, hit):
    l = spark.createDataFrame([(1, 1, T0)], LEFT)
    r = spark.createDataFrame([(9, 1, T0 + timedelta(minutes=minutes))], RIGHT)
    row = asof_join(l, r, ["k"], "t", "rt", ["rid"], tolerance=timedelta(minutes=6)).first()
    assert (row.rid == 9) is hit


def test_repeated_right_time_gives_null(spark):
    l = spark.createDataFrame([(1, 1, T0)], LEFT)
    r = spark.createDataFrame([(8, 1, at(5)), (9, 1, at(5)), (7, 1, at(-30))], RIGHT)
    assert asof_join(l, r, ["k"], "t", "rt", ["rid"], tie="null").first().rid is None
    assert asof_join(l, r, ["k"], "t", "rt", ["rid"]).first().rid in (8, 9)


def test_signed_age_and_strict_limit(spark):
    l = spark.createDataFrame([(1, 1, T0), (2, 2, T0)], LEFT)
    r = spark.createDataFrame([(8, 1, T0 - timedelta(hours=72)), (9, 2, T0 - timedelta(hours=71))], RIGHT)
    got = asof_join(l, r, ["k"], "t", "rt", ["rid"], tolerance=timedelta(hours=72), closed=False, tie="null", delta_days="d")
    assert {(x.lid, x.rid, x.d and round(x.d, 6)) for x in got.collect()} == {(1, None, None), (2, 9, round(-71 / 24, 6))}


def test_slot_needs_a_next_row(spark):
    rows = spark.createDataFrame([(0, 1, at(0)), (1, 1, at(12)), (2, 1, at(60))], RIGHT)
    events = spark.createDataFrame([(i, 1, at(m)) for i, m in enumerate((-1, 0, 11, 12, 59, 60, 61))], LEFT)
    got = {r.lid: (r.slot, r.next_slot) for r in between_join(events, rows, ["k"], "t", "rt").collect()}
    assert got[0] == (None, at(0)) and got[1] == got[2] == (at(0), at(12)) and got[3] == got[4] == (at(12), at(60))
    assert got[5] == got[6] == (at(60), None)


def test_positions_neighbours_and_sums(spark):
    left, _, l, _ = tables(spark, seed=3)
    rows = [x for x in left if x[2] is not None]
    l = l.where(F.col("t").isNotNull())
    cell = timedelta(hours=3)
    order = {}
    for lid, k, t in sorted(rows, key=lambda x: (x[2], x[0])):
        order.setdefault(k, []).append(lid)
    placed = positions(l, ["k"], "t", tie=("lid",), cell=cell).collect()
    assert all(order[r.k][r.pos] == r.lid and r.n == len(order[r.k]) for r in placed)
    near = neighbours(l, ["k"], "t", ["lid"], order=("lid",), cell=cell).collect()
    for r in near:
        i = order[r.k].index(r.lid)
        assert r.prev_lid == (order[r.k][i - 1] if i else None)
        assert r.next_lid == (order[r.k][i + 1] if i + 1 < len(order[r.k]) else None)
    sums = running_sum(l, ["k"], "t", F.col("lid"), "s", tie=("lid",), total="all", cell=cell).collect()
    for r in sums:
        i = order[r.k].index(r.lid)
        assert r.s == sum(order[r.k][: i + 1]) and r["all"] == sum(order[r.k])


@pytest.mark.parametrize("tolerance", [None, timedelta(hours=1)])
@pytest.mark.parametrize("direction", ["nearest", "prev", "next"])
def test_missing_keys_match_nothing(spark, direction, tolerance):
    left = spark.createDataFrame([(1, None, at(5)), (2, 7, at(5)), (3, None, None)], LEFT)
    right = spark.createDataFrame([(10, None, at(4)), (11, 7, at(4)), (12, 7, at(6)), (13, None, at(6))], RIGHT)
    got = {r.lid: r.rid for r in asof_join(left, right, ["k"], "t", "rt", ["rid"], direction=direction, tolerance=tolerance).collect()}
    assert got == {1: None, 2: 11 if direction == "prev" else 12, 3: None}


def burst(spark, n=40_000):
    """Key 1 holds nearly all rows, 90 percent of them inside one hour, 5 percent at one instant."""
    i, spread = F.col("id"), F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1_000_000
    seconds = F.when(i % 20 == 0, F.lit(1800.0)).when(i % 20 == 1, spread * 30 * 86400).otherwise(spread * 3600)
    at = F.timestamp_micros((F.lit(1_577_836_800_000_000) + seconds * 1_000_000).cast("long")).cast("timestamp_ntz")
    return spark.range(0, n, 1, 8).select(i.alias("lid"), F.when(i % 1000 == 1, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("k"), at.alias("t"))


def test_measured_cells_divide_a_burst(spark):
    rows = burst(spark).withColumn(T, F.unix_micros(F.col("t").cast("timestamp"))).withColumn(CELL_COL, F.col(T) - F.pmod(F.col(T), F.lit(43_200_000_000)))
    cut = measured_cells(rows, ["k"], 500)
    cells = cut.groupBy("k", CELL_COL).agg(F.count("*").alias("n"), F.min(T).alias("lo"), F.max(T).alias("hi")).collect()
    assert sum(c.n for c in cells) == 40_000 and max(c.n for c in cells if c.lo < c.hi) <= 500
    for key in (1, 2):  # cells grow with time and do not overlap
        mine = sorted((c[CELL_COL], c.lo, c.hi) for c in cells if c.k == key)
        assert all(a[2] < b[1] for a, b in zip(mine, mine[1:]))
    tasks = cut.repartition(8, "k", CELL_COL).groupBy(F.spark_partition_id()).count().collect()
    sizes = sorted(r["count"] for r in tasks)
    assert len(sizes) == 8 and sizes[-1] < 2 * sizes[4]


@pytest.mark.parametrize("tolerance", [None, timedelta(minutes=2)])
def test_asof_over_a_burst_equals_plain_cells(spark, tolerance):
    left = burst(spark, 6000)
    right = left.where("lid % 3 = 0").select((F.col("lid") + 100_000).alias("rid"), "k", (F.col("t") + F.expr("interval 1 second")).alias("rt"))
    measured = asof_join(left, right, ["k"], "t", "rt", ["rid"], tolerance=tolerance, most=100)
    plain = asof_join(left, right, ["k"], "t", "rt", ["rid"], tolerance=tolerance)
    assert measured.exceptAll(plain).count() == 0 and plain.exceptAll(measured).count() == 0


def test_positions_and_sums_over_a_burst(spark):
    rows = burst(spark, 6000).unionByName(spark.createDataFrame([(i, None, at(i % 7)) for i in range(300)], LEFT))
    for make in (lambda m: positions(rows, ["k"], "t", tie=("lid",), most=m), lambda m: running_sum(rows, ["k"], "t", F.col("lid"), "s", tie=("lid",), most=m)):
        measured, plain = make(50), make(None)
        assert measured.columns == plain.columns and measured.exceptAll(plain).count() == 0 and measured.count() == 6300
