"""Overlap matching, box searches and slot statistics against plain loops."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.functions.places import ROTATION_A, ROTATION_B, ROTATION_C
from eventloom.operators import interval as I
from eventloom.operators.history import event_history
from eventloom.operators.series import slot_flux_stats, slot_stats_join

T0 = datetime(2020, 1, 1)
EVENT = "id long, start_time timestamp_ntz, end_time timestamp_ntz, goes_class string, x double, y double, ar long"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def random_events(seed, n, first):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        s = rnd.randrange(0, 6000, 10)
        e = s + rnd.choice([-20, 0, 10, 60, 600, 4000])
        lost = rnd.random() < 0.2
        out.append((first + i, at(s), at(e), rnd.choice(["C1.0", "M1.0"]), None if lost else rnd.randrange(-900, 900) * 1.0, None if lost else rnd.randrange(-900, 900) * 1.0, 11000 + i))
    return out


HITS = {
    "none": lambda l, r: r[1] < l[2] and r[2] > l[1],
    "both": lambda l, r: r[1] <= l[2] and r[2] >= l[1],
    "left": lambda l, r: r[1] <= l[2] and r[2] > l[1],
}


@pytest.mark.parametrize("closed", list(HITS))
@pytest.mark.parametrize("same_class", [True, False])
def test_candidates_equal_all_pairs(spark, closed, same_class):
    a, b = random_events(1, 60, 0), random_events(2, 60, 1000)
    got = I.overlap_candidates(spark.createDataFrame(a, EVENT), spark.createDataFrame(b, EVENT), same_class, closed)
    want = sorted((l[0], r[0]) for l in a for r in b if HITS[closed](l, r) and (not same_class or l[3] == r[3]))
    assert sorted((r.id, r.c_id) for r in got.collect()) == want


@pytest.mark.parametrize("radius", [None, 300.0])
def test_nearest_match_and_distance(spark, radius):
    a, b = random_events(3, 80, 0), random_events(4, 80, 1000)
    l, r = spark.createDataFrame(a, EVENT), spark.createDataFrame(b, EVENT)
    want = {}
    for e in a:
        hits = [x for x in b if HITS["none"](e, x) and e[3] == x[3]]
        if hits and e[4] is not None:
            best = min(hits, key=lambda x: (math.hypot(x[4] - e[4], x[5] - e[5]) if x[4] is not None else math.inf, x[1], x[0]))
            want[e[0]] = best[0]
    got = I.match_overlap_nearest(l, r, radius=radius).where("located").collect()
    assert {x.id: x.match_id for x in got} == want
    assert all((x.dist is None) == (x.match_x is None) for x in got)
    plain = I.min_distance_overlap(l, r, "d").collect()
    assert sorted(map(tuple, plain), key=str) == sorted(map(tuple, I.min_distance_overlap(l, r, "d", radius=radius).collect()), key=str)


def one_event(spark, candidates, located=False, near=50.0):
    """Resolve one event with given (source, id, x) candidates, all at y = 0."""
    def table(source):
        rows = [(1, located, abs(x) if located and x is not None else None, at(i), i, x, None if x is None else 0.0, 11000 + i) for s, i, x in candidates if s == source]
        return spark.createDataFrame(rows, "id long, located boolean, dist double, c_start_time timestamp_ntz, c_id long, c_x double, c_y double, c_ar long")

    row = I.resolve_secondary_matches(table("s"), table("h"), near).first()
    return (row.second and row.second.id, row.third and row.third.id)


@pytest.mark.parametrize("candidates, want", [
    ([("s", 1, 0.0)], (1, None)),
    ([("h", 1, 0.0), ("h", 2, 900.0)], (None, 1)),
    ([("s", 1, 0.0), ("s", 2, 49.0), ("h", 5, 48.0)], (1, 5)),
    ([("s", 1, 0.0), ("s", 2, 500.0), ("h", 5, 490.0), ("h", 6, 100.0)], (2, 5)),
    ([("s", 1, 0.0), ("s", 2, 500.0)], (1, None)),
    ([("s", 1, 0.0), ("s", 2, 1.0), ("s", 3, 2.0), ("h", 5, 2.0)], (3, 5)),
    ([("s", 1, 400.0), ("h", 5, 0.0), ("h", 6, 390.0)], (1, 6)),
    ([("s", 1, 400.0), ("h", 5, 0.0), ("h", 6, 20.0)], (1, 5)),
])
def test_secondary_resolution(spark, candidates, want):
    assert one_event(spark, candidates) == want


def test_located_event_keeps_nearest(spark):
    assert one_event(spark, [("s", 1, 300.0), ("s", 2, -10.0), ("h", 5, 7.0), ("h", 6, 6.0)], located=True) == (2, 6)


def test_verification_is_strict_and_never_null(spark):
    df = spark.createDataFrame([(274.9, None, 275.0), (None, None, None)], "a double, b double, c double")
    rows = I.verify_matches(df, "a", "b", "c").collect()
    assert tuple(rows[0])[3:] == (True, False, True, False) and tuple(rows[1])[3:] == (False,) * 4


def test_location_match_equals_search(spark):
    rnd = random.Random(7)
    rows = []
    for key in range(8):
        start = rnd.randrange(0, 4000, 12)
        for i in range(rnd.choice([1, 5, 40])):
            la, lo = rnd.randrange(-50, 40), rnd.randrange(-80, 60)
            box = (None,) * 4 if rnd.random() < 0.2 else (la, la + 25, lo, lo + 40)
            rows.append((key, at(start + 12 * i + (600 if i > 20 else 0)), *box))
    events = []
    for i in range(200):
        s = rnd.randrange(0, 5000, 3)
        events.append((i, at(s), at(s + rnd.choice([-10, 30, 900])), rnd.randrange(-50, 65), rnd.randrange(-80, 100)))
    want = set()
    for e in events:
        for key in range(8):
            mine = [r for r in rows if r[0] == key and r[2] is not None]
            if not mine or e[2] < min(r[1] for r in mine) or e[1] > max(r[1] for r in mine):
                continue
            near = min(mine, key=lambda r: (abs(r[1] - e[1]), -r[1].timestamp()))
            if near[2] <= e[3] <= near[3] and near[4] <= e[4] <= near[5]:
                want.add((e[0], key))
    s = spark.createDataFrame(rows, "k long, ts timestamp_ntz, lat_min long, lat_max long, lon_min long, lon_max long")
    ev = spark.createDataFrame(events, "id long, start_time timestamp_ntz, end_time timestamp_ntz, lat long, lon long")
    got = [(r.id, r.k) for r in I.match_by_location(ev, s, ["k"], "ts").collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


def test_first_event_in_open_window(spark):
    windows = [(i, at(s), at(e)) for i, (s, e) in enumerate([(0, 10), (10, 20), (10, 21), (5, 5), (30, 90), (100, 200)])]
    events = [(at(10), "X1.0"), (at(20), "M1.0"), (at(20), "M2.0"), (at(50), "M5.0")]
    w = spark.createDataFrame(windows, "id long, s timestamp_ntz, e timestamp_ntz")
    ev = spark.createDataFrame(events, "peak_time timestamp_ntz, goes_class string")
    got = {r.id: r.ev_goes_class for r in I.exists_in_window(w, ev, "s", "e", "peak_time", ["goes_class"]).collect()}
    assert got == {0: None, 1: None, 2: "M1.0", 3: None, 4: "M5.0", 5: None}


def test_regions_in_box_moves_regions(spark):
    series = spark.createDataFrame([(1, datetime(2020, 1, 1, 11, 48), 0.0, 10.0, 0.0, 10.0), (1, datetime(2020, 1, 1, 12, 12), 0.0, 10.0, 0.0, 10.0), (2, datetime(2020, 1, 1), None, None, None, None)],
                                   "k long, ts timestamp_ntz, lat_min double, lat_max double, lon_min double, lon_max double")
    regions = spark.createDataFrame([(11001, datetime(2020, 1, 1), 5.0, 3.0), (11002, datetime(2020, 1, 1), 12.9, -9.5), (11003, datetime(2020, 1, 2), 5.0, 19.0), (11004, datetime(2020, 1, 1), 14.0, 3.0)],
                                    "region long, ar_time timestamp_ntz, lat double, lon double")
    got = {(r.k, r.ts.hour): r.region_numbers for r in I.regions_in_box(series, regions, ["k"], "ts").collect()}
    assert got == {(1, 11): "11001;11002", (1, 12): "11003", (2, 0): ""}


def flux_case(spark, values):
    rows = [(at(m), v) for m, v in values]
    return spark.createDataFrame(rows, "ts timestamp_ntz, b_avg double")


@pytest.mark.parametrize("grid", [None, timedelta(minutes=12)])
def test_slot_statistics(spark, grid):
    slots = spark.createDataFrame([(1, at(12)), (1, at(24)), (2, at(24)), (1, at(36)), (1, at(48))], "k long, ts timestamp_ntz")
    values = [(m, 1.0 + m) for m in range(6, 18)]
    values += [(m, -99999.0) for m in range(18, 30)]
    values += [(m, -99999.0 if m % 2 else 2.0) for m in range(30, 41)]
    flux = flux_case(spark, values)
    got = {r.ts: r for r in slot_flux_stats(slots, flux, "ts", "ts", "b_avg", grid=grid).collect()}
    assert got[at(12)].xr_qual == 12 and got[at(12)].xr_max == 18.0 and got[at(12)].xr_avg == 12.5 and got[at(12)].xr_qual_str == "1" * 12
    assert got[at(24)].xr_qual == 0 and got[at(24)].xr_max == -99999.0 and got[at(24)].xr_qual_str == "0" * 12
    assert got[at(36)].xr_qual == 6 and len(got[at(36)].xr_qual_str) == 11
    joined = slot_stats_join(slots, flux, "ts", "ts", "b_avg", grid=grid).collect()
    assert len(joined) == 5 and {(r.k, r.xr_qual) for r in joined if r.ts in (at(24), at(48))} == {(1, 0), (2, 0)}


def test_event_long_after_the_start_is_found(spark):
    w = spark.createDataFrame([(1, datetime(1900, 1, 1), datetime(2012, 1, 1)), (2, None, datetime(2012, 1, 1))], "id long, s timestamp_ntz, e timestamp_ntz")
    ev = spark.createDataFrame([(datetime(2011, 1, 1), "M1.0")], "peak_time timestamp_ntz, goes_class string")
    got = {r.id: r.ev_goes_class for r in I.exists_in_window(w, ev, "s", "e", "peak_time", ["goes_class"]).collect()}
    assert got == {1: "M1.0", 2: None}


def test_regions_at_any_hour_of_a_wide_window(spark):
    t = datetime(2020, 1, 3, 12)
    series = spark.createDataFrame([(1, t, -90.0, 90.0, -180.0, 180.0)], "k long, ts timestamp_ntz, lat_min double, lat_max double, lon_min double, lon_max double")
    hours = [-37, -36, -30, -6, 0, 6, 35, 36]
    regions = spark.createDataFrame([(11000 + i, t + timedelta(hours=h), 5.0, 3.0) for i, h in enumerate(hours)], "region long, ar_time timestamp_ntz, lat double, lon double")
    for window, want in ((36, [1, 2, 3, 4, 5, 6]), (12, [3, 4, 5])):
        got = I.regions_in_box(series, regions, ["k"], "ts", window=timedelta(hours=window)).first().region_numbers
        assert got == ";".join(str(11000 + i) for i in want)


def test_nan_coordinates_count_as_missing(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, float("nan"), 2.0), (3, None, 2.0)], "id long, x double, y double")
    assert [r.id for r in df.where(I.placed("x", "y")).collect()] == [1]


def test_long_intervals_are_listed_in_few_cells(spark):
    rnd = random.Random(5)

    def spans(first, n):
        out = []
        for i in range(n):
            s = rnd.randrange(0, 4_000_000)
            out.append((first + i, at(s), at(s + rnd.choice([0, 5, 700, 1440, 1441, 20_000, 600_000, 5_000_000])), "C", None, None, 0))
        return out

    a, b = spans(0, 150), spans(1000, 150)
    l, r = spark.createDataFrame(a, EVENT), spark.createDataFrame(b, EVENT)
    got = I.overlap_candidates(l, r).collect()
    assert sorted((x.id, x.c_id) for x in got) == sorted((x[0], y[0]) for x in a for y in b if HITS["none"](x, y))
    span = ("start_time", "end_time")
    rows = I.listed(l, span, I.TIME_CELL, I._levels_of(r, span, I.TIME_CELL), True, "__l").groupBy("id").count().collect()
    days = {x[0]: (x[2] - x[1]) / timedelta(days=1) for x in a}
    longest = max((x[2] - x[1]) / timedelta(days=1) for x in a + b)
    assert max(x["count"] for x in rows) <= 2 * math.log2(longest) + 4 and max(days.values()) > 3000


@pytest.mark.parametrize("radius", [None, 50.0])
def test_nan_and_missing_positions_are_alike(spark, radius):
    nan = float("nan")
    left = [(1, at(0), at(60), "C1.0", nan, 1.0, 0), (2, at(0), at(60), "C1.0", None, None, 0), (3, at(0), at(60), "C1.0", 5.0, 5.0, 0), (4, at(0), at(60), "M1.0", 5.0, 5.0, 0)]
    right = [(10, at(10), at(20), "C1.0", nan, 5.0, 0), (11, at(11), at(20), "C1.0", 905.0, 5.0, 0), (12, at(12), at(20), "M1.0", 1.0, nan, 0), (13, at(13), at(20), "M1.0", None, 2.0, 0)]
    l, r = spark.createDataFrame(left, EVENT), spark.createDataFrame(right, EVENT)
    got = sorted((x.id, x.located, x.match_id, x.dist) for x in I.match_overlap_nearest(l, r, radius=radius).collect())
    assert got == [(1, False, 10, None), (1, False, 11, None), (2, False, 10, None), (2, False, 11, None), (3, True, 11, 900.0), (4, True, 12, None)]
    least = {x.id: x.d for x in I.min_distance_overlap(l, r, "d", radius=radius).collect()}
    assert least == {1: None, 2: None, 3: 900.0, 4: None}


def test_ring_search_makes_few_candidates_in_a_crowded_day(spark, monkeypatch):
    rnd = random.Random(6)
    left, right = ([(first + i, at(rnd.randrange(0, 60)), at(rnd.randrange(700, 1400)), "C1.0", rnd.uniform(-900, 900), rnd.uniform(-900, 900), 0) for i in range(5000)] for first in (0, 10_000))
    left[0] = (*left[0][:4], 20_000.0, 0.0, 0)  # far from everything
    made, search = [], I.overlap_candidates

    def counted(*args, **kwargs):
        out = search(*args, **kwargs)
        made.append(out.count())
        return out

    monkeypatch.setattr(I, "overlap_candidates", counted)
    got = {x.id: (x.match_id, x.dist) for x in I.match_overlap_nearest(spark.createDataFrame(left, EVENT), spark.createDataFrame(right, EVENT), radius=25.0).collect()}
    assert sum(made) < 40 * 5000
    px, py = (np.array([e[k] for e in right]) for k in (4, 5))
    for e in left[:300]:
        gap = np.hypot(px - e[4], py - e[5])
        assert abs(gap.min() - got[e[0]][1]) < 1e-9 and got[e[0]][0] == right[int(gap.argmin())][0]


CANDIDATES = "id long, located boolean, dist double, c_start_time timestamp_ntz, c_id long, c_x double, c_y double, c_ar long"


def plain_pair(a, b):
    """Smallest (d2, a, b) over all pairs of the candidates of one event."""
    def missing(v):
        return v is None or v != v

    def d2(p, q):
        return float("inf") if any(missing(v) for v in (*p[5:7], *q[5:7])) else (p[5] - q[5]) ** 2 + (p[6] - q[6]) ** 2

    return min((d2(p, q), p[3], p[4], q[3], q[4]) for p in a for q in b)


def test_closest_pairs_equal_all_pairs_and_stay_few(spark, monkeypatch):
    rnd = random.Random(7)

    def side(first, event, n, far=0.0, lost=0.1, grain=None):
        def place():
            v = rnd.uniform(-900, 900) if grain is None else rnd.randrange(grain) * 10.0
            return None if rnd.random() < lost else v

        return [(event, False, None, at(rnd.randrange(600)), first + i, None if (x := place()) is None else x + far, place(), 0) for i in range(n)]

    a = side(0, 1, 40) + side(100, 2, 30, grain=4) + side(200, 3, 5, lost=1.0) + side(300, 4, 20) + side(400, 5, 3, grain=1, lost=0) + side(500, 7, 3)
    b = side(1000, 1, 25) + side(1100, 2, 30, grain=4) + side(1200, 3, 7) + side(1300, 4, 20, far=50_000.0) + side(1400, 5, 3, grain=1, lost=0) + side(1500, 8, 3)
    got = {x.id: (x.d2, x.a.start_time, x.a.id, x.b.start_time, x.b.id) for x in I.closest_pair(spark.createDataFrame(a, CANDIDATES), spark.createDataFrame(b, CANDIDATES)).collect()}
    assert got == {e: plain_pair([x for x in a if x[0] == e], [x for x in b if x[0] == e]) for e in (1, 2, 3, 4, 5)}
    made, join = [], I.cell_pairs

    def counted(*args):
        out = join(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(I, "cell_pairs", counted)
    a, b = side(0, 1, 10_000, lost=0), side(50_000, 1, 10_000, lost=0)
    one = I.closest_pair(spark.createDataFrame(a, CANDIDATES), spark.createDataFrame(b, CANDIDATES)).first()
    assert sum(made) < 50 * 20_000
    px, py, qx, qy = (np.array([e[k] for e in s]) for s in (a, b) for k in (5, 6))
    assert one.d2 == min(((px - x) ** 2 + (py - y) ** 2).min() for x, y in zip(qx, qy))


def boxes_and_regions(spark, boxes, regions):
    s = spark.createDataFrame(boxes, "k long, ts timestamp_ntz, lat_min double, lat_max double, lon_min double, lon_max double")
    return s, spark.createDataFrame(regions, "region long, ar_time timestamp_ntz, lat double, lon double")


def moved(lon, lat, days):
    s2 = math.sin(math.radians(lat)) ** 2
    return lon + (ROTATION_A + ROTATION_B * s2 + ROTATION_C * s2 * s2) * days


def test_boxes_across_the_border(spark):
    rnd, w = random.Random(11), timedelta(hours=12)
    boxes, regions = [], []
    for k in range(150):
        la, lo, high, wide = rnd.uniform(-60, 40), rnd.uniform(-180, 180), rnd.choice([0.0, 5.0, 30.0]), rnd.choice([0.0, 8.0, 50.0, 200.0, 350.0])
        boxes.append((k, at(rnd.randrange(0, 3000)), la, la + high, lo, lo + wide - (360 if lo + wide > 180 else 0)))
    boxes += [(900, at(50), None, 1.0, 0.0, 1.0), (901, at(50), 0.0, float("nan"), 0.0, 1.0), (902, at(50), 50.0, -50.0, 0.0, 90.0), (903, None, 0.0, 1.0, 0.0, 1.0)]
    for i in range(600):
        regions.append((11000 + i, at(rnd.randrange(0, 3000)), rnd.uniform(-65, 75), rnd.uniform(-180, 180)))
    regions += [(12000, at(100), float("nan"), 0.0), (12001, at(100), 0.0, None), (12002, None, 0.0, 0.0)]
    s, r = boxes_and_regions(spark, boxes, regions)
    for wrap in (False, True):
        got = {x.k: x.region_numbers for x in I.regions_in_box(s, r, ["k"], "ts", window=w, slack=1.0, wrap=wrap).collect()}
        hits = 0
        for k, t, south, north, west, east in boxes[:150]:
            east += 360 if wrap and east < west else 0
            want = []
            for n, t0, la, lo in regions[:600]:
                if t - w <= t0 < t + w and south - 1 <= la <= north + 1:
                    lo = moved(lo, la, (t - t0) / timedelta(days=1))
                    if any(west - 1 <= lo + 360 * j <= east + 1 for j in ((-2, -1, 0, 1, 2) if wrap else (0,))):
                        want.append(n)
            hits += len(want)
            assert got[k] == ";".join(map(str, want)), (k, wrap)
        assert hits > 300 and all(got[k] == "" for k in (900, 901, 902, 903))


def test_a_crowded_cell_meets_few_regions_in_vain(spark):
    rnd = random.Random(12)
    boxes, regions = [], []
    for k in range(3000):
        la, lo, high, wide = rnd.uniform(0, 15), rnd.uniform(0, 15), rnd.uniform(2, 12), rnd.uniform(4, 25)
        boxes.append((k, at(rnd.randrange(600, 900)), la, la + high, lo, lo + wide))
    for i in range(300):
        regions.append((11000 + i, at(rnd.randrange(0, 1500)), rnd.uniform(-5, 30), rnd.uniform(-5, 40)))
    s, r = boxes_and_regions(spark, boxes, regions)
    window, slack = timedelta(hours=12), 3.0
    met = I.region_candidates(s, r, ["k"], "ts", window, slack).count()
    got = I.regions_in_box(s, r, ["k"], "ts", window, slack).collect()
    hits = sum(len(x.region_numbers.split(";")) for x in got if x.region_numbers)
    assert hits > 10_000 and met < 4 * hits


def test_region_lists_are_whole_where_they_are_found(spark):
    """Neither pairs nor lists are shuffled or sorted: nothing but one aggregate in order follows the join with the regions."""
    s, r = boxes_and_regions(spark, [(1, at(0), 0.0, 9.0, 0.0, 9.0), (2, at(60), 0.0, 9.0, 0.0, 9.0)], [(11000, at(30), 1.0, 1.0), (11001, at(-5000), 1.0, 1.0)])
    out = I.regions_in_box(s, r, ["k"], "ts")
    plan = out._jdf.queryExecution().executedPlan().toString()
    after = plan[: plan.index("ShuffledHashJoin")]
    assert "Exchange" not in after and "Sort [" not in after and after.count("Aggregate") == 1 and "SortAggregate" in after
    assert sorted((x.k, x.region_numbers) for x in out.collect()) == [(1, "11000"), (2, "11000")]


@pytest.mark.parametrize("slots", [16_000, 2])
def test_region_lists_of_repeated_rows(spark, monkeypatch, slots):
    """Rows of one series and time share the regions of all their boxes; rows without a time, a box or a key stay."""
    monkeypatch.setattr(I, "SLOTS_OF_A_PART", slots)
    rnd = random.Random(15)
    boxes = []
    for k in range(60):
        t = at(rnd.randrange(0, 900))
        for _ in range(rnd.choice([1, 1, 3])):
            la, lo = rnd.uniform(-50, 30), rnd.uniform(-60, 30)
            boxes.append((k, t, *((None,) * 4 if rnd.random() < 0.2 else (la, la + rnd.choice([-5.0, 8.0, 30.0]), lo, lo + 40.0))))
    boxes += [(None, at(5), -50.0, 50.0, -50.0, 50.0), (70, None, -50.0, 50.0, -50.0, 50.0)]
    regions = [(11000 + i // 2, at(rnd.randrange(0, 1500)), rnd.uniform(-50, 60), rnd.uniform(-60, 70)) for i in range(200)]
    s, r = boxes_and_regions(spark, boxes, regions)
    s = s.withColumn("other", F.monotonically_increasing_id())
    got, w, hits = I.regions_in_box(s, r, ["k"], "ts", slack=0.0, keyed=s.where("k < 50").select("k")).collect(), timedelta(hours=12), 0
    assert len(got) == len({x.other for x in got}) == len(boxes)
    for x in got:
        want = []
        for k, t, south, north, west, east in boxes:
            if x.k is not None and x.k < 50 and (k, t) == (x.k, x.ts) and south is not None:
                want += [n for n, t0, la, lo in regions if t - w <= t0 < t + w and south <= la <= north and west <= moved(lo, la, (t - t0) / timedelta(days=1)) <= east]
        hits += len(want)
        assert x.region_numbers == ";".join(map(str, sorted(want)))
    assert hits > 100


def test_location_match_across_the_border(spark):
    rnd = random.Random(13)
    rows = [(k, at(60 * i), la, la + 10.0, lo, lo + 30.0 - (360 if lo + 30 > 180 else 0)) for k in range(12) for la, lo in [(rnd.uniform(-40, 30), rnd.uniform(-180, 180))] for i in range(5)]
    events = [(i, at(s), at(s + 90), rnd.uniform(-40, 40), rnd.uniform(-180, 180)) for i in range(400) for s in [rnd.randrange(-80, 330)]]
    want = set()
    for e in events:
        for k in range(12):
            mine = [r for r in rows if r[0] == k]
            if e[2] < mine[0][1] or e[1] > mine[-1][1]:
                continue
            n = min(mine, key=lambda r: (abs(r[1] - e[1]), -r[1].timestamp()))
            if n[2] <= e[3] <= n[3] and n[4] <= e[4] + (360 if e[4] < n[4] else 0) <= n[5] + (360 if n[5] < n[4] else 0):
                want.add((e[0], k))
    s = spark.createDataFrame(rows, "k long, ts timestamp_ntz, lat_min double, lat_max double, lon_min double, lon_max double")
    ev = spark.createDataFrame(events, "id long, start_time timestamp_ntz, end_time timestamp_ntz, lat double, lon double")
    got = [(r.id, r.k) for r in I.match_by_location(ev, s, ["k"], "ts", wrap=True).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20


def test_location_pairs_are_final_where_they_are_found(spark):
    """No join and no exchange follows the joins on the cells: the pairs are many more than events and rows."""
    events = spark.range(50).select("id", *[F.timestamp_millis(F.col("id") * 60_000 + d).cast("timestamp_ntz").alias(c) for c, d in (("start_time", 0), ("end_time", 90_000))], F.col("id").alias("lat"), F.col("id").alias("lon"))
    rows = spark.range(400).select((F.col("id") % 20).alias("k"), F.timestamp_millis(F.col("id") * 10_000).cast("timestamp_ntz").alias("ts"), *[F.lit(v).alias(c) for c, v in (("lat_min", 0), ("lat_max", 30), ("lon_min", 0), ("lon_max", 30))])
    pairs = I.match_by_location(events, rows, ["k"], "ts")
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan[: plan.index("Union")] and "Exchange" not in plan[: plan.index("Union")]
    assert pairs.count() == 31 * 20 - 14  # the first two events end before 10 and 4 of the series begin
    near_series = pairs.join(spark.createDataFrame([(3,)], "k long"), "k", "left_anti").select("id").distinct()
    plan = near_series._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan[: plan.index("Union")]  # series are dropped before they meet events


LISTED_EVENT = "id long, goes_class string, start_time timestamp_ntz, peak_time timestamp_ntz, end_time timestamp_ntz, noaa_active_region long, hinode_ar long, ssw_ar long, fl_lat double, fl_lon double, primary_verified boolean, secondary_verified boolean"
LISTED_ROW = "k long, ts timestamp_ntz, lat_min double, lat_max double, lon_min double, lon_max double, hid long"


@pytest.mark.parametrize("slots,pack", [(16_000, (32, 4096)), (3, (1, 2))])
def test_location_history_equals_search(spark, monkeypatch, slots, pack):
    """Slots of all lengths, lags of both signs, rows without box, key or time, repeated rows; many parts and arrays with the small limits."""
    monkeypatch.setattr(I, "SLOTS_OF_A_PART", slots)
    monkeypatch.setattr(I, "EVENTS_OF_A_PACK", pack)
    rnd = random.Random(29)
    rows = [(None, at(5), 0.0, 10.0, 0.0, 10.0, 9000), (3, None, 0.0, 10.0, 0.0, 10.0, 9001)]
    for k in range(9):
        t = rnd.randrange(-3000, 3000)
        for i in range(rnd.choice([1, 2, 12, 40])):
            la, lo = rnd.uniform(-40, 20), rnd.uniform(-80, 40)
            box = (None,) * 4 if rnd.random() < 0.15 else (la, la + rnd.choice([15.0, 60.0]), lo, lo + rnd.choice([20.0, 110.0]))
            rows += [(k, at(t), *box, 1000 * k + i)] * (2 if rnd.random() < 0.1 else 1)
            t += rnd.choice([1, 12, 400, 3000, 20_000])
    events = []
    for i in range(900):
        s = rnd.randrange(-6000, 40_000) if i % 3 else rnd.randrange(-3500, 3500)
        here = (None, None) if i % 17 == 0 else (rnd.uniform(-40, 50), rnd.uniform(-80, 90))
        sources = [rnd.choice([None, 100, 200, 300]) for _ in range(3)]
        peak = None if i % 41 == 0 else at(s + rnd.choice([-30, 0, 5, 700]))
        events.append((i, rnd.choice("ABCMX") + "1.0", at(s), peak, at(s + rnd.choice([-40, 20, 5000])), *sources, *here, i % 2 == 0, i % 3 == 0))
    keys = {k: [100, 200] if k % 2 else [300] for k in range(7)}
    want, hits = {}, 0
    for k in range(9):
        times = sorted({r[1] for r in rows if r[0] == k and r[1]})
        mine = [r for r in rows if r[0] == k and r[1] and r[2] is not None]
        slot_of = {t: [] for t in times}
        for e in events if mine else ():
            if e[8] is None or e[3] is None or e[4] < min(r[1] for r in mine) or e[2] > max(r[1] for r in mine):
                continue
            n = min(mine, key=lambda r: (abs(r[1] - e[2]), -r[1].timestamp()))
            held = [t for t in times if t <= e[3]]
            if n[2] <= e[8] <= n[3] and n[4] <= e[9] <= n[5] and held and e[3] < times[-1]:
                number, source = next(((x, y) for x, y in zip(e[5:8], ("GOES", "XRT", "SSW")) if x is not None), (None, None))
                number, source = (number, f'"{source}"') if number in keys.get(k, []) else (-1, "null")
                tag = "Primary" if e[10] else "Secondary" if e[11] else "Non-verified"
                slot_of[held[-1]].append((e[1][0], f'{{"magnitude": "{e[1]}", "id": {e[0]}, "NOAA_AR": {number}, "narn_source": {source}, "verification": "{tag}"}}'))
                hits += 1
        want |= {(k, t): found for t, found in slot_of.items()}
    series = spark.createDataFrame(rows, LISTED_ROW)
    ev = spark.createDataFrame(events, LISTED_EVENT)
    key_map = spark.createDataFrame(list(keys.items()), "k long, keys array<long>")
    got = event_history(series, ev, key_map, "k", "ts", mode="location").collect()
    assert sorted(r.hid for r in got) == sorted(r[6] for r in rows) and hits > 100
    for r in got:
        for c in "BCMX":
            labels = [x for letter, x in want.get((r.k, r.ts), []) if letter == c]
            assert r[f"{c}FLARE_LOC"] == len(labels) and r[f"{c}FLARE_LABEL_LOC"] == (";".join(labels) or "None")


def test_location_lists_are_whole_where_they_are_found(spark):
    """Neither pairs nor lists nor labels are shuffled or sorted: nothing but one aggregate in order follows the join with the events."""
    series, ev = spark.createDataFrame([(1, at(0), 0.0, 9.0, 0.0, 9.0, 1), (1, at(60), 0.0, 9.0, 0.0, 9.0, 2)], LISTED_ROW), spark.createDataFrame(
        [(7, "M1.0", at(1), at(2), at(3), None, None, None, 1.0, 1.0, True, True)], LISTED_EVENT)
    out = event_history(series, ev, spark.createDataFrame([(1, [5])], "k long, keys array<long>"), "k", "ts", mode="location")
    plan = out._jdf.queryExecution().executedPlan().toString()
    after = plan[: plan.index("ShuffledHashJoin")]
    assert "Exchange" not in after and "Sort [" not in after and after.count("Aggregate") == 1 and "SortAggregate" in after
    assert sorted((r.hid, r.MFLARE_LOC) for r in out.collect()) == [(1, 1), (2, 0)]


def test_slots_meet_only_the_events_of_their_cells(spark):
    """Events of a part are looked up by place and time, and lists and labels are not made element by element; every slot of the part went through all its events."""
    rows = [(k, at(60 * i), float(10 * k), 10.0 * k + 9, 0.0, 9.0, 10 * k + i) for k in range(3) for i in range(3)]
    events = [(i, "M1.0", at(i), at(i + 1), at(i + 2), 5, None, None, float(i % 40), 1.0, i % 2 == 0, False) for i in range(120)]
    series, ev = spark.createDataFrame(rows, LISTED_ROW), spark.createDataFrame(events, LISTED_EVENT)
    key_map = spark.createDataFrame([(0, [5]), (0, [6]), (1, [6])], "k long, keys array<long>")  # the first series has two entries
    out = event_history(series, ev, key_map, "k", "ts", mode="location", best=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    join = next(line for line in plan.splitlines() if "ShuffledHashJoin" in line)
    keys = join[join.index("["): join.index("]")]
    assert all(c in keys for c in ("__part", "__la#", "__lo#", "__stretch")) and "lambdafunction" not in plan[plan.index("SortAggregate") : plan.index("ShuffledHashJoin")]
    for r in out.collect():
        mine = [e for e in events if 10 * r.k <= e[8] <= 10 * r.k + 9 and r.ts <= e[3] < r.ts + timedelta(minutes=60) and r.ts < at(120)]
        numbers = {0: [5, -1], 1: [-1], 2: [-1]}[r.k]
        assert r.MFLARE_LOC == len(mine) * len(numbers)
        for n in numbers:
            assert r.MFLARE_LABEL_LOC.count(f'"NOAA_AR": {n},') == len(mine)
        assert r.MFLARE_BEST_LOC == (f"M1.0@{mine[0][0]}:{'Primary' if mine[0][10] else 'Non-verified'}" if mine else "None")


def overlapping_pairs(a, b, c, closed="none"):
    """Per event its closest pair, as (d2, start, id, start, id), by a plain loop."""
    out = {}
    for e in a:
        sides = [[(e[0], False, None, x[1], x[0], x[4], x[5], x[6]) for x in side if HITS[closed](e, x) and e[3] == x[3]] for side in (b, c)]
        if all(sides):
            out[e[0]] = plain_pair(*sides)
    return out


@pytest.mark.parametrize("closed, grain, wanted, rounds", [("none", 1.0, 8.0, 2), ("left", 300.0, 8.0, 1), ("both", 1.0, 0.05, 1), ("none", 10.0, 0.5, 2)])
def test_closest_pairs_without_all_candidates_equal_all_pairs(spark, monkeypatch, closed, grain, wanted, rounds):
    monkeypatch.setattr(I, "PAIRS_WANTED", wanted)
    a, b, c = ([(*x[:4], *(None if v is None else v // grain * grain for v in x[4:6]), x[6]) for x in random_events(s, 200, f)] for s, f in ((21, 0), (22, 1000), (23, 2000)))
    got = I.closest_overlapping_pair(*[spark.createDataFrame(x, EVENT) for x in (a, b, c)], closed=closed, rounds=rounds).collect()
    want = overlapping_pairs(a, b, c, closed)
    assert {x.id: (x.d2, x.a.start_time, x.a.id, x.b.start_time, x.b.id) for x in got} == want and len(got) == len(want) > 100


def test_dense_events_leave_few_candidates_for_closest_pair(spark, monkeypatch):
    rnd = random.Random(24)

    def dense(first):
        return [(first + i, at(s := rnd.randrange(0, 1400)), at(s + rnd.randrange(20, 80)), "C1.0", rnd.uniform(-900, 900), rnd.uniform(-900, 900), 0) for i in range(1500)]

    left, second, third = (spark.createDataFrame(dense(f), EVENT) for f in (0, 10_000, 20_000))
    all_candidates = I.overlap_candidates(left, second).count()
    listed, search = [], I.overlap_candidates

    def counted(*args, **kw):
        out = search(*args, **kw)
        listed.append(out.count())
        return out

    monkeypatch.setattr(I, "overlap_candidates", counted)
    assert I.closest_overlapping_pair(left, second, third).count() == 1500
    assert all_candidates > 100_000 and sum(listed) < all_candidates / 20


def test_resolution_of_sources_equals_resolution_of_candidates(spark):
    base, second, third = (spark.createDataFrame(random_events(s, 150, f), EVENT) for s, f in ((31, 0), (32, 1000), (33, 2000)))
    base = base.unionByName(base.limit(60).select(F.col("id") + 500, *[F.col(c) for c in EVENT_COLS[1:4]], F.lit(None).cast("double"), F.lit(None).cast("double"), "ar").toDF(*EVENT_COLS))
    near = 400.0
    want = I.resolve_secondary_matches(I.overlap_candidates(base, second), I.overlap_candidates(base, third), near)
    got = I.resolve_secondary_matches(second, third, near, base, 275.0)
    rows = [{r.id: (r.second, r.second_dist, r.third, r.third_dist) for r in x.collect()} for x in (want, got)]
    assert rows[0] == rows[1] and len(rows[0]) > 100


EVENT_COLS = ["id", "start_time", "end_time", "goes_class", "x", "y", "ar"]
