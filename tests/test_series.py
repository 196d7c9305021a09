"""Grid, smoothing and quality operators."""

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventloom.operators import events as E
from eventloom.operators import series as S
from eventloom.operators.labels import explode_observations

T0 = datetime(2020, 1, 1)
SCHEMA = "k long, ts timestamp_ntz, v double"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def test_regrid_and_rejects(spark):
    rows = [(1, at(0), 1.0), (1, at(12), 2.0), (1, at(48), 3.0)]
    rows += [(2, at(0), 1.0), (2, at(30), 2.0)]
    rows += [(3, at(7), 5.0)]
    rows += [(4, at(0), 1.0), (4, at(0), 9.0), (4, at(12), 2.0)]
    rows += [(5, at(0), 1.0), (5, at(13), 7.0), (5, at(24), 2.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = S.regrid(df, ["k"], "ts", placed=True).collect()
    assert {r.k for r in out} == {1, 3, 5}
    one = {r.ts: (r.v, r.pos, r.n) for r in out if r.k == 1}
    assert one == {at(0): (1.0, 0, 5), at(12): (2.0, 1, 5), at(24): (None, 2, 5), at(36): (None, 3, 5), at(48): (3.0, 4, 5)}
    assert {r.ts: r.v for r in out if r.k == 5} == {at(0): 1.0, at(12): None, at(24): 2.0}
    assert {r.k for r in S.regrid_rejects(df, ["k"], "ts").collect()} == {2, 4}


def gappy(n=150, seed=5):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=n)
    v[rng.random(n) < 0.5] = np.nan
    v[:7] = np.nan
    v[-4:] = np.nan
    return v


def test_interpolation_equals_pandas(spark):
    data = {1: gappy(), 2: np.full(10, np.nan), 3: gappy(40, 6)}
    rows = [(k, at(12 * i), None if np.isnan(x) else float(x)) for k, v in data.items() for i, x in enumerate(v)]
    out = S.interpolate_linear(spark.createDataFrame(rows, SCHEMA), ["k"], "ts", ["v"], cell=timedelta(hours=2)).toPandas()
    assert set(out.columns) == {"k", "ts", "v"}
    for k, v in data.items():
        want = pd.Series(v).interpolate(method="linear").ffill().bfill()
        got = out[out.k == k].sort_values("ts").v.astype(float)
        np.testing.assert_allclose(got, want, equal_nan=True)


def test_scale_and_rolling_equal_pandas(spark):
    v = np.nan_to_num(gappy(), nan=1.0)
    rows = [(1, at(12 * i), float(x)) for i, x in enumerate(v)] + [(2, at(12 * i), 4.0) for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    scaled = S.scale(df, ["k"], "ts", ["v"], cell=timedelta(hours=2)).toPandas().sort_values(["k", "ts"])
    np.testing.assert_allclose(scaled[scaled.k == 1].v, (v - v.min()) / (v.max() - v.min()))
    assert (scaled[scaled.k == 2].v == 0).all()
    rolled = S.rolling_mean(df, ["k"], "ts", ["v"], 11).toPandas().sort_values(["k", "ts"])
    np.testing.assert_allclose(rolled[rolled.k == 1].v_mean.astype(float), pd.Series(v).rolling(11).mean(), equal_nan=True)
    assert rolled[rolled.k == 2].v_mean.isna().all()


@pytest.mark.parametrize("given", [True, False])
def test_smoothing_places_rows_once(spark, monkeypatch, given):
    """Positions are a scan of the whole series: none when they are given, one when they are not."""
    from eventloom.plans.smooth import smooth_series

    data = {1: gappy(150), 2: gappy(60, 6), 3: gappy(20, 7), 4: gappy(21, 8)}
    rows = [(k, at(12 * i), None if np.isnan(x) else float(x), i, len(v)) for k, v in data.items() for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, SCHEMA + ", pos long, n long")
    calls, positions = [], S.positions
    monkeypatch.setattr(S, "positions", lambda *a, **b: calls.append(1) or positions(*a, **b))
    out = smooth_series(df if given else df.drop("pos", "n"), ["k"], "ts", ["v"], edge=10, window=5, lead=7)
    assert out.columns == ["k", "ts", "v"]
    got = {(r.k, r.ts): r.v for r in out.collect()}
    assert len(calls) == (0 if given else 1)
    want = {}
    for k, v in data.items():
        cut = pd.Series(v).interpolate(method="linear").ffill().bfill()[10 : len(v) - 10]
        means = ((cut - cut.min()) / ((cut.max() - cut.min()) or 1.0)).rolling(5).mean()
        want |= {(k, at(12 * i)): x for i, x in list(means.items())[7:]}
    assert got.keys() == want.keys()
    np.testing.assert_allclose([got[i] for i in want], list(want.values()))


def test_chunks_give_whole_frames(spark):
    rows = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("pos"), F.lit(1000).alias("n"))
    from pyspark.sql import Window

    w = Window.partitionBy("k", "__chunk").orderBy("pos").rowsBetween(-5, 3)
    got = S.chunked(rows, 5, 3, rows=64).withColumn("c", F.count("pos").over(w)).where("__home").collect()
    assert len(got) == 1000 and all(r.c == min(r.pos, 5) + 1 + min(999 - r.pos, 3) for r in got)


def test_step_and_availability(spark):
    df = spark.createDataFrame([(1, at(m), 0.0) for m in (0, 12, 24, 60)] + [(2, at(5), 0.0)], SCHEMA)
    ratio = {r.k: r.irregular_ratio for r in S.irregular_step_ratio(df, ["k"], "ts").collect()}
    assert ratio == {1: 0.5, 2: 1.0}
    have = {r.k: (round(r.availability, 4), r.flagged) for r in S.availability_ratio(df, ["k"], "ts").collect()}
    assert have == {1: (round(4 / 6, 4), False), 2: (1.0, False)}


@pytest.mark.parametrize("chunk", [1, 7, 50, 20_000])
def test_grid_chunks_make_one_grid(spark, monkeypatch, chunk):
    monkeypatch.setattr(S, "GRID_CHUNK", chunk)
    start, step = datetime(2020, 1, 1), timedelta(minutes=12)
    rows = [(k, start + step * i, float(i)) for k, n in ((1, 50), (2, 1), (3, 8)) for i in range(n) if i % 3 == 0 or i == n - 1]
    got = S.regrid(spark.createDataFrame(rows, "k long, ts timestamp_ntz, v double"), ["k"], "ts", placed=True).collect()
    want = {(k, start + step * i, i, n) for k, n in ((1, 50), (2, 1), (3, 8)) for i in range(n)}
    assert {(r.k, r.ts, r.pos, r.n) for r in got} == want and len(got) == len(want)
    assert {(r.k, r.ts, r.v) for r in got if r.v is not None} == set(rows)


def test_rejected_series_are_reported(spark):
    from eventloom.plans.annotate import annotation_rejects

    start, step = datetime(2020, 1, 1), timedelta(minutes=12)
    rows = [(1, start), (1, start + step), (2, start), (2, start + step / 2), (3, start), (3, start)]
    series = spark.createDataFrame(rows, "k long, ts timestamp_ntz")
    header = series.where("k <> 1").unionByName(spark.createDataFrame([(1, start)], "k long, ts timestamp_ntz"))
    got = {(r.k, r.reason) for r in annotation_rejects(series, header, ["k"], "ts").collect()}
    assert got == {(2, "grid"), (3, "grid"), (1, "header length")}


def test_maxima_of_many_intervals(spark):
    rnd = random.Random(11)
    rows = [(k, T0 + timedelta(minutes=rnd.randrange(60_000)), rnd.choice([None, float("nan"), rnd.random() * 10.0 ** rnd.randrange(-9, -2)])) for k in (1, 2, None) for _ in range(400)]
    ask = []
    for i in range(3000):
        s = T0 + timedelta(minutes=rnd.randrange(-2000, 62_000))
        ask.append((i, rnd.choice([1, 1, 2, 3, None]), rnd.choice([s, s, s, None]), s + timedelta(minutes=rnd.choice([-5, 0, 30, 400, 721, 3000, 40_000]))))
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz, v double")
    got = {r.id: (r.max_flux, r.max_class) for r in S.max_in_intervals(df, spark.createDataFrame(ask, "id long, k long, a timestamp_ntz, b timestamp_ntz"), ["k"], "t", "v", ("a", "b")).collect()}
    for i, k, a, b in ask:
        found = [v for own, t, v in rows if k is not None and a is not None and own == k and a <= t <= b and v is not None and v == v]
        want = max(found, default=None)
        assert got[i][0] == want
        if want is None:
            assert got[i][1] is None
        elif want >= 1e-8:
            scale = max(x for x in (1e-8, 1e-7, 1e-6, 1e-5, 1e-4) if x <= want)
            assert got[i][1][0] == "ABCMX"[[1e-8, 1e-7, 1e-6, 1e-5, 1e-4].index(scale)] and abs(float(got[i][1][1:]) - want / scale) <= 0.0501


def test_union_counts_its_rows(spark):
    a, b = spark.range(5).withColumn("x", F.lit(1)), spark.range(3)
    rows, counts = E.union_checked([a, b, a.limit(0)], "union")
    assert counts == [5, 3, 0] and rows.count() == 8 and rows.filter("x is null").count() == 3
    with pytest.raises(ValueError):
        E.union_checked([a, b], "union", expected=[5, 4])


def test_grid_points_are_not_broadcast(spark):
    """Two rows far apart make many points; joins on the grid take them for as small as the two rows."""
    rows = spark.createDataFrame([(k, datetime(2020, 1, 1) + timedelta(hours=h), 1) for k in range(4) for h in (0, 50_000)], "user_id long, ts timestamp_ntz, p_n int")
    hourly = rows.groupBy("user_id", "ts").agg(F.sum("p_n").alias("p_n"))
    grid = S.regrid(hourly, ["user_id"], "ts", timedelta(hours=1), placed=True)
    active = S.active_slots(grid.select("user_id", "ts", F.coalesce("p_n", F.lit(0)).alias("p_n")), "p_n")
    instances = grid.where(F.col("pos") < 3).select("user_id", F.col("pos").alias("slice_pos"))
    exploded = explode_observations(instances, grid.select("user_id", "ts", "pos", "n"), ["user_id"], "ts", 12)
    for df, n in ((active, 8), (exploded, 4 * 3 * 12)):
        assert len(df.collect()) == n
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
