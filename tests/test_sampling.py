"""Partitions and samples: plain scans and counting rules."""

import math
import random
import time
import tracemalloc
from collections import Counter
from datetime import datetime, timedelta
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.operators import events as E
from eventloom.operators import partition as P
from eventloom.operators import sampling as R

T0 = datetime(2020, 1, 1)
COUNTS = "harpnum long, BFLARE long, CFLARE long, MFLARE long, XFLARE long, st timestamp_ntz, et timestamp_ntz"


def series_counts(seed, n, rate):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        s = rnd.randrange(0, 100_000)
        rows.append((i, 1, 1, rnd.randrange(4) if rnd.random() < rate else 0, int(rnd.random() < 0.1), T0 + timedelta(minutes=s), T0 + timedelta(minutes=s + rnd.randrange(1, 9000))))
    return rows


@pytest.mark.parametrize("k, rate", [(5, 0.6), (3, 0.2)])
def test_partitions_equal_scan(spark, k, rate):
    rows = series_counts(k, 400, rate)
    size = sum(r[3] + r[4] for r in rows) / k
    cuts, bucket = [datetime(2010, 1, 1)], 0
    for r in sorted(rows, key=lambda r: (r[6], r[0])):
        bucket += r[3] + r[4]
        if bucket >= size - 1:
            cuts.append(r[5])
            bucket = 0
    edges = cuts[:k] + [datetime(2030, 1, 1)]
    want = sorted((r[0], i + 1) for r in rows for i in range(k) if edges[i] < r[5] <= edges[i + 1])
    got = P.balanced_time_partitions(spark.createDataFrame(rows, COUNTS), k).select("harpnum", "partition").collect()
    assert sorted(map(tuple, got)) == want
    assert {r[0] for r in got} == {r[0] for r in rows}


def ids(spark, n):
    return spark.range(n).withColumnRenamed("id", "sid")


def test_undersample_is_exact_and_seeded(spark):
    df = ids(spark, 1000)
    a = {r.sid for r in R.undersample(df, 137, ["sid"], 1).collect()}
    b = {r.sid for r in R.undersample(df.repartition(7), 137, ["sid"], 1).collect()}
    c = {r.sid for r in R.undersample(df, 137, ["sid"], 2).collect()}
    assert len(a) == 137 and a == b and a != c
    assert R.undersample(df, 5000, ["sid"]).count() == 1000


def test_oversample_reaches_target(spark, monkeypatch):
    monkeypatch.setattr(R, "DRAW_BLOCK", 100)
    rows = R.oversample(ids(spark, 100), 1234, ["sid"]).collect()
    assert len(rows) == 1234 and {r.sid for r in rows if r.draw is None} == set(range(100))
    assert {r.draw for r in rows if r.draw is not None} == set(range(1134))
    assert R.oversample(ids(spark, 100), 50, ["sid"]).count() == 100


def test_ratio_keeps_all_flaring(spark):
    df = spark.range(3000).select(
        (F.col("id") % 3).alias("partition"), F.col("id").alias("harpnum"), F.lit(0).alias("slice_pos"),
        F.when(F.col("id") % 3 == 2, "NF").when(F.col("id") % 50 == 0, "FL").otherwise("NF").alias("outcome"),
    )
    got = {(r.partition, r.outcome): r["count"] for r in R.undersample_to_ratio(df).groupBy("partition", "outcome").count().collect()}
    for p in (0, 1):
        assert got[(p, "FL")] == 20 and got[(p, "NF")] == 123
    assert got[(2, "NF")] == 1 and (2, "FL") not in got


def monthly(spark, flaring):
    rows = [(f"m{i:02d}", j < f) for i, f in enumerate(flaring) for j in range(100)]
    return spark.createDataFrame(rows, "month string, flaring boolean")


def test_month_split_is_inside_bounds(spark):
    rows = R.split_by_month(monthly(spark, [3, 30, 12, 8, 20, 9, 5, 14, 11, 7, 16, 10]), "month", "flaring").collect()
    per = dict(zip([f"m{i:02d}" for i in range(12)], [3, 30, 12, 8, 20, 9, 5, 14, 11, 7, 16, 10]))
    train = sum(per[r.month] for r in rows if r.is_train)
    assert len(rows) == 12 and sum(r.is_train for r in rows) == 9 and int(145 * 0.6) < train < int(145 * 0.75)


def test_infeasible_month_split_raises(spark):
    with pytest.raises(Exception, match="no month split"):
        R.split_by_month(monthly(spark, [100, 0]), "month", "flaring").collect()


def test_integer_percent(spark):
    rows = [(1, None if i == 0 else 1.0) for i in range(200)] + [(2, None if i == 0 else 1.0) for i in range(50)]
    df = spark.createDataFrame(rows, "s long, v double")
    assert {r.s for r in R.valid_samples(df, ["s"], ["v"]).select("s").distinct().collect()} == {1}
    assert R.valid_samples(df, ["s"], ["v"], integer_percent=False).count() == 0


@pytest.mark.parametrize("strategy, size", [("under", 40), ("over", 160)])
def test_balance(spark, strategy, size):
    df = spark.range(200).select(F.lit("train").alias("split"), (F.col("id") % 5 == 0).alias("f"), F.col("id").alias("sid"))
    got = {r.f: r["count"] for r in R.balance(df, "split", "f", ["sid"], strategy).groupBy("f").count().collect()}
    assert got == {True: size, False: size}


YEARS = {"early": datetime(2005, 1, 1), "mid": datetime(2015, 1, 1), "late": datetime(2035, 1, 1)}


@pytest.mark.parametrize("flares,k", [([0, 0, 0, 0], 3), ([90, 1, 1, 1], 4), ([1, 1, 0, 0], 4), ([5, 5, 5, 5], 2), ([3], 1), ([], 3)])
def test_no_series_is_lost(spark, flares, k):
    starts = [YEARS["early"], YEARS["mid"], YEARS["late"], None]
    rows = [(f"s{i}", 0, 0, m, 0, starts[i], starts[i]) for i, m in enumerate(flares)]
    schema = "harpnum string, BFLARE long, CFLARE long, MFLARE long, XFLARE long, st timestamp_ntz, et timestamp_ntz"
    parts = P.balanced_time_partitions(spark.createDataFrame(rows, schema), k)
    got = parts.collect()
    assert {r.harpnum for r in got} == {r[0] for r in rows}
    assert all(1 <= r.partition <= k for r in got) and parts.columns == [*(c.split()[0] for c in schema.split(", ")), "partition"]
    assert P.repeated_series(parts).first()[0] == sum(n > 1 for n in Counter(r.harpnum for r in got).values())


def test_rare_month_split_is_found_and_an_impossible_one_refused(spark):
    counts = [100] + [0] * 5 + [37] * 10
    assert R.choose_months(counts, 11, 365, 379) is not None and R.choose_months([100, 0], 2, 60, 75) is None
    rare = [1000] + [1] * 11 + [990]
    edges = [int(sum(rare) * b) for b in (0.50, 0.503)]
    assert (R.choose_months(rare, 9, *edges) is not None) == any(edges[0] < sum(c) < edges[1] for c in combinations(rare, 9))
    rows = [(f"m{i:02d}", j < c) for i, c in enumerate(counts) for j in range(100)]
    got = R.split_by_month(spark.createDataFrame(rows, "month string, flaring boolean"), "month", "flaring", bounds=(0.777, 0.8085)).collect()
    taken = sum(counts[int(r.month[1:])] for r in got if r.is_train)
    assert taken == 370


@pytest.mark.parametrize("states", [R.STATES, 64])
def test_constructed_splits_equal_all_choices(states):
    rnd = random.Random(4)
    for _ in range(150):
        counts = [rnd.choice([0, 1, 2, 5, 40, 1000, 10**12]) for _ in range(rnd.randint(1, 9))]
        taken, low = rnd.randint(0, len(counts)), rnd.randint(-1, sum(counts) // 2 + 2)
        high = low + rnd.choice([1, 2, 10, 500, 10**12])
        chosen = R.choose_months(counts, taken, low, high, states=states)
        assert (chosen is not None) == any(low < sum(c) < high for c in combinations(counts, taken))
        if chosen is not None:
            assert sum(chosen) == taken and low < sum(c for c, take in zip(counts, chosen) if take) < high


def test_a_rare_split_of_huge_counts_is_built_in_bounded_memory():
    """Two months of 38 % each, nearly all the rest in 26 of the other 38: only one of the two with those 26 fits."""
    rnd = random.Random(9)
    counts = [38 * 10**9, 38 * 10**9] + [10**9 * 24 // 26 + rnd.randrange(10**6) for _ in range(26)] + [rnd.randrange(10**6) for _ in range(12)]
    total, began = sum(counts), time.perf_counter()
    low, high = int(0.60 * total), int(0.75 * total)
    tracemalloc.start()
    chosen = R.choose_months(counts, math.ceil(0.67 * 40), low, high)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(chosen) == 27 and low < sum(c for c, take in zip(counts, chosen) if take) < high
    assert time.perf_counter() - began < 60 and peak < 600e6
    assert R.choose_months(counts, 27, low, high) == R.choose_months(counts, 27, low, high)


def test_draws_of_groups_differ_and_spread(spark):
    need = spark.range(50).select(F.col("id").alias("g"), F.lit(1000).cast("long").alias("__m"), F.lit(1000).cast("long").alias("__draw"))
    draws = R._draws(need, 13)
    by_group = draws.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("draw", "__pos"))).alias("d")).collect()
    assert len({str(r.d[:20]) for r in by_group}) == 50 and all(len(r.d) == 1000 for r in by_group)
    assert draws.withColumn("task", F.spark_partition_id()).select("task").distinct().count() > 1


@pytest.mark.parametrize("scale,shift", [(1.0, 0.0), (1e-9, 0.0), (1e12, -3e11), (0.0, 5.0)])
def test_quantiles_of_any_range(spark, scale, shift):
    values = [((i * 7919) % 1009) / 1009 * scale + shift for i in range(3000)] + [1e15 * scale]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = E.exact_quantiles(df, "v", {"a": 0.5, "b": 0.95, "c": 0.0, "d": 1.0}).first()
    assert got == pytest.approx(tuple(np.quantile(values, [0.5, 0.95, 0.0, 1.0])), rel=1e-12)


def test_quantiles_of_ties_and_few_values(spark):
    """One value with nearly all the weight, at either end; a single row; none; NaN as the greatest; a few pivots and many passes."""
    for values in ([0.0] * 5000 + [1.0, 2.0, 3.0], [9.0] * 5000 + [1.0, 2.0], [4.0], [float(i % 7) for i in range(700)]):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
        got = E.exact_quantiles(df, "v", {"a": 0.5, "b": 0.9997, "c": 0.0, "d": 1.0}, pivots=3).first()
        assert got == pytest.approx(tuple(np.quantile(values, [0.5, 0.9997, 0.0, 1.0])), rel=1e-12)
    none = spark.createDataFrame([(None,)], "v double")
    assert E.exact_quantiles(none, "v", {"a": 0.5}).first().a is None
    odd = E.exact_quantiles(spark.createDataFrame([(1.0,), (2.0,), (float("nan"),)], "v double"), "v", {"a": 0.5, "b": 1.0}).first()
    assert odd.a == 2.0 and np.isnan(odd.b)


def test_quantiles_shuffle_counts_only(spark):
    """A pass reads the stored values and shuffles at most a row per part and task, however many distinct values there are."""
    df = spark.range(0, 400_000, 1, 8).select((F.xxhash64("id") / 1e6).alias("__v"))
    parts = E._count_parts(df, df.schema["__v"].dataType, [(None, None)], 64)[0]
    assert len(parts) <= 127 and sum(p.n for p in parts) == 400_000
    assert max(p.n for p in parts) < 2 * 400_000 / 64
