"""Plan shape and behaviour under a hot key."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract

from eventloom.operators import history as H

from eventloom.operators import series as S
from eventloom.operators.sampling import undersample
from eventloom.operators.scan import neighbours, positions

SF = "/root/testdata/sf0.001"
T0 = datetime(2020, 1, 1)

NO_PAIRS = [
    "asof_nearest", "asof_nearest_unbounded", "nearest_region", "match_overlap_nearest", "min_distance_overlap_any_class", "closest_pair",
    "count_events_in_slots", "count_events_in_grid", "slot_stats_join", "match_by_location", "regions_in_box", "exists_in_window",
    "event_history", "event_history_location", "label_instances", "assemble_match_table", "pre_event_window", "join_by_any_key",
    "undersample_to_ratio", "balance_over", "apply_partitions", "explode_observations",
]


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NO_PAIRS)
def test_no_nested_loop_joins(spark, name):
    plan = physical(contract.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", [*NO_PAIRS[::3], "parse_label_max", "hgs_to_hpc", "distance_summary"])
def test_no_python_in_plans(spark, name):
    plan = physical(contract.queries()[name](spark, SF))
    assert not re.search(r"Python|Pandas|ArrowEval", plan)


def test_scan_reads_few_columns(spark):
    plan = physical(contract.queries()["count_by_class"](spark, SF))
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in read.split(",")} <= {"event_id", "user_id", "value"}
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,signup)]" in physical(contract.queries()["by_source"](spark, SF))


def hot_series(spark, n=200_000):
    """One key holds ninety percent of the rows, a row per second."""
    key = F.when(F.col("id") % 10 == 0, F.col("id") % 7 + 1).otherwise(F.lit(0))
    ts = F.lit(T0).cast("timestamp_ntz")
    return spark.range(n).select(key.alias("k"), F.timestamp_add("SECOND", F.col("id"), ts).alias("ts"), F.col("id").cast("double").alias("v"))



def test_hot_key_is_cut_into_cells(spark):
    n = 200_000
    series = hot_series(spark, n)
    placed = positions(series, ["k"], "ts", cell=timedelta(hours=1))
    assert placed.agg(F.sum("pos"), F.max("n")).first()[1] == n * 9 // 10
    plan = physical(neighbours(series, ["k"], "ts", ["v"]))
    rows_windows = [w for w in re.findall(r"windowspecdefinition\(([^)]*)\)", plan) if "__t#" in w]
    assert rows_windows and all("__cell#" in w for w in rows_windows)


def test_hot_key_results_stay_whole(spark):
    n = 100_000
    series = hot_series(spark, n)
    events = series.where(F.col("v") % 100 == 1).select("k", F.col("ts").alias("peak"), F.lit("M1.0").alias("c"), F.col("v").cast("long").alias("id"))
    slots = series.where(F.col("v") % 60 == 1).select("k", "ts")
    out = H.count_events_in_slots(slots, events, ["k"], "ts", "peak", "c")
    first, last = slots.where("k = 0").agg(F.min("ts"), F.max("ts")).first()
    want = events.where(F.col("k") == 0).where((F.col("peak") >= F.lit(first)) & (F.col("peak") < F.lit(last))).count()
    assert out.where("k = 0").agg(F.sum("MFLARE")).first()[0] == want
    steps = S.irregular_step_ratio(series.where("k = 0"), ["k"], "ts", timedelta(seconds=1)).first()
    assert abs(steps.irregular_ratio - (n / 10) / (n * 0.9)) < 1e-6
    assert undersample(series, 12_345, ["v"]).count() == 12_345


def test_copies_of_one_event_are_resolved(spark):
    """A third of the events are copies of one row; the first copy survives."""
    from eventloom.operators.events import dedupe_first

    n = 30_000
    i = F.col("id")
    same = i % 3 == 0
    rows = spark.range(n).select(i, F.when(same, 0).otherwise(i).alias("a"), F.when(same, F.lit(None)).otherwise(i).alias("b"))
    kept, copies = dedupe_first(rows, ["a", "b"])
    assert kept.count() == n - n // 3 + 1 and copies.count() == n // 3 - 1 and kept.where("id = 0").count() == 1


def test_one_of_equal_rows_stays(spark):
    from eventloom.operators.events import dedupe_first

    rows = [(1, "a", 1), (1, "a", 1), (None, "a", 2), (None, "b", 3), (4, None, 4), (3, None, 5), (3, None, 6)]
    kept, copies = dedupe_first(spark.createDataFrame(rows, "id int, key string, other int"), ["key"])
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, "a", 1), (None, "b", 3), (3, None, 5)], key=str)
    assert sorted(map(tuple, copies.collect()), key=str) == sorted([(1, "a", 1), (None, "a", 2), (3, None, 6), (4, None, 4)], key=str)


def test_flux_columns_by_header_and_rejected_files(spark, tmp_path):
    from eventloom.sources.readers import flux_file_rejects, read_flux_after_marker

    (tmp_path / "a.csv").write_text("x\ndata:\ntime_tag,B_AVG,Other\n2020-01-01 00:00:00.000,1.5,9\n2020-01-01 00:01:00.000,NaN,9\n")
    (tmp_path / "b.csv").write_text("data:\nother,b_avg,TIME_TAG\n7,2.5,2020-01-02 00:00:00.000\n")
    (tmp_path / "c.csv").write_text("no marker\n1,2,3\n")
    (tmp_path / "d.csv").write_text("data:\nwhen,b_avg\n1,2\n")
    columns = ["time_tag", "b_avg", "lacking"]
    got = read_flux_after_marker(spark, str(tmp_path), columns).orderBy("ts").collect()
    assert [(r.ts.day, r.b_avg, r.lacking) for r in got] == [(1, 1.5, None), (1, None, None), (2, 2.5, None)]
    bad = {r.file.rsplit("/", 1)[1]: r.reason for r in flux_file_rejects(spark, str(tmp_path), columns).collect()}
    assert bad == {"c.csv": "no marker", "d.csv": "no time column"}


def test_shuffles_grow_with_the_rows(spark):
    """With a fixed number of partitions the memory of a task grew with the input; settings never go back."""
    from eventloom.session import PARTITION_BYTES, ROWS_PER_PARTITION, fit_shuffles

    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    session = spark.newSession()
    assert [int(session.conf.get(names[0]))] == [8]
    session.conf.set(names[1], "64MB")
    for rows, n in ((0, 8), (3 * ROWS_PER_PARTITION, 8), (20 * ROWS_PER_PARTITION, 20), (20 * ROWS_PER_PARTITION + 1, 21), (1, 21)):
        fit_shuffles(session, rows)
        assert int(session.conf.get(names[0])) == n
    assert int(session.conf.get(names[1]).rstrip("b")) == PARTITION_BYTES
    session.conf.set(names[1], "1m")
    fit_shuffles(session, 30 * ROWS_PER_PARTITION)
    assert session.conf.get(names[1]) == "1m"


def test_no_task_reads_or_merges_too_much(spark, tmp_path):
    """A task read up to 128 MB of packed columns, and partitions were merged up to 64 MB where many were set before."""
    from eventloom.session import PARTITION_BYTES, ROWS_PER_PARTITION, fit_shuffles

    sizes = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"]
    session = spark.newSession()
    session.conf.set("spark.sql.files.minPartitionNum", 1)
    session.conf.set("spark.sql.shuffle.partitions", 5000)
    session.range(3_000_000, numPartitions=1).select(F.rand(7).alias("x")).write.option("parquet.block.size", 1 << 20).parquet(str(tmp_path / "t"))
    before = [session.conf.get(s) for s in sizes]
    fit_shuffles(session, 8 * ROWS_PER_PARTITION)
    assert [session.conf.get(s) for s in sizes] == before
    assert session.read.parquet(str(tmp_path / "t")).rdd.getNumPartitions() == 1
    fit_shuffles(session, 20 * ROWS_PER_PARTITION)
    assert session.conf.get("spark.sql.shuffle.partitions") == "5000"
    assert [int(session.conf.get(s).rstrip("b")) for s in sizes] == [PARTITION_BYTES] * 2
    assert session.read.parquet(str(tmp_path / "t")).rdd.getNumPartitions() >= 3
