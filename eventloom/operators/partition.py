"""Time-ordered balanced partitions of whole series."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .scan import running_sum

COUNT_COLUMNS = ["BFLARE", "CFLARE", "MFLARE", "XFLARE"]


def series_event_counts(series: DataFrame, by: list[str], on: str, cols: list[str] = COUNT_COLUMNS) -> DataFrame:
    """Sum of each count column, first and last time, per series."""
    return series.groupBy(*by).agg(*[F.sum(c).alias(c) for c in cols], F.min(on).alias("st"), F.max(on).alias("et"))


def corpus_counts(counts: DataFrame) -> DataFrame:
    """Series with events of each class over the whole corpus, and totals."""
    b, c, m, x = (F.col(n) for n in COUNT_COLUMNS)
    anything = (b + c + m + x) != 0
    return counts.agg(
        F.count(F.lit(1)).alias("n_series"), F.count_if((m != 0) | (x != 0)).alias("n_mx"), F.count_if(x != 0).alias("n_x"),
        F.count_if(c != 0).alias("n_c"), F.count_if(b != 0).alias("n_b"), F.count_if(anything).alias("n_any"),
        F.count_if(~anything).alias("n_none"), *[F.sum(n).alias(f"total_{n}") for n in COUNT_COLUMNS],
    )


def breakpoints(counts: DataFrame, k: int, cell: timedelta = timedelta(days=1)) -> list[Column]:
    """Start times at which the greedy scan closes partitions 1 .. k-1, as scalar subqueries.

    Series are scanned by end time and large events are added up; a partition is closed by the first
    series that brings the sum since the last cut to total / k - 1. On running sums this is
    "the smallest running sum that is at least last cut + target", so each cut is one
    minimum over a table of running sums and no ordered list is gathered anywhere.
    Series without large events never change the sum and are left out.
    """
    mx = F.col("MFLARE") + F.col("XFLARE")
    flaring = counts.select("st", "et", "__key", mx.alias("__mx")).where(mx > 0)
    sums = running_sum(flaring, [], "et", F.col("__mx"), "__sum", tie=("__key",), total="__total", cell=cell)
    sums = materialize(sums.select("__sum", "__total", "st"), "running-sums")
    cuts, last = [], F.lit(0)
    for _ in range(k - 1):
        target = F.col("__total") / k - 1
        cut = sums.where(F.col("__sum") >= last + target).agg(F.min(F.struct("__sum", "st")).alias("c")).scalar()
        cuts.append(cut["st"])
        last = cut["__sum"]
    return cuts


def balanced_time_partitions(
    counts: DataFrame, k: int = 5, key: str = "harpnum", cell: timedelta = timedelta(days=1),
) -> DataFrame:
    """Series counts with their partition number 1 .. k; every series is in at least one.

    The first partition takes all starts up to the first cut, partition i the starts in ``(cut i-1, cut i]`` and partition k everything
    after the last cut, also when there are fewer than k - 1 cuts (few large events): then partitions between
    stay empty. Without any large event, and for series without a start, it is partition k. The counts (one row per series) are stored
    once, because every cut reads them. Cuts are taken in end-time order, so their start times
    may go backwards; a series inside two such intervals is in both partitions (``repeated_series`` counts them).
    """
    based = materialize(counts.withColumn("__key", F.col(key)), "series-counts")
    cuts = F.array_compact(F.array(*breakpoints(based, k, cell)))
    st = F.col("st")
    edged = based.withColumn("__cuts", cuts)

    def holds(i: Column) -> Column:
        above = F.when(i == 1, F.lit(True)).otherwise(st > F.get("__cuts", i - 2))
        return above & (st <= F.get("__cuts", i - 1))

    closed = F.filter(F.sequence(F.lit(1), F.greatest(F.size("__cuts"), F.lit(1))), lambda i: F.coalesce(holds(i), F.lit(False)))
    last = F.coalesce(st <= F.element_at("__cuts", -1), F.lit(False)) if k > 1 else F.lit(False)
    hits = F.when(F.size("__cuts") == 0, F.array(F.lit(k))).otherwise(F.when(last, closed).otherwise(F.array_append(closed, F.lit(k))))
    return edged.withColumn("partition", F.explode(hits)).drop("__cuts", "__key")


def repeated_series(parts: DataFrame, key: str = "harpnum") -> DataFrame:
    """Number of series that lie in more than one partition, because cuts went backwards."""
    return parts.groupBy(key).count().agg(F.count_if(F.col("count") > 1).alias("n_repeated"))


def apply_partitions(series: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """Whole series with their partition number."""
    return series.join(parts.select(key, "partition"), key)


def partition_stats(parts: DataFrame) -> DataFrame:
    """Series and event counts per partition."""
    b, c, m, x = (F.col(n) for n in COUNT_COLUMNS)
    return parts.groupBy("partition").agg(
        F.count_if(x != 0).alias("n_x"), F.count_if(m != 0).alias("n_m"), F.count_if(c != 0).alias("n_c"),
        F.count_if(b != 0).alias("n_b"), F.count_if((m != 0) | (x != 0)).alias("n_mx"), F.count(F.lit(1)).alias("n_series"),
        F.sum(m).alias("total_m"), F.sum(x).alias("total_x"), F.sum(m + x).alias("total_mx"),
    )
