"""Seeded sampling, month splits and class balance.

Random order is the md5 of seed and id, so a sample depends only on its inputs. Rank in that order is
computed per hash bucket with carried offsets: no group, however large, is sorted in one task.
"""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from ..session import materialize
from .scan import key_stats, ranked

BUCKET_DIGITS = 4
DRAW_BLOCK = 100_000


def hash_rank(seed: int, *ids: Column) -> Column:
    """Hex text that orders rows at random."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[i.cast("string") for i in ids]))


def _ranked(df: DataFrame, by: list[str], ids: list[str], seed: int, totals: dict[str, Column] | None = None) -> DataFrame:
    """Rows with their random position ``__pos`` in the group and the group's size ``__n``."""
    keyed = df.withColumn("__h", hash_rank(seed, *[F.col(i) for i in ids]))
    bucket = F.conv(F.substring("__h", 1, BUCKET_DIGITS), 16, 10).cast("long")
    return ranked(keyed, by, bucket, ["__h", *ids], pos="__pos", total="__n", totals=totals)


HIDDEN = ("__h", "__pos", "__n")


def undersample(df: DataFrame, n: int, ids: list[str], seed: int = 13) -> DataFrame:
    """``n`` random rows without replacement (all rows when there are fewer)."""
    return _ranked(df, [], ids, seed).where(F.col("__pos") < n).drop(*HIDDEN)


def _draws(need: DataFrame, seed: int) -> DataFrame:
    """Random positions with replacement; ``need`` has group columns, ``__m`` rows to draw from, ``__draw`` draws."""
    blocks = need.where((F.col("__draw") > 0) & (F.col("__m") > 0)).withColumn(
        "__block", F.explode(F.sequence(F.lit(0), F.ceil(F.col("__draw") / DRAW_BLOCK) - 1))
    )
    first = F.col("__block") * DRAW_BLOCK
    group = [c for c in need.columns if c not in ("__m", "__draw")]
    # a fixed number: the few rows here would be coalesced into one task, which would then make all draws
    parts = max(int(need.sparkSession.conf.get("spark.sql.shuffle.partitions")), need.sparkSession.sparkContext.defaultParallelism)
    spread = blocks.repartition(parts, *group, "__block").withColumn(
        "draw", F.explode(F.sequence(first, F.least(first + DRAW_BLOCK, F.col("__draw")) - 1))
    )
    number = F.conv(F.substring(hash_rank(seed, *[F.col(g) for g in group], F.col("draw")), 1, 12), 16, 10).cast("long")
    return spread.withColumn("__pos", number % F.col("__m")).drop("__block", "__draw", "__m")


def oversample(df: DataFrame, n: int | Column, ids: list[str], seed: int = 13) -> DataFrame:
    """All rows plus random draws with replacement until there are ``n``; column ``draw`` is NULL on originals."""
    placed = _ranked(df, [], ids, seed)
    need = df.agg(F.count(F.lit(1)).alias("__m")).withColumn("__draw", (n if isinstance(n, Column) else F.lit(n)) - F.col("__m"))
    extra = placed.join(_draws(need, seed), "__pos")
    return placed.withColumn("draw", F.lit(None).cast("long")).unionByName(extra).drop(*HIDDEN)


def undersample_to_ratio(
    instances: DataFrame, by: str = "partition", ids: list[str] = ("harpnum", "slice_pos"), label: str = "outcome",
    keep: str = "FL", cut: str = "NF", keep_share: float = 0.14, seed: int = 13,
) -> DataFrame:
    """All kept-class rows, and at random ``int(kept * (1 - share) / share) + 1`` rows of the other class, per group."""
    factor = (1 - keep_share) / keep_share
    is_cut = F.col(label) == cut
    pool = instances.where(F.col(label).isin(keep, cut)).withColumn("__cut", is_cut)
    rows = pool.withColumn("__h", hash_rank(seed, *[F.col(i) for i in ids]))
    bucket = F.when(F.col("__cut"), F.conv(F.substring("__h", 1, BUCKET_DIGITS), 16, 10).cast("long")).otherwise(
        -1 - F.pmod(F.xxhash64(*ids), F.lit(4096))
    )
    placed = ranked(
        rows, [by], bucket, ["__h", *ids], pos="__pos", total="__n", totals={"__kept": F.when(F.col("__cut"), 0).otherwise(1)}
    )
    wanted = F.floor(F.col("__kept") * F.lit(factor)) + 1
    chosen = ~F.col("__cut") | (F.col("__pos") - F.col("__kept") < wanted)
    return placed.where(chosen).drop(*HIDDEN, "__cut", "__kept")


def month_counts(samples: DataFrame, month: str, flaring: str) -> DataFrame:
    """Flaring and other samples per month with their shares."""
    hit = F.coalesce(F.col(flaring), F.lit(False))
    out = samples.groupBy(month).agg(F.count_if(hit).alias("n_flaring"), F.count_if(~hit).alias("n_quiet"))
    total = F.col("n_flaring") + F.col("n_quiet")
    return out.withColumns({"flaring_share": F.col("n_flaring") / total, "quiet_share": F.col("n_quiet") / total})


def _draw_months(months: DataFrame, month: str, first: int, last: int, train_ratio: float, seed: int) -> DataFrame:
    """Draws number ``first`` to ``last`` of whole months, each with its training count ``__train`` and the total."""
    draws = months.withColumn("candidate", F.explode(F.sequence(F.lit(first), F.lit(last))))
    draws = draws.withColumn("__h", hash_rank(seed, F.col("candidate"), F.col(month)))
    per = Window.partitionBy("candidate")
    rank = F.row_number().over(per.orderBy("__h", month))
    draws = draws.withColumns({"__rank": rank, "__months": F.count(F.lit(1)).over(per), "__total": F.sum("n_flaring").over(per)})
    draws = draws.withColumn("is_train", F.col("__rank") <= F.ceil(F.col("__months") * F.lit(train_ratio)))
    return draws.withColumn("__train", F.sum(F.when(F.col("is_train"), F.col("n_flaring")).otherwise(0)).over(per))


STATES = 1 << 22
"""Sums that the search for a split holds at first and, times 16, at most (32 and 512 MB), whatever the counts are."""


def reachable_sums(counts: list[int], taken: int, low: int, high: int, width: int) -> tuple[list[list[np.ndarray]], bool]:
    """Sums of j of the first i counts, as sorted arrays [i][j], and whether all are there.

    Only sums from which ``taken`` counts can still end strictly between ``low`` and ``high`` are kept, by the least and
    greatest sums of the counts to come. Of more than ``width`` sums those nearest to evenly spaced values stay; each is the sum of a real choice.
    """
    empty = np.zeros(0, np.int64)
    layers, whole = [[np.zeros(1, np.int64)] + [empty] * taken], True
    for i, count in enumerate(counts, 1):
        rest = np.sort(np.array(counts[i:], np.int64))
        least = np.concatenate([[0], np.cumsum(rest)])
        most = np.concatenate([[0], np.cumsum(rest[::-1])])
        layer = []
        for j in range(taken + 1):
            sums = np.union1d(layers[-1][j], layers[-1][j - 1] + count) if j else layers[-1][0]
            need = taken - j
            sums = sums[(sums + least[need] < high) & (sums + most[need] > low)] if need <= len(rest) else empty
            if len(sums) > width:
                sums, whole = sums[np.unique(np.searchsorted(sums, np.linspace(sums[0], sums[-1], width)))], False
            layer.append(sums)
        layers.append(layer)
    return layers, whole


def choose_months(counts: list[int], taken: int, low: int, high: int, seed: int = 13, states: int = STATES) -> list[bool] | None:
    """``taken`` of the counts with a sum strictly between ``low`` and ``high``, chosen by the seed; None if there are none.

    The reachable sums are built count by count, then a seeded walk leads back from one of the fitting ones. Thinned sums are searched
    again with more of them before the search gives up, which only a very narrow range can bring about (an error, not None).
    """
    rng = random.Random(seed)
    width, most = (max(16, n // max(len(counts) * taken, 1)) for n in (states, 16 * states))
    while True:
        layers, whole = reachable_sums(counts, taken, low, high, width)
        if len(layers[-1][taken]):
            break
        if whole:
            return None
        if width >= most:
            raise ValueError("no month split was found; the bounds are too narrow to prove that there is none")
        width *= 4
    total, left, chosen = int(rng.choice(layers[-1][taken])), taken, [False] * len(counts)
    for i in range(len(counts) - 1, -1, -1):
        before, count = layers[i], counts[i]
        ways = [take for take in (False, True) if left >= take and total - take * count in before[left - take]]
        chosen[i] = rng.choice(ways)
        total, left = total - chosen[i] * count, left - chosen[i]
    return chosen


def split_by_month(
    samples: DataFrame, month: str, flaring: str, train_ratio: float = 0.67, bounds: tuple[float, float] = (0.60, 0.75), seed: int = 13, draws: int = 64,
) -> DataFrame:
    """Months with ``is_train``: the first seeded draw of whole months whose flaring share fits the bounds.

    A draw takes ceil(ratio * months) months; it is accepted when the training flaring count lies strictly
    between ``int(total * bounds)``. Only the month table (one row per calendar month) is worked on. When none of the first ``draws`` fits, a
    fitting choice is constructed from the reachable sums (``candidate`` is then 0); an error is raised if there is none.
    """
    months = materialize(month_counts(samples, month, flaring).select(month, "n_flaring"), "months")
    drawn = _draw_months(months, month, 1, draws, train_ratio, seed)
    low, high = (F.floor(F.col("__total") * F.lit(b)) for b in bounds)
    fitting = drawn.where((F.col("__train") > low) & (F.col("__train") < high)).agg(F.min("candidate")).first()[0]
    if fitting is not None:
        return drawn.where(F.col("candidate") == fitting).select(month, "candidate", "is_train")
    rows = months.orderBy(hash_rank(seed, F.col(month)), month).collect()  # one row per calendar month
    counts = [r["n_flaring"] for r in rows]
    chosen = choose_months(counts, math.ceil(len(counts) * train_ratio), *(math.floor(sum(counts) * b) for b in bounds), seed=seed) if counts else None
    if chosen is None:
        raise ValueError("no month split satisfies the bounds")
    built = [(r[month], 0, take) for r, take in zip(rows, chosen)]
    return samples.sparkSession.createDataFrame(built, StructType([months.schema[month], StructField("candidate", IntegerType()), StructField("is_train", BooleanType())]))


def percent_missing(samples: DataFrame, by: list[str], cols: list[str], integer_percent: bool = True) -> DataFrame:
    """Percent of missing values per sample and column, and their sum per sample."""
    def share(c: str) -> Column:
        value = F.count_if(F.col(c).isNull()) * 100 / F.count(F.lit(1))
        return F.floor(value) if integer_percent else value

    out = samples.groupBy(*by).agg(*[share(c).alias(f"pct_{c}") for c in cols])
    return out.withColumn("pct_total", sum((F.col(f"pct_{c}") for c in cols[1:]), F.col(f"pct_{cols[0]}")))


def valid_samples(samples: DataFrame, by: list[str], cols: list[str], integer_percent: bool = True) -> DataFrame:
    """Samples without missing values (to the precision of ``percent_missing``)."""
    complete = percent_missing(samples, by, cols, integer_percent).where(F.col("pct_total") == 0)
    return samples.join(complete, by, "left_semi")


def missing_log(samples: DataFrame, by: list[str], cols: list[str], above: float = 10) -> DataFrame:
    """Sample and column pairs with more than ``above`` percent missing."""
    pct = percent_missing(samples, by, cols).select(*by, *[F.col(f"pct_{c}").alias(c) for c in cols])
    return pct.unpivot(by, cols, "column_name", "pct").where(F.col("pct") > above)


def balance(df: DataFrame, group: str, label: str, ids: list[str], strategy: str = "under", seed: int = 13) -> DataFrame:
    """Equal numbers of flaring and other rows in every group.

    ``under`` cuts the majority to the minority's size at random; ``over`` adds draws of the minority
    with replacement. ``label`` is boolean; column ``draw`` numbers the added rows.
    """
    pair = [group, label]
    placed = _ranked(df, pair, ids, seed)
    if strategy == "under":
        # both sizes of the group come to every row through its hash bucket, so two large groups are no join on two keys
        bucket = F.conv(F.substring("__h", 1, BUCKET_DIGITS), 16, 10).cast("long")
        hit = F.col(label).cast("long")
        sized = key_stats(placed, [group], bucket, {"__f": ("sum", hit), "__q": ("sum", 1 - hit)})
        out = sized.where(F.col("__pos") < F.least("__f", "__q")).drop("__f", "__q")
        return out.withColumn("draw", F.lit(None).cast("long")).drop(*HIDDEN)
    sizes = df.groupBy(group).agg(F.count_if(F.col(label)).alias("__f"), F.count_if(~F.col(label)).alias("__q"))
    minority = sizes.select(
        group, (F.col("__f") < F.col("__q")).alias(label), F.least("__f", "__q").alias("__m"), F.abs(F.col("__f") - F.col("__q")).alias("__draw")
    )
    extra = placed.join(_draws(minority, seed), [*pair, "__pos"])
    return placed.withColumn("draw", F.lit(None).cast("long")).unionByName(extra).drop(*HIDDEN)


def sample_splits(
    samples: DataFrame, month: str, flaring: str, ids: list[str], value_cols: list[str], seed: int = 13,
    strategies: dict[str, str] | None = None,
) -> DataFrame:
    """Month split, validity filter and class balance in one plan; column ``split`` is train or test."""
    rules = {"train": "under", "test": "under"} | (strategies or {})
    months = split_by_month(samples, month, flaring, seed=seed).select(month, F.when(F.col("is_train"), "train").otherwise("test").alias("split"))
    valid = valid_samples(samples, ids, value_cols).join(months, month)
    parts = [
        balance(valid.where(F.col("split").isin([s for s, r in rules.items() if r == rule])), "split", flaring, ids, rule, seed)
        for rule in sorted(set(rules.values()))
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
