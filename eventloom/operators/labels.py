"""Sliding observation and prediction windows, their quality filters and labels."""

from __future__ import annotations

from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classes import NO_LABEL, class_letter, verified_only
from .interval import exists_in_window
from .series import _placed, chunked


@dataclass(frozen=True)
class WindowConfig:
    """Window lengths in rows. The defaults are 12 h, 0 h, 24 h and 1 h at a 12-minute cadence."""

    obs: int = 60
    lat: int = 0
    pred: int = 120
    step: int = 5
    clear: int = 30
    use_clear: bool = False
    min_trusted: float = 0.9
    max_low_quality: float = 0.1
    classes: str = "FLNF"

    @property
    def unit(self) -> int:
        """Rows that every window boundary is a multiple of."""
        return gcd(self.obs, self.lat, self.pred, self.step, *((self.clear,) if self.use_clear else ()))


def slice_starts(series: DataFrame, by: list[str], on: str, cfg: WindowConfig) -> DataFrame:
    """Start position and time of every slice: 0, step, 2 step ... below n - (obs + lat)."""
    placed = _placed(series, by, on)
    fits = (F.col("pos") % cfg.step == 0) & (F.col("pos") < F.col("n") - (cfg.obs + cfg.lat))
    return placed.where(fits).select(*by, F.col("pos").alias("slice_pos"), F.col(on).alias("obs_start"))


def _best(*labels: Column) -> Column:
    """Greatest label of a row as text, ``None`` markers left out."""
    present = [F.nullif(l, F.lit(NO_LABEL)) for l in labels]
    return F.greatest(*present) if len(present) > 1 else present[0]


def window_frames(
    series: DataFrame, by: list[str], on: str, cfg: WindowConfig, trusted: str = "IS_TMFI", quality: str = "XR_QUAL",
    counts: tuple[str, str] = ("MFLARE", "XFLARE"), large: tuple[str, ...] = ("MFLARE_LABEL", "XFLARE_LABEL"),
    small: tuple[str, ...] = ("CFLARE_LABEL", "BFLARE_LABEL"),
) -> DataFrame:
    """One row per slice with everything the labelling rules need.

    Rows go into position chunks that overlap by the longest frame, which takes the only shuffle of this
    step: folding, frames and sums all work inside (key, chunk). All window boundaries are multiples
    of ``cfg.unit`` rows, so rows are first folded into blocks of that many. Counts over a frame
    are differences of running sums; the best label is a maximum over the few blocks of the frame.
    """
    u = cfg.unit
    obs, start, stop, clear = cfg.obs // u, (cfg.obs + cfg.lat) // u, (cfg.obs + cfg.lat + cfg.pred) // u, cfg.clear // u
    back = 1 + (max(0, clear - start) if cfg.use_clear else 0)
    ahead = stop + (clear if cfg.use_clear else 0)
    size = max(1024, 8 * (back + ahead))
    prepared = _placed(series, by, on).select(
        *by, F.col(on).alias("__ts"), "pos", "n",
        F.coalesce(F.col(trusted), F.lit(False)).alias("__ok"),
        sum((F.coalesce(F.col(c), F.lit(0)) for c in counts), F.lit(0)).alias("__large"),
        F.coalesce(F.col(quality) == 0, F.lit(False)).alias("__low"),
        _best(*[verified_only(F.col(c)) for c in large]).alias("__lv"),
        _best(*[F.col(c) for c in large]).alias("__la"),
        _best(*[verified_only(F.col(c)) for c in small]).alias("__sv"),
    )
    spread = chunked(prepared, back * u, ahead * u, rows=size * u).drop("__home").repartition(*by, "__chunk")
    rows = spread.groupBy(*by, "__chunk", F.floor(F.col("pos") / u).alias("__b")).agg(
        F.first("n").alias("n"), F.min("__ts").alias("__t0"), F.max("__ts").alias("__t1"), F.count(F.lit(1)).alias("__rows"),
        F.count_if("__ok").alias("__ok"), F.sum("__large").alias("__large"), F.count_if("__low").alias("__low"),
        F.max("__lv").alias("__lv"), F.max("__la").alias("__la"), F.max("__sv").alias("__sv"),
    )
    ordered = Window.partitionBy(*by, "__chunk").orderBy("__b")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    summed = ("__rows", "__ok", "__large", "__low")
    rows = rows.withColumns({
        **{f"__run{c}": F.sum(c).over(upto) for c in summed},
        **{f"__all{c}": F.sum(c).over(whole) for c in summed},
        "__end": F.max("__t1").over(whole),
    })

    def over_frame(c: str, low: int, high: int) -> Column:
        """Sum of ``c`` over blocks low..high relative to this one, cut at the series ends."""
        until = F.coalesce(F.lead(f"__run{c}", high).over(ordered), F.col(f"__all{c}"))
        skipped = F.lead(f"__run{c}", low - 1).over(ordered) if low >= 1 else F.lag(f"__run{c}", 1 - low).over(ordered)
        return until - F.coalesce(skipped, F.col(f"__all{c}") if low >= 1 else F.lit(0))

    ahead_frame = ordered.rowsBetween(start, stop - 1)
    rows = rows.select(
        *by, (F.col("__b") * u).alias("slice_pos"), "n", (F.floor(F.col("__b") / size) == F.col("__chunk")).alias("__home"), F.col("__t0").alias("obs_start"),
        F.lead("__t1", obs - 1).over(ordered).alias("obs_end"),
        over_frame("__ok", 0, obs - 1).alias("obs_trusted"),
        over_frame("__rows", start, stop - 1).alias("pred_rows"),
        F.lead("__t0", start).over(ordered).alias("pred_start"),
        F.coalesce(F.lead("__t1", stop - 1).over(ordered), F.col("__end")).alias("pred_end"),
        over_frame("__large", start, stop - 1).alias("pred_large"),
        over_frame("__low", start, stop - 1).alias("pred_low_quality"),
        over_frame("__large", start - clear, stop + clear - 1).alias("clear_large") if cfg.use_clear
        else F.lit(0).cast("long").alias("clear_large"),
        F.max("__lv").over(ahead_frame).alias("large_verified"),
        F.max("__la").over(ahead_frame).alias("large_any"),
        F.max("__sv").over(ahead_frame).alias("small_verified"),
    )
    starts = (F.col("slice_pos") % cfg.step == 0) & (F.col("slice_pos") < F.col("n") - (cfg.obs + cfg.lat))
    return rows.where(F.col("__home") & starts).drop("__home", "n")


def label_instances(frames: DataFrame, unmatched: DataFrame, cfg: WindowConfig, by: list[str]) -> DataFrame:
    """Outcome and label of every slice.

    ``unmatched`` holds large events no series claims: peak_time, goes_class. Filters apply in order;
    rejected slices keep the reason as their outcome.
    """
    searched = exists_in_window(frames, unmatched, "pred_start", "pred_end", "peak_time", ["goes_class"], prefix="um_")
    trusted = F.col("obs_trusted") >= F.lit(cfg.obs * cfg.min_trusted)
    quiet = F.col("pred_large") == 0
    small = F.coalesce(F.col("small_verified"), F.lit("FQ"))
    # fixed values: the names of the filters are part of the output
    reason = (
        F.when(~trusted, "TMFI_Filtered")
        .when(quiet & F.col("um_time").isNotNull(), "NONMATCHED_FL_Filter")
        .when(quiet & (F.col("pred_low_quality") > F.col("pred_rows") * cfg.max_low_quality), "XRAY_QUAL_Filter")
        .when(quiet & F.lit(cfg.use_clear) & (F.col("clear_large") != 0), "CLEAR_WINDOW_Filter")
        .when(~quiet & F.col("large_verified").isNull(), "NON_VERIFIED_Filter")
    )
    label = F.when(quiet, small).otherwise(F.col("large_verified"))
    first_letter = class_letter(label)
    outcome = (
        F.when(quiet, "NF").otherwise("FL") if cfg.classes == "FLNF"
        else F.when(label == "FQ", "Q").when(first_letter.isin("X", "M", "C", "B"), first_letter)
    )
    shown = (
        F.when(reason.isNull(), label)
        .when(reason == "NONMATCHED_FL_Filter", F.concat(F.col("um_goes_class"), F.lit("@"), F.date_format("um_time", "yyyy-MM-dd HH:mm:ss")))
        .when(reason == "NON_VERIFIED_Filter", F.col("large_any"))
    )
    return searched.select(
        *by, "slice_pos", "obs_start", "obs_end", F.coalesce(reason, outcome).alias("outcome"), shown.alias("label"),
        reason.alias("reason"),
    )


def explode_observations(instances: DataFrame, series: DataFrame, by: list[str], on: str, obs: int) -> DataFrame:
    """The observation rows of each instance."""
    wanted = instances.select(*by, "slice_pos", F.explode(F.sequence(F.col("slice_pos"), F.col("slice_pos") + (obs - 1))).alias("pos"))
    return wanted.hint("merge").join(_placed(series, by, on).drop("n"), [*by, "pos"])  # sized like the instances, with as many rows more as ``obs``


def filter_counts(instances: DataFrame) -> DataFrame:
    """Slices rejected per reason."""
    return instances.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def class_mix(instances: DataFrame, partition: str = "partition") -> DataFrame:
    """X and M among flaring, C, B and quiet among the others, per partition."""
    kept = instances.where(F.col("reason").isNull())
    counts = {"n_x": "X", "n_m": "M", "n_c": "C", "n_b": "B", "n_quiet": "FQ"}
    return kept.groupBy(partition).agg(*[F.count_if(F.startswith("label", F.lit(p))).alias(n) for n, p in counts.items()])
