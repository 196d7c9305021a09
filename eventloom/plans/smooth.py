"""Smoothed, scaled curves of a series, as drawn in overview figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.series import _placed, interpolate_linear, rolling_mean, scale, trim_edges
from ..session import materialize


def smooth_series(
    series: DataFrame, by: list[str], on: str, cols: list[str], edge: int = 200, window: int = 11, lead: int = 100
) -> DataFrame:
    """Interpolate, cut ``edge`` rows at both ends, scale to 0..1, average over ``window`` rows, cut ``lead`` first rows.

    Rows are placed once; every step hands their places on to the next. The step that reads its input twice starts from a stored table.
    """
    rows = _placed(series, by, on).select(*by, on, "pos", "n", *cols)
    filled = interpolate_linear(rows, by, on, cols)
    cut = materialize(trim_edges(filled, by, on, edge, edge, keep_place=True), "trimmed-series")
    means = rolling_mean(scale(cut, by, on, cols), by, on, cols, window, keep_place=True)
    means = means.select(*by, on, "pos", "n", *[F.col(f"{c}_mean").alias(c) for c in cols])
    return trim_edges(means, by, on, lead, 0)
