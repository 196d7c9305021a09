"""Dataset building: balanced partitions, labelled slices, class balance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classes import parse_label_max
from ..operators.events import class_at_least
from ..operators.labels import WindowConfig, label_instances, window_frames
from ..operators.partition import apply_partitions, balanced_time_partitions, series_event_counts
from ..operators.sampling import undersample_to_ratio
from ..session import materialize

LABELS = [f"{c}FLARE_LABEL" for c in "BCMX"]
BEST = [f"{c}FLARE_BEST" for c in "BCMX"]


def labelled_slices(
    annotated: DataFrame, unmatched: DataFrame, key: str = "harpnum", on: str = "ts", cfg: WindowConfig = WindowConfig(),
    parse_labels: bool = True,
) -> DataFrame:
    """Slices of every series with outcome and label; unmatched events below M are ignored.

    Columns with the best event of each slot are used where the series has them; else the label texts are parsed.
    """
    if set(BEST) <= set(annotated.columns):
        annotated = annotated.drop(*LABELS).withColumnsRenamed(dict(zip(BEST, LABELS)))
    elif parse_labels:
        annotated = annotated.withColumns({c: parse_label_max(F.col(c), with_verification=True) for c in LABELS})
    large = class_at_least(unmatched, "M").select("peak_time", "goes_class")
    return label_instances(window_frames(annotated, [key], on, cfg), large, cfg, [key])


def build_dataset(
    annotated: DataFrame, unmatched: DataFrame, key: str = "harpnum", on: str = "ts", k: int = 5, cfg: WindowConfig = WindowConfig(),
    keep_share: float = 0.14, seed: int = 13,
) -> DataFrame:
    """Partitioned, labelled and undersampled instances."""
    parts = balanced_time_partitions(series_event_counts(annotated, [key], on), k, key)
    slices = materialize(apply_partitions(labelled_slices(annotated, unmatched, key, on, cfg), parts, key), "slices")
    return undersample_to_ratio(slices, "partition", [key, "slice_pos"], keep_share=keep_share, seed=seed)
