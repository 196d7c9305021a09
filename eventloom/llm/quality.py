"""Quality rules: boosted trees over document statistics, monotone in chosen ones, flattened into arrays for scoring."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, text_slices

WORDS = re.compile(WORD)
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_digits", "n_punct", "n_distinct", "n_short", "n_ended")
STATS_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
SAMPLE_ROWS = 20_000
"""Labelled documents that the trees are fitted on at most, chosen by a hash of their id."""

FEATURES = {
    "log_words": 0, "mean_word": 0, "symbols": -1, "dup_lines": -1, "repeated": -1, "upper": -1, "digits": 0, "punct": 0, "letters": 0,
    "distinct": 1, "short_words": 0, "ended": 0, "words_per_line": 0,
}
"""Features and the direction in which the quality may go when one grows: -1 down, 1 up, 0 either."""


def text_counts(text: str) -> tuple[int, ...]:
    """The ``COUNTS`` of one whole text; all are 0 for an empty one."""
    words = WORDS.findall(text)
    if not words:
        return (0, 0, sum(map(text.count, SYMBOLS)), 0, 0, 0, 0, 0, 0, 0, 0, 0, 0)
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    sizes = list(map(len, words))
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    upper, letters, digits, punct = _characters(codes)
    return (
        len(words), sum(sizes), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
        repeated_words(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)), len(ids)),
        len(lines), upper, letters, digits, punct, len(ids), sum(s <= 3 for s in sizes), sum(line.rstrip()[-1:] in ".!?" for line in lines),
    )


def repeated_words(ids: np.ndarray, distinct: int, window: int = 3) -> int:
    """Words that lie in a window of ``window`` words found twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    keys = ids[:n]
    for k in range(1, window):
        if k == 1:
            keys = keys * distinct + ids[1 : n + 1]
        elif distinct < 2_000_000:  # three ids fit 63 bits
            keys = keys * distinct + ids[k : n + k]
        else:
            keys = np.unique(keys, return_inverse=True)[1] * distinct + ids[k : n + k]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    found = np.zeros(n, bool)
    found[order[1:][same]] = found[order[:-1][same]] = True
    edges = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(found)
    edges[at] += 1
    edges[at + window] -= 1
    return int(np.count_nonzero(np.cumsum(edges)[:-1]))


def _characters(codes: np.ndarray) -> tuple[int, int, int, int]:
    """Upper-case letters, letters, digits and punctuation; beyond Latin-1 every character is a letter."""
    low = np.bincount(np.minimum(codes, 256), minlength=257)
    return int(low[UPPER].sum()), int(low[LETTERS].sum()), int(low[48:58].sum()), int(low[PUNCT].sum())


UPPER = np.array([i for i in range(256) if chr(i).isupper()])
LETTERS = np.array([*(i for i in range(256) if chr(i).isalpha()), 256])
PUNCT = np.array([i for i in range(33, 127) if not chr(i).isalnum()])


def counts_of(texts: Sequence[str | None]) -> dict[str, np.ndarray]:
    columns = np.array([text_counts(x or "") for x in texts], np.int64).reshape(len(texts), len(COUNTS)).T
    return dict(zip(COUNTS, columns))


def statistics(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id and the counts of every whole text (null: empty); other columns are not read, repeated rows stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text):
            counts = counts_of(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(key).cast(pa.int64()), *map(pa.array, counts.values())], names=["doc_id", *COUNTS])

    return docs.select(key, text).mapInArrow(run, STATS_SCHEMA)


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Feature matrix in the order of ``FEATURES``; a text without words has 0 everywhere."""
    c = {k: v.astype(np.float64) for k, v in counts.items()}
    words, chars, lines = (np.maximum(c[k], 1) for k in ("n_words", "word_chars", "n_lines"))
    return np.stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / words, c["n_dup_lines"] / lines, c["n_repeat_words"] / words,
        c["n_upper"] / chars, c["n_digits"] / chars, c["n_punct"] / chars, c["n_letters"] / chars, c["n_distinct"] / words,
        c["n_short"] / words, c["n_ended"] / lines, c["n_words"] / lines,
    ], axis=1)


class Trees(NamedTuple):
    """Complete trees of one depth in flat arrays: node i of a tree has the children 2i+1 and 2i+2; leaves come last."""

    depth: int
    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Chance of label 1 of every row, all rows going down all trees together."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            total += value[node - (len(feature))]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, signs: Sequence[int], trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 64, least: int = 20, l2: float = 5.0) -> Trees:
    """Newton boosting of the logistic loss on binned features with monotonic constraints.

    A split on a constrained feature counts only if its two values lie the right way round, and the values below it
    stay on their side of the middle, so the whole model is monotone. One label alone, or no rows, gives a constant.
    """
    n, width = x.shape
    p = min(max(float(y.mean()) if n else 0.5, 1e-3), 1 - 1e-3)
    base = float(np.log(p / (1 - p)))
    inner = 2**depth - 1
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for j in range(width)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(width)], axis=1) if n else np.zeros((0, width), np.int64)
    out_f, out_l, out_v = [], [], []
    total = np.full(n, base)
    for _ in range(trees if n and 0 < y.mean() < 1 else 0):
        q = 1 / (1 + np.exp(-total))
        grad, hess = y - q, q * (1 - q)
        feature, limit, value = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(inner + 1)
        rows_at = {0: (np.arange(n), -np.inf, np.inf)}
        for node in range(inner):
            rows, low, high = rows_at[node]
            best = _best_split(binned[rows], grad[rows], hess[rows], signs, bins, least, l2, low, high) if len(rows) >= 2 * least else None
            if best is None or best[1] >= len(cuts[best[0]]):
                rows_at[2 * node + 1], rows_at[2 * node + 2] = (rows, low, high), (rows[:0], low, high)
                continue
            j, cut, left, right = best
            feature[node], limit[node] = j, cuts[j][cut]
            go = binned[rows, j] > cut
            middle = (left + right) / 2
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[int(signs[j])]
            rows_at[2 * node + 1], rows_at[2 * node + 2] = (rows[~go], *bounds[0]), (rows[go], *bounds[1])
        for leaf in range(inner + 1):
            rows, low, high = rows_at[inner + leaf]
            value[leaf] = rate * np.clip(grad[rows].sum() / (hess[rows].sum() + l2), low, high)
            total[rows] += value[leaf]
        out_f.append(feature), out_l.append(limit), out_v.append(value)
    shape = (len(out_f), -1) if out_f else (0, inner)
    return Trees(depth, np.array(out_f, np.int64).reshape(shape), np.array(out_l).reshape(shape), np.array(out_v).reshape(len(out_f), -1) if out_f else np.zeros((0, inner + 1)), base)


def _best_split(binned, grad, hess, signs, bins, least, l2, low, high):
    whole_g, whole_h = grad.sum(), hess.sum()
    best, gain = None, 1e-6
    for j, sign in enumerate(signs):
        g = np.cumsum(np.bincount(binned[:, j], grad, bins + 1))[:-1]
        h = np.cumsum(np.bincount(binned[:, j], hess, bins + 1))[:-1]
        k = np.cumsum(np.bincount(binned[:, j], minlength=bins + 1))[:-1]
        left, right = np.clip(g / (h + l2), low, high), np.clip((whole_g - g) / (whole_h - h + l2), low, high)
        won = g * left - (h + l2) * left**2 / 2 + (whole_g - g) * right - (whole_h - h + l2) * right**2 / 2
        middle = np.clip(whole_g / (whole_h + l2), low, high)
        won -= whole_g * middle - (whole_h + l2) * middle**2 / 2
        won[(k < least) | (len(binned) - k < least) | (sign * (right - left) < 0)] = -np.inf
        cut = int(np.argmax(won))
        if won[cut] > gain:
            best, gain = (j, cut, left[cut], right[cut]), won[cut]
    return best


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", sample_rows: int = SAMPLE_ROWS, **options) -> Trees:
    """Fit on at most ``sample_rows`` labelled documents, those with the smallest hashes of their ids.

    Labels that are null or of an unknown document take no part. The sample (``sample_rows`` rows of ids, then
    of counts) is all that is broadcast or comes to the driver.
    """
    known = labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("double").alias("__label")).dropna()
    chosen = known.orderBy(F.xxhash64("__id"), "__id", "__label").limit(sample_rows)
    rows = docs.select(F.col(key).cast("long").alias("__id"), F.col(text).alias("__text")).join(F.broadcast(chosen.select("__id").distinct()), "__id")
    counted = statistics(rows, "__text", "__id").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).orderBy(F.xxhash64("doc_id"), "doc_id", *COUNTS, "__label").limit(sample_rows).toPandas()
    x = features({c: counted[c].to_numpy() for c in COUNTS})
    return fit(x, counted["__label"].to_numpy(np.float64), list(FEATURES.values()), **options)


class Rules(NamedTuple):
    """Fixed limits and the trees: what decides about a document."""

    trees: Trees
    least_words: int = 50
    most_repeated: float = 0.5
    threshold: float = 0.5

    def judge(self, counts: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """base_failed, score and kept of documents with these counts."""
        failed = (counts["n_words"] < self.least_words) | (counts["n_repeat_words"] > self.most_repeated * counts["n_words"])
        score = self.trees.score(features(counts))
        return failed, score, ~failed & (score >= self.threshold)


def assess(docs: DataFrame, rules: Rules, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Counts, base_failed, score (chance of good quality) and kept of every document, in one pass over the texts.

    A null text is empty and fails; a null key is judged like any other row; repeated rows are judged one
    by one; an empty table gives no rows. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text):
            counts = counts_of(batch.column(text).to_pylist())
            failed, score, kept = rules.judge(counts)
            columns = [batch.column(key).cast(pa.int64()), *map(pa.array, counts.values()), pa.array(failed), pa.array(score), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS, "base_failed", "score", "kept"])

    return docs.select(key, text).mapInArrow(run, f"{STATS_SCHEMA}, base_failed boolean, score double, kept boolean")


def keep_good(docs: DataFrame, rules: Rules, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``assess`` would keep, with all their columns; nothing is shuffled."""
    def good(batches: Iterator) -> Iterator:
        import pandas as pd

        for texts in batches:
            yield pd.Series(rules.judge(counts_of(texts.tolist()))[2], dtype=bool)

    return docs.filter(F.pandas_udf(good, "boolean", F.PandasUDFType.SCALAR_ITER)(F.col(text)))
