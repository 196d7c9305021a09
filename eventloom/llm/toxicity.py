"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_slices

TOKEN = re.compile(r"\w+")
BITS = 20
GRAMS = ((1, 0x9E3779B1), (2, 0x85EBCA6B), (3, 0xC2B2AE35))
"""Pairs of words at these distances: bigrams, and skip-grams over one and two words, each with a hash factor."""
SAMPLE_ROWS = 24_000
"""Labelled documents that the weights are fitted on at most, chosen by a hash of their id."""


class Ftrl(NamedTuple):
    """Learning rate, its offset, L1, L2 and passes; shards are models fitted side by side, whose weights are averaged."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.0
    passes: int = 4
    shards: int = 2


class Words(dict):
    """Hash of each word seen; starts again when it has a million."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 1_000_000:
            self.clear()
        code = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return code


def grams(text: str, words: Words) -> np.ndarray:
    """Hashed features of a whole text, repeats included: words, bigrams and skip-grams of the lower-cased text."""
    found = TOKEN.findall(text.lower())
    codes = np.fromiter(map(words.__getitem__, found), np.uint32, len(found))
    mixed = codes * np.uint32(0x27D4EB2F)
    pairs = [(codes[:-gap] * np.uint32(factor)) ^ (mixed[gap:] + np.uint32(gap)) for gap, factor in GRAMS if len(codes) > gap]
    every = np.concatenate([mixed, *pairs]) if pairs else mixed
    return (every ^ every >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - BITS)


def fit(kept: list[tuple[np.ndarray, int]], options: Ftrl) -> tuple[np.ndarray, float]:
    """Weights and bias after some passes over rows of (distinct features, label).

    Each coordinate has its own rate; those whose sum of gradients stays within L1 are exactly 0.
    """
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_n = bias = 0.0

    def weights(at) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - options.l1, 0.0)
        return -shrunk / ((options.beta + np.sqrt(n[at])) / options.alpha + options.l2)

    for at, label in kept * options.passes:
        w = weights(at)
        p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -30, 30)))
        g = p - label
        step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / options.alpha
        z[at] += g - step * w
        n[at] += g * g
        rate = (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / options.alpha
        bias_z, bias_n = bias_z + g - rate * bias, bias_n + g * g
        bias = -bias_z / ((options.beta + np.sqrt(bias_n)) / options.alpha)
    return weights(slice(None)), bias


def train(docs: DataFrame, labels: DataFrame, chosen: Column, label: str = "toxic", text: str = "text", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS, options: Ftrl = Ftrl()) -> tuple[np.ndarray, np.ndarray, float]:
    """Indices and values of the weights that are not 0, and the bias.

    Fits on at most ``sample_rows`` labelled documents among those that ``chosen`` (a condition on ``doc_id``) admits, the
    smallest hashes of the id first. Null labels and labels without a document take no part; without any label all scores are 0.5.
    Only the sampled texts are shuffled; the driver gets at most 2^20 weights of each of a fixed number of shards.
    """
    known = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).dropna().filter(chosen)
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows)
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), "doc_id")
    shard = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(options.shards)).cast("int")
    dealt = own.withColumn("shard", shard).repartition(options.shards, F.get(F.lit(partition_keys(docs.sparkSession, options.shards)), "shard"))
    dealt = dealt.sortWithinPartitions("shard", F.xxhash64("doc_id"), "doc_id", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, int]]] = {}
        words = Words()
        for batch in text_slices(batches, "text"):  # only features are kept, 4 bytes each, not texts
            for body, mark, group in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3))):
                held.setdefault(group, []).append((np.unique(grams(body or "", words)).astype(np.int32), mark))
        for group in held:
            weights, bias = fit(held[group], options)
            at = np.flatnonzero(weights)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(weights[at], bias))], names=["at", "weight"])

    found = dealt.select("doc_id", "text", "label", "shard").mapInArrow(run, "at long, weight double").toPandas()
    shards = max(int((found["at"] == -1).sum()), 1)
    mean = found.groupby("at")["weight"].sum() / shards
    bias = float(mean.get(-1, 0.0))
    mean = mean[mean.index >= 0]
    return mean.index.to_numpy(np.int64), mean.to_numpy(np.float64), bias


def partition_keys(spark: SparkSession, n: int) -> list[int]:
    """For each of n partitions a number that a hash exchange of n partitions deals there, so that no two shards share a task."""
    dealt = spark.range(32 * n + 32).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("to")).groupBy("to").agg(F.min("id").alias("key"))
    return [row.key for row in dealt.orderBy("to").collect()]  # n rows


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id and score (chance of label 1) of every whole text. A null text is empty: only the bias counts; other columns are not read."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, bias = held.value
        table, words = np.zeros(1 << BITS), Words()
        table[at] = values
        for batch in text_slices(batches, text):
            sums = np.empty(batch.num_rows)
            for i, body in enumerate(batch.column(text).to_pylist()):
                hits = grams(body or "", words)
                hits = np.unique(hits[table[hits] != 0])  # each feature counts once
                sums[i] = table[hits].sum() + bias
            yield pa.RecordBatch.from_arrays([batch.column(key).cast(pa.int64()), pa.array(1 / (1 + np.exp(-np.clip(sums, -30, 30))))], names=["doc_id", "score"])

    return docs.select(key, text).mapInArrow(run, "doc_id long, score double")
