"""Hard negatives by coordinate pruning in length buckets.

Rows are dealt to buckets of similar vector length. In a bucket every coordinate has a sorted list of its values in the unit
vectors. For an anchor and the least score that still counts, the angle between a row and the anchor is bounded, and with it the
values that the row can have in the coordinates where the anchor is largest (its focus). Only rows whose values lie in the ranges of
all focus coordinates are scored, in whole numbers. An anchor first visits its own bucket, whose answers give the least
score for the others; buckets whose vectors are too short for it are not visited at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup, store

SLACK = 1e-7
"""Widening of value ranges, far above the rounding of angles."""
EXACT = 2.0**53
"""Sums of whole numbers below this are exact in double precision, in any order."""


class Pruning(NamedTuple):
    """Focus coordinates of an anchor; rows and bytes of vectors that a bucket holds at most, and rows it should hold at least."""

    focus: int = 6
    rows: int = 65_536
    bucket_bytes: int = 1 << 25
    fewest: int = 1_024


class Mining(NamedTuple):
    """Positives of an anchor, negatives of a pair, and the band of negative scores in percent of the positive score."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90


class Bucket:
    """Vectors of one length class: whole-number rows, unit vectors, and sorted lists of the coordinates asked for."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels = ids, labels
        lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        order = np.argsort(-lengths, kind="stable")
        self.ids, self.labels, self.whole, self.lengths = ids[order], labels[order], vectors[order], lengths[order]
        self.vectors = self.whole.astype(np.float64)
        self.units = self.vectors / np.where(self.lengths > 0, self.lengths, 1)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        """Values of a coordinate in ascending order, and the rows that have them."""
        if coordinate not in self.lists:
            order = np.argsort(self.units[:, coordinate], kind="stable")
            self.lists[coordinate] = self.units[order, coordinate], order
        return self.lists[coordinate]

    def candidates(self, anchor: np.ndarray, least: float, focus: int) -> np.ndarray:
        """Rows whose score with the anchor can reach ``least``; every row that reaches it is among them."""
        everything = np.arange(len(self.ids))
        if not least > 0 or not len(everything):
            return everything
        length = float(np.sqrt((anchor**2).sum()))
        reach = length * self.lengths[0]
        if reach * (1 + SLACK) < least:
            return everything[:0]
        long_enough = int(np.searchsorted(-self.lengths, -(least / length) * (1 - SLACK), side="right"))
        apart = np.arccos(min(1.0, least / reach))
        unit = anchor / length
        ranges = []
        for f in np.argsort(-np.abs(unit))[:focus].tolist():
            at = np.arccos(np.clip(unit[f], -1, 1))
            low, high = np.cos(min(np.pi, at + apart)) - SLACK, np.cos(max(0.0, at - apart)) + SLACK
            values, _ = self.sorted_list(f)
            begin, end = np.searchsorted(values, low), np.searchsorted(values, high, side="right")
            ranges.append((int(end - begin), int(begin), int(end), f, low, high))
        ranges.sort()
        size, begin, end, first, _, _ = ranges[0]
        found = self.sorted_list(first)[1][begin:end]
        found = found[found < long_enough]
        for size, _, _, f, low, high in ranges[1:]:
            if size < len(self.ids):
                values = self.units[found, f]
                found = found[(values >= low) & (values <= high)]
        return found

    def scores(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact inner products in whole numbers."""
        bound = float(np.sqrt((anchor.astype(np.float64) ** 2).sum())) * (self.lengths[0] if len(self.lengths) else 0.0)
        if bound < EXACT:
            dense = 2 * len(rows) > len(self.ids)
            return (self.vectors @ anchor.astype(np.float64))[rows].astype(np.int64) if dense else (self.vectors[rows] @ anchor.astype(np.float64)).astype(np.int64)
        if bound >= 2.0**62:
            raise ValueError("inner products do not fit 64 bits")
        return self.whole[rows] @ anchor

    def best(self, anchor_id: int, label: int, anchor: np.ndarray, same: bool, wanted: list[tuple[int, int, int]], top: int, focus: int) -> list[np.ndarray]:
        """For each (lowest, highest, least) in ``wanted``: the first ``top`` rows by score and id, of the anchor's label or of
        others, that score within [max(lowest, least), highest]; two columns id and score."""
        floor = min((max(low, least) for low, _, least in wanted), default=1)
        rows = self.candidates(anchor.astype(np.float64), float(floor), focus)
        rows = rows[(self.labels[rows] == label) == same]
        rows = rows[self.ids[rows] != anchor_id]
        scores, ids = self.scores(anchor, rows), self.ids[rows]
        out = []
        for low, high, least in wanted:
            fits = np.flatnonzero((scores >= max(low, least)) & (scores <= high))
            if len(fits) > top:
                edge = np.partition(scores[fits], len(fits) - top)[len(fits) - top]
                fits = fits[scores[fits] >= edge]
            fits = fits[np.lexsort((ids[fits], -scores[fits]))[:top]]
            out.append(np.stack([ids[fits], scores[fits]], axis=1))
        return out


LOWEST, HIGHEST = -(2**62), 2**62


def prepared(rows: DataFrame, is_anchor: Column, label: Column, key: str, vector: str, scale: int) -> DataFrame:
    """id, label, asks, vec (whole numbers), size2 (squared length) of the rows that take part, one for each id."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    taken = rows.filter(F.col(vector).isNotNull() & fine & F.col(key).isNotNull())
    taken = taken.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), is_anchor.alias("asks"), whole.alias("vec")).filter("label is not null")
    one = taken.groupBy("id").agg(F.min(F.struct("label", "vec", F.coalesce("asks", F.lit(False)).alias("asks"))).alias("row")).select("id", "row.*")
    return one.withColumn("size2", F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def mine(
    rows: DataFrame, is_anchor: Column, label: Column | None = None, key: str = "vec_id", vector: str = "embedding", scale: int = 256,
    mining: Mining = Mining(), pruning: Pruning = Pruning(),
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A component x becomes floor(scale * x). An anchor's positives are the first rows of its own label by inner product, then by smaller
    id; the negatives of a pair are the first rows of another label whose score lies in the band
    low <= 100 * score / positive score <= high. Rows with a null id, label or vector or with a null or non-finite component take no part; of
    rows with one id the one with the smallest label, then vector, does. A vector of zeros scores 0; a negative positive score has an
    empty band. Vectors of different length never meet. Anchors without positives, pairs without
    negatives and empty tables give no rows; other columns are not read.
    """
    label = F.col("label") if label is None else label
    taken = store(prepared(rows, is_anchor, label, key, vector, scale), "mining-rows")
    facts = taken.agg(F.count("*"), F.max(F.size("vec"))).first()
    count, width = facts[0], max(facts[1] or 1, 1)
    most = max(1, min(pruning.rows, pruning.bucket_bytes // (8 * width)))
    spark = taken.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    buckets = max(1, -(-count // most), min(parts, count // pruning.fewest))
    by_length = taken.repartitionByRange(buckets, F.col("size2").desc(), "id")
    bucketed = store(_first_visit(by_length, mining, pruning), "mining-buckets")
    shapes = lookup(bucketed.groupBy("bucket").agg(F.max("size2").alias("longest2")))
    anchors = bucketed.filter("asks").drop("asks")
    own = anchors.select(F.col("id").alias("anchor"), F.explode("near").alias("x")).select("anchor", "x.*")
    least = F.when(F.size("near") >= mining.positives, F.element_at("near", -1)["score"])
    more = _visit(bucketed, _elsewhere(anchors.withColumn("wanted", F.array(_bounds(F.lit(LOWEST), F.lit(HIGHEST), least))), shapes), True, mining.positives, pruning)
    ranked = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id")
    pairs = own.unionByName(more.drop("place")).withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= mining.positives)
    positives = store(pairs.select("anchor", F.col("id").alias("positive"), F.col("score").alias("p")), "mining-positives")

    lists = positives.filter("p >= 0").groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("positive", "p"))).alias("pairs"))  # at most `positives` entries
    asking = anchors.join(lists, F.col("id") == F.col("anchor")).drop("anchor", "near")
    wanted = F.expr(f"transform(pairs, x -> named_struct('low', ({mining.low} * x.p + 99) div 100, 'high', {mining.high} * x.p div 100, 'least', {LOWEST}L))")
    asking = store(asking.withColumn("wanted", wanted), "mining-pairs")
    at_home = store(_visit(bucketed, asking.withColumn("to", F.col("bucket")), False, mining.negatives, pruning), "mining-own-bucket")
    full = at_home.groupBy("anchor", "place").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") >= mining.negatives)
    known = full.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("place", "least"))).alias("known"))  # at most `positives` entries
    raised = asking.join(known, F.col("id") == F.col("anchor"), "left").withColumn(
        "wanted", F.transform("wanted", lambda x, i: _bounds(x["low"], x["high"], F.element_at("known", i.cast("int"))))).drop("anchor", "known")
    others = _visit(bucketed, _elsewhere(raised, shapes), False, mining.negatives, pruning)
    ranked = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), "id")
    found = at_home.unionByName(others).withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= mining.negatives)
    named = asking.select("id", "pairs")
    return found.join(named, F.col("anchor") == named["id"]).select(
        F.col("anchor").alias("anchor_id"), F.col("pairs")[F.col("place")]["positive"].alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        found["id"].alias("negative_id"), F.col("pairs")[F.col("place")]["p"].alias("positive_score"), F.col("score").alias("negative_score"),
    )


def _bounds(low: Column, high: Column, least: Column) -> Column:
    return F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"), F.coalesce(least.cast("long"), F.lit(LOWEST)).alias("least"))


def _matrix(batches: list[pa.RecordBatch], column: str, width: int) -> np.ndarray:
    return np.concatenate([b.column(column).flatten().to_numpy() for b in batches]).reshape(-1, width) if width else np.zeros((sum(b.num_rows for b in batches), 0), np.int64)


def _widths(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("vec").value_lengths().to_numpy()


def _bucket_of(batches: list[pa.RecordBatch], width: int) -> Bucket:
    ids, labels = (np.concatenate([b.column(c).to_numpy() for b in batches]) for c in ("id", "label"))
    return Bucket(ids, labels, _matrix(batches, "vec", width))


NEAR = pa.list_(pa.struct([("id", pa.int64()), ("score", pa.int64())]))


def _first_visit(by_length: DataFrame, mining: Mining, pruning: Pruning) -> DataFrame:
    """Rows with the number of their bucket (their partition), and for anchors the first rows of their label in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), [b for b in batches if b.num_rows]
        by_width: dict[int, list[pa.RecordBatch]] = {}
        for batch in held:
            for width in np.unique(sizes := _widths(batch)).tolist():
                by_width.setdefault(width, []).append(batch.filter(pa.array(sizes == width)))
        for width, group in by_width.items():
            bucket = _bucket_of(group, width)
            for batch in group:
                near: list = [None] * batch.num_rows
                vectors = _matrix([batch], "vec", width)
                for k in np.flatnonzero(batch.column("asks").to_numpy(zero_copy_only=False)).tolist():
                    found = bucket.best(batch.column("id")[k].as_py(), batch.column("label")[k].as_py(), vectors[k], True, [(LOWEST, HIGHEST, LOWEST)], mining.positives, pruning.focus)[0]
                    near[k] = [{"id": i, "score": s} for i, s in found.tolist()]
                columns = [pa.array(np.full(batch.num_rows, part, np.int32)), *batch.columns, pa.array(near, NEAR)]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", *batch.schema.names, "near"])

    schema = "bucket int, id long, label long, asks boolean, vec array<bigint>, size2 double, near array<struct<id: bigint, score: bigint>>"
    return by_length.select("id", "label", "asks", "vec", "size2").mapInArrow(run, schema)


def _elsewhere(anchors: DataFrame, shapes: DataFrame) -> DataFrame:
    """One row for each anchor and each other bucket (``to``) whose longest vector can reach the anchor's least score."""
    last = shapes.agg(F.coalesce(F.max("bucket"), F.lit(0))).first()[0]
    each = anchors.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(last)))).filter("`to` != bucket")
    floor = F.array_min(F.transform("wanted", lambda x: F.greatest(x["low"], x["least"]))).cast("double")
    return each.join(shapes.withColumnRenamed("bucket", "to"), "to").filter((floor <= 0) | (floor * (1 - SLACK) <= F.sqrt(F.col("size2") * F.col("longest2")))).drop("longest2")


def _visit(bucketed: DataFrame, asking: DataFrame, same: bool, top: int, pruning: Pruning) -> DataFrame:
    """anchor, place (in ``wanted``), id, score: the first rows of each visited bucket for each asking anchor."""
    spark = bucketed.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    nothing = F.lit(None).cast("array<struct<low: bigint, high: bigint, least: bigint>>")
    index = bucketed.select("bucket", F.size("vec").alias("width"), F.lit(0).alias("kind"), "id", "label", "vec", nothing.alias("wanted"))
    asks = asking.select(F.col("to").alias("bucket"), F.size("vec").alias("width"), F.lit(1).alias("kind"), "id", "label", "vec", "wanted")
    dealt = index.unionByName(asks).repartition(parts, "bucket", "width").sortWithinPartitions("bucket", "width", "kind", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, bucket, held = None, None, []
        for batch in batches:
            for begin, end in _runs(batch):
                piece = batch.slice(begin, end - begin)
                group = piece.column("bucket")[0].as_py(), piece.column("width")[0].as_py()
                if group != key:
                    key, bucket, held = group, None, []
                if piece.column("kind")[0].as_py() == 0:
                    held.append(piece)
                    continue
                if not held and bucket is None:
                    continue
                if bucket is None:
                    bucket, held = _bucket_of(held, group[1]), []
                yield from _answers(bucket, piece, group[1], same, top, pruning)

    return dealt.mapInArrow(run, "anchor long, place int, id long, score long")


def _runs(batch: pa.RecordBatch) -> list[tuple[int, int]]:
    """Stretches of rows of one bucket, width and kind."""
    if not batch.num_rows:
        return []
    keys = np.stack([batch.column(c).to_numpy() for c in ("bucket", "width", "kind")], axis=1)
    edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
    return list(zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]))


def _answers(bucket: Bucket, asks: pa.RecordBatch, width: int, same: bool, top: int, pruning: Pruning) -> Iterator[pa.RecordBatch]:
    anchors, places, found = [], [], []
    vectors = _matrix([asks], "vec", width)
    for k, (anchor, label, wanted) in enumerate(zip(asks.column("id").to_pylist(), asks.column("label").to_pylist(), asks.column("wanted").to_pylist())):
        bounds = [(w["low"], w["high"], w["least"]) for w in wanted]
        for place, rows in enumerate(bucket.best(anchor, label, vectors[k], same, bounds, top, pruning.focus)):
            anchors.append(np.full(len(rows), anchor))
            places.append(np.full(len(rows), place, np.int32))
            found.append(rows)
    if found:
        rows = np.concatenate(found)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate(anchors)), pa.array(np.concatenate(places)), pa.array(np.ascontiguousarray(rows[:, 0])), pa.array(np.ascontiguousarray(rows[:, 1])),
        ], names=["anchor", "place", "id", "score"])
