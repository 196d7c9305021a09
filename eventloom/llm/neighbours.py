"""Approximate nearest neighbours by a forest of sorted hash strings.

Every vector has one hash string per tree. A symbol of a string is the largest coordinate, with its sign, after a random projection to
``axes`` dimensions, so a longer common prefix means a nearer vector. A tree is the sorted array of all strings. A query descends
in every tree to its longest prefix matches, then all trees ascend together, tree by tree and symbol by symbol, until
they hold enough candidates; all candidates are scored exactly. The arrays lie in cells (tree, first symbols of the string),
and only cells and queries that share a prefix meet. Tables of every size are answered this way; the root of a tree, which is
all rows, serves only the queries for which all trees together found fewer vectors than were asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store

ROOT = -1
BITS = 8  # of one symbol


class Forest(NamedTuple):
    """Parameters: trees, symbols in a string (at most seven), dimensions a symbol is read from (at most 128), and candidates to gather.

    The ascent ends at ``candidates`` (with repeats over the trees), or at ``share`` of all distinct vectors if that is more, so that
    recall does not fall as the table grows; it never goes above one symbol. ``chunk`` bounds
    the rows of a cell that one task holds at once; larger cells are split and meet the query in each part.
    """

    trees: int = 48
    symbols: int = 6
    axes: int = 32
    candidates: int = 24_000
    share: float = 0.5
    chunk: int = 8_192
    seed: int = 5

    def shift(self, length: int) -> int:
        """Bits below a prefix of so many symbols."""
        return BITS * (self.symbols - length)


@lru_cache(maxsize=4)
def projections(forest: Forest, width: int) -> np.ndarray:
    """One random matrix for each tree and symbol, side by side: 37 kB for each dimension of the vectors by default."""
    rng = np.random.default_rng([forest.seed, width])
    return rng.standard_normal((width, forest.trees * forest.symbols * forest.axes), dtype=np.float32)


def hash_strings(vectors: np.ndarray, forest: Forest) -> np.ndarray:
    """Hash string of each vector in each tree, ``BITS`` bits a symbol, as one integer."""
    n, width = vectors.shape
    turned = (vectors.astype(np.float32) @ projections(forest, width)).reshape(n, forest.trees, forest.symbols, forest.axes)
    axis = np.abs(turned).argmax(axis=3)
    sign = np.take_along_axis(turned, axis[..., None], axis=3)[..., 0] > 0
    symbols = (2 * axis + sign).astype(np.int64)
    out = np.zeros((n, forest.trees), np.int64)
    for k in range(forest.symbols):
        out = out << BITS | symbols[:, :, k]
    return out


def usable(vector: str) -> Column:
    """Vectors that take part: neither null, nor zero, nor with a null or non-finite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col(vector).isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def distinct_vectors(rows: DataFrame, top: int, forest: Forest, kind: str) -> DataFrame:
    """Stored table of distinct vectors: rep (smallest id), ids (the ``top`` + 1 smallest), asks (some row is a query), vec, hashes.

    A group of equal vectors needs no more ids than one answer can hold, so large groups shrink before they are shuffled.
    """
    mine = Window.partitionBy("k1", "k2").orderBy("id")
    first = rows.withColumn("place", F.row_number().over(mine)).filter(F.col("place") <= top + 1)
    ids = first.groupBy("k1", "k2").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.min_by("vec", "id").alias("vec"))
    asking = rows.filter("asks").select("k1", "k2").distinct().withColumn("asks", F.lit(True))
    grouped = ids.join(asking, ["k1", "k2"], "left").withColumn("asks", F.coalesce("asks", F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                vectors = batch.column(1)
                sizes = vectors.value_lengths().to_numpy()
                flat = vectors.flatten().to_numpy().astype(kind)
                ends = np.cumsum(sizes)
                hashes: list = [None] * batch.num_rows
                for width in np.unique(sizes):
                    rows_of = np.flatnonzero(sizes == width)
                    found = hash_strings(np.stack([flat[ends[r] - width : ends[r]] for r in rows_of]), forest)
                    for r, h in zip(rows_of, found):
                        hashes[r] = h
                packed = pa.array([flat[e - n : e].tobytes() for e, n in zip(ends, sizes)], pa.binary())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), batch.column(2), batch.column(3), batch.column(4), pa.array(sizes.astype(np.int32)), packed, pa.array(hashes, pa.list_(pa.int64())),
                ], names=["ids", "asks", "k1", "k2", "width", "vec", "hashes"])

    made = grouped.select("ids", "vec", "asks", "k1", "k2").mapInArrow(run, "ids array<bigint>, asks boolean, k1 bigint, k2 bigint, width int, vec binary, hashes array<bigint>")
    return store(made.select(F.element_at("ids", 1).alias("rep"), "k1", "k2", "ids", "asks", "width", "vec", "hashes"), "neighbour-vectors")


def search(rows: DataFrame, is_query: Column, top: int = 20, forest: Forest = Forest(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``top`` nearest other rows found for each query, by the inner product: query_id, rank, vec_id, score.

    Rows with an unusable vector or a null id take no part. Equal vectors are one entry of the forest and all
    get into the answers; of equal products the smaller id comes first. Rows repeated whole count once. Vectors of different length never meet. Fewer
    candidates than ``top`` give a shorter answer, an empty table none. Scores are sums of products in double precision.
    """
    taken = rows.filter(usable(vector) & F.col(key).isNotNull())
    single = taken.schema[vector].dataType.elementType.typeName() == "float"
    kept = F.col(vector) if single else F.transform(vector, lambda x: x.cast("double"))
    kind = "<f4" if single else "<f8"
    keyed = taken.select(F.col(key).cast("long").alias("id"), kept.alias("vec"), is_query.alias("asks"))
    keyed = keyed.withColumn("k1", F.xxhash64("vec")).withColumn("k2", F.xxhash64(F.lit(1), "vec")).dropDuplicates(["id", "k1", "k2"])
    vectors = distinct_vectors(keyed, top, forest, kind)
    total = vectors.count()
    depth = max(1, min(forest.symbols, round(log(max(total / (forest.chunk / 2), 1), 2 * forest.axes))))
    cells = store(_cells(vectors, forest, depth), "neighbour-cells")
    asked = store(_levels(vectors, cells, forest, depth), "neighbour-queries")
    found = store(_score(_deal(vectors, asked, cells, forest, depth), top, forest, kind), "neighbour-scores")
    enough = found.groupBy("query").agg(F.count_distinct("rep").alias("n")).filter(F.col("n") >= min(top + 1, total)).select(F.col("query").alias("rep"))
    short = store(asked.select("rep", "width", "vec").join(enough, "rep", "left_anti"), "neighbour-short")
    if not short.isEmpty():
        found = found.unionByName(_score(_deal_root(vectors, short, total, forest), top, forest, kind))
    return _answers(found, vectors, keyed, top)


def _strings(vectors: DataFrame, *more: str) -> DataFrame:
    return vectors.select("rep", *more, F.posexplode("hashes").alias("tree", "hash"))


def _prefix(value: str, forest: Forest, length: int) -> Column:
    return F.shiftright(value, forest.shift(length))


def _cells(vectors: DataFrame, forest: Forest, depth: int) -> DataFrame:
    """tree, cell, width, size, chunks: the cells of each tree."""
    cells = _strings(vectors, "width").groupBy("tree", "width", _prefix("hash", forest, depth).alias("cell")).agg(F.count("*").alias("size"))
    return cells.withColumn("chunks", F.ceil(F.col("size") / forest.chunk).cast("int"))


def _levels(vectors: DataFrame, cells: DataFrame, forest: Forest, depth: int) -> DataFrame:
    """rep, hashes, width, vec, levels of each query: the prefix length it uses in each tree.

    Matches of prefixes shorter than a cell's are sums of cell sizes; longer ones are counted in the cell's sorted strings.
    """
    strings = _strings(vectors, "asks", "width").withColumn("cell", _prefix("hash", forest, depth))
    per_cell = strings.join(cells.select("tree", "width", "cell", "chunks"), ["tree", "width", "cell"])
    index = per_cell.select("tree", "width", "cell", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int").alias("chunk"), F.lit(0).alias("kind"), "hash", "rep")
    queries = per_cell.filter("asks").select("tree", "width", "cell", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("kind"), "hash", "rep")
    key = ("tree", "width", "cell", "chunk")
    dealt = index.unionByName(queries).repartition(_partitions(vectors), *key).sortWithinPartitions(*key, "kind", "hash")
    lengths = list(range(depth, forest.symbols + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, len(key)):
            kind, hashes, reps = (np.concatenate([b.column(i).to_numpy() for b in group]) for i in (4, 5, 6))
            array, asked = hashes[kind == 0], hashes[kind == 1]
            if not len(asked):
                continue
            counts = []
            for length in lengths:
                low, high = _range(array, asked, forest.shift(length))
                counts.append(high - low)
            trees = np.full(len(asked), group[0].column(0)[0].as_py(), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(reps[kind == 1]), pa.array(trees), pa.array(list(np.stack(counts, axis=1)), pa.list_(pa.int64()))], names=["rep", "tree", "counts"])

    deep = dealt.mapInArrow(run, "rep long, tree int, counts array<bigint>").groupBy("rep", "tree").agg(*[F.sum(F.col("counts")[i]).alias(f"c{n}") for i, n in enumerate(lengths)])
    for length in range(1, depth):
        short = cells.groupBy("tree", "width", F.shiftright("cell", BITS * (depth - length)).alias("above")).agg(F.sum("size").alias(f"c{length}"))
        mine = _strings(vectors.filter("asks"), "width").select("rep", "tree", "width", _prefix("hash", forest, length).alias("above"))
        deep = deep.join(mine.join(short, ["tree", "width", "above"]).select("rep", "tree", f"c{length}"), ["rep", "tree"])
    every = F.sort_array(F.collect_list(F.struct("tree", *[f"c{n}" for n in range(1, forest.symbols + 1)])))
    gathered = deep.groupBy("rep").agg(every.alias("counts"))

    totals = {r.width: r.total for r in cells.filter("tree = 0").groupBy("width").agg(F.sum("size").alias("total")).collect()}  # one entry for each vector length

    @F.pandas_udf("array<int>")
    def levels(counts, widths):
        import pandas as pd

        return pd.Series([
            ascend(np.array([[t[f"c{n}"] for n in range(1, forest.symbols + 1)] for t in trees]), forest, totals[width]).tolist() for trees, width in zip(counts, widths)
        ])

    chosen = vectors.filter("asks").join(gathered.withColumnRenamed("rep", "__rep"), F.col("rep") == F.col("__rep"))
    return chosen.select("rep", "width", "vec", "hashes", levels("counts", "width").alias("levels"))


def ascend(counts: np.ndarray, forest: Forest, total: int = 0) -> np.ndarray:
    """Prefix length for each tree, from its matches (one column for each length, shortest first) among ``total`` vectors."""
    trees, symbols = counts.shape
    steps = np.concatenate([[counts[:, -1].sum()]] + [counts[:, n - 1] - counts[:, n] for n in range(symbols - 1, 0, -1)])
    done = int(np.searchsorted(np.cumsum(steps), max(forest.candidates, forest.share * total)))  # single ascents until there are enough
    done = min(done, trees * (symbols - 1))
    return symbols - (done // trees + (np.arange(trees) < done % trees))


def _range(array: np.ndarray, asked: np.ndarray, shift: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the strings that share a query's prefix begin and end in a sorted array."""
    return np.searchsorted(array, asked >> shift << shift), np.searchsorted(array, ((asked >> shift) + 1) << shift)


def _partitions(vectors: DataFrame) -> int:
    return max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), vectors.sparkSession.sparkContext.defaultParallelism)


def _deal(vectors: DataFrame, asked: DataFrame, cells: DataFrame, forest: Forest, depth: int) -> DataFrame:
    """Index rows and queries of every cell chunk, sorted by string."""
    strings = _strings(vectors, "width", "vec").withColumn("cell", _prefix("hash", forest, depth))
    chunks = cells.select("tree", "width", "cell", "chunks")
    index = strings.join(chunks, ["tree", "width", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    both = F.arrays_zip("hashes", "levels")
    queries = asked.select("rep", "width", "vec", F.posexplode(both).alias("tree", "own")).select("rep", "width", "vec", "tree", F.col("own.hashes").alias("hash"), F.col("own.levels").alias("level"))
    at = [queries.filter(F.col("level") >= depth).withColumn("cell", _prefix("hash", forest, depth)).join(chunks, ["tree", "width", "cell"])]
    for length in range(1, depth):  # a prefix shorter than the cells' own: all cells below it
        below = chunks.withColumn("above", F.shiftright("cell", BITS * (depth - length)))
        at.append(queries.filter(F.col("level") == length).withColumn("above", _prefix("hash", forest, length)).join(below, ["tree", "width", "above"]).drop("above"))
    asking = at[0]
    for more in at[1:]:
        asking = asking.unionByName(more)
    asking = asking.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = index.withColumn("kind", F.lit(0)).withColumn("level", F.lit(0)).unionByName(asking.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return _sorted_chunks(dealt, vectors)


def _deal_root(vectors: DataFrame, short: DataFrame, total: int, forest: Forest) -> DataFrame:
    """All rows in chunks, each with the queries that the trees left short."""
    parts = int(np.ceil(total / forest.chunk))
    common = {"tree": F.lit(ROOT), "cell": F.lit(0).cast("long"), "hash": F.lit(0).cast("long"), "level": F.lit(0)}
    everything = vectors.select("rep", "width", "vec").withColumns(common).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.lit(parts)).cast("int")).withColumn("kind", F.lit(0))
    asking = short.select("rep", "width", "vec").withColumns(common).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("kind", F.lit(1))
    return _sorted_chunks(everything.unionByName(asking), vectors)


def _sorted_chunks(dealt: DataFrame, vectors: DataFrame) -> DataFrame:
    key = ("tree", "width", "cell", "chunk")
    return dealt.select(*key, "kind", "hash", "rep", "level", "vec").repartition(_partitions(vectors), *key).sortWithinPartitions(*key, "kind", "hash")


def _groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list[pa.RecordBatch]]:
    """Record batches of rows that agree in the first ``width`` columns, which the input is sorted by."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy() for i in range(width)], axis=1)
        edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows]):
            if last is not None and tuple(keys[a]) != last:
                yield held
                held = []
            last = tuple(keys[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield held


def _score(dealt: DataFrame, top: int, forest: Forest, kind: str, block: int = 512) -> DataFrame:
    """query, candidate, score: the best of each chunk for each of its queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 4):
            parts = [np.concatenate([b.column(i).to_numpy() for b in group]) for i in (4, 5, 6, 7)]
            side, hashes, reps, levels = parts
            asked = side == 1
            if not asked.any() or asked.all():
                continue
            width = group[0].column(1)[0].as_py()
            matrix = np.frombuffer(b"".join(x for b in group for x in b.column(8).to_pylist()), kind).reshape(-1, width).astype(np.float64)
            rows, own, array = matrix[~asked], reps[~asked], hashes[~asked]
            low, high = np.zeros(asked.sum(), np.int64), np.full(asked.sum(), len(rows))
            for level in np.unique(levels[asked]):
                at = levels[asked] == level
                if level > 0:
                    low[at], high[at] = _range(array, hashes[asked][at], forest.shift(int(level)))
            queries, ids = matrix[asked], reps[asked]
            out_q, out_c, out_s = [], [], []
            for begin in range(0, len(queries), block):
                for k in range(begin, min(begin + block, len(queries))):
                    a, b = low[k], high[k]
                    if a == b:
                        continue
                    scores = rows[a:b] @ queries[k]
                    keep = np.arange(b - a)
                    if b - a > top + 1:
                        least = np.partition(scores, b - a - top - 1)[b - a - top - 1]
                        keep = np.flatnonzero(scores >= least)
                        keep = keep[np.lexsort((own[a:b][keep], -scores[keep]))[: top + 1]]
                    out_q.append(np.full(len(keep), ids[k]))
                    out_c.append(own[a:b][keep])
                    out_s.append(scores[keep])
                if out_q:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_q, out_c, out_s)], names=["query", "rep", "score"])
                    out_q, out_c, out_s = [], [], []

    return dealt.mapInArrow(run, "query long, rep long, score double")


def _answers(found: DataFrame, vectors: DataFrame, keyed: DataFrame, top: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "rep")
    pairs = found.groupBy("query", "rep").agg(F.max("score").alias("score")).withColumn("place", F.row_number().over(best)).filter(F.col("place") <= top + 1)
    ids = vectors.select("rep", "ids")
    each = pairs.join(ids, "rep").select("query", "score", F.explode("ids").alias("id"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "id")))
    lists = each.groupBy("query").agg(F.slice(order, 1, top + 1).alias("near"))
    keys = vectors.filter("asks").select(F.col("rep").alias("query"), "k1", "k2")
    joined = keyed.filter("asks").select("id", "k1", "k2").join(lists.join(keys, "query"), ["k1", "k2"])
    mine = joined.select(F.col("id").alias("query_id"), F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, top).alias("near"))
    return mine.select("query_id", F.posexplode("near").alias("place", "x")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.far")).alias("score"),
    )
