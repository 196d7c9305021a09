"""Token ids in coded files: frequency-ranked ids, byte-aligned variable length, control bytes apart.

A coded folder holds two Parquet tables. ``vocab`` has one row (id, rank) for each id that occurs; rank 0 is the most frequent id.
``blocks`` has one row for each block of whole documents, in ascending key order inside a part and over the parts:
part, block, start (ids before it in its part), n_tokens, doc_ids, counts (ids of each document), control, data.
``control`` has two bits for each id (its byte count less one, four ids in a byte, lowest bits first),
``data`` the ranks as little-endian integers of one to four bytes.
Parquet is the container, because Spark then commits the files, also in stores that only Spark reaches.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.session import shared_path

from .common import lookup, part_bases, small_enough
from .tokens import END_ID, id_type, token_table

BLOCK_IDS = 1 << 16
BLOCK_SCHEMA = "part long, block long, start long, n_tokens long, doc_ids array<bigint>, counts array<bigint>, control binary, data binary"
DECODED_SCHEMA = "doc_id long, start long, n_tokens long, ids binary"

LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
"""Bytes of the four ids of each control byte."""
OFFSETS = np.concatenate([np.zeros((256, 1), np.int64), np.cumsum(LENGTHS, axis=1)], axis=1)
"""Where the four ids begin behind each control byte, and the bytes of all four."""
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)



class Coded(NamedTuple):
    """A coded folder and the session that reads it."""

    spark: SparkSession
    path: str


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of some ranks."""
    ranks = ranks.astype("<u4")
    sizes = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = sizes - 1
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    kept = np.arange(4) < sizes[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[kept].tobytes()


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ranks again: both tables are looked up by control byte, then four data bytes are read and masked at each place."""
    codes = np.frombuffer(control, np.uint8)
    begins = np.cumsum(OFFSETS[codes, 4]) - OFFSETS[codes, 4]
    at = (begins[:, None] + OFFSETS[codes, :4]).reshape(-1)[:n]
    raw = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    words = raw[:-3] | raw[1:-2] << 8 | raw[2:-1] << 16 | raw[3:] << 24
    return words[at] & MASKS[LENGTHS[codes].reshape(-1)[:n]]


def id_counts(tokens: DataFrame, kind: str) -> DataFrame:
    """id, n over the whole token table; a task sends each id once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                own = np.frombuffer(ids.as_py(), kind)
                more = np.bincount(own, minlength=len(counts))
                more[: len(counts)] += counts
                counts = more
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(counts[found])], names=["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def clustered(tokens: DataFrame) -> bool:
    """Whether the parts of a token table hold key ranges that do not overlap, each in ascending order."""
    own = Window.partitionBy("part").orderBy("seq")
    steps = tokens.select("part", "seq", "doc_id").withColumn("before", F.lag("doc_id").over(own))
    order = "sum(case when doc_id is null or before > doc_id then 1 else 0 end)"
    parts = steps.groupBy("part").agg(F.expr(order).alias("bad"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    lined = parts.withColumn("before", F.lag("high").over(Window.orderBy("low", "high")))
    return lined.filter("bad > 0 or before >= low").isEmpty()


def write_coded(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", end_id: int | None = END_ID, partitions: int | None = None) -> Coded:
    """Encode every document and write a coded folder below the shared folder, in ascending key order.

    Documents that already lie in key order, part by part, are not shuffled; others are dealt by ranges of the key. A null text is
    empty (only its end id), null keys come first, repeated keys stay and are ordered by their ids,
    an empty table gives empty files. Other columns are not read.
    """
    spark, kind = docs.sparkSession, id_type(tokenizer)
    tokens = token_table(docs.select(key, text).sortWithinPartitions(key), tokenizer, text, key, end_id, name="binary-tokens")
    path = shared_path(spark, "coded-ids")
    # one row for each id of the vocabulary at most, whatever the input
    counted = sorted(((-n, i) for i, n in id_counts(tokens, kind).collect()))
    vocabulary = [i for _, i in counted]
    ranks = np.zeros(max(vocabulary, default=0) + 1, np.uint32)
    ranks[vocabulary] = np.arange(len(vocabulary))
    spark.createDataFrame([(i, int(ranks[i])) for i in vocabulary], "id int, rank int").coalesce(1).write.parquet(f"{path}/vocab")
    if clustered(tokens):
        parts = tokens.groupBy("part").agg(F.min("doc_id").alias("low"))
        named = parts.select("part", (F.row_number().over(Window.orderBy("low", "part")) - 1).cast("long").alias("rank"))
        if small_enough(named):  # rows keep the order of their stored part
            placed = tokens.join(F.broadcast(named), "part")
        else:  # dealt by part: put back into its order
            placed = tokens.join(named, "part").repartition("part").sortWithinPartitions("part", "seq")
        rows = placed.select(F.col("rank").alias("part"), "start", "doc_id", "ids")
    else:
        n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
        rows = tokens.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "ids").select(F.lit(None).cast("long").alias("part"), F.lit(None).cast("long").alias("start"), "doc_id", "ids")
    held = spark.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, block, task = held.value, 0, TaskContext.get().partitionId()
        part, start, waiting, size, at = None, 0, [], 0, 0
        for batch in batches:
            for own, begins, doc, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if waiting and (own != part or size >= BLOCK_IDS):
                    yield _block(task if part is None else part, block, start, waiting, ranks)
                    start, waiting, size, block = start + size, [], 0, block + 1
                if not waiting:
                    part, start = own, start if begins is None else begins
                one = np.frombuffer(ids, kind)
                waiting.append((doc, one))
                size += len(one)
        if waiting:
            yield _block(task if part is None else part, block, start, waiting, ranks)

    rows.mapInArrow(run, BLOCK_SCHEMA).write.option("compression", "zstd").parquet(f"{path}/blocks")
    return Coded(spark, path)


def _block(part: int, block: int, start: int, docs: list[tuple[int | None, np.ndarray]], ranks: np.ndarray) -> pa.RecordBatch:
    ids = np.concatenate([one for _, one in docs])
    control, data = pack_ranks(ranks[ids])
    return pa.RecordBatch.from_pylist([{
        "part": part, "block": block, "start": start, "n_tokens": len(ids), "doc_ids": [d for d, _ in docs],
        "counts": [len(one) for _, one in docs], "control": control, "data": data,
    }], schema=pa.schema([
        ("part", pa.int64()), ("block", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary()),
    ]))


def read_coded(coded: Coded) -> DataFrame:
    """Documents of a coded folder: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    spark = coded.spark
    vocabulary = spark.read.parquet(f"{coded.path}/vocab").orderBy("rank").collect()  # at most the tokenizer's vocabulary
    held = spark.sparkContext.broadcast(np.array([r["id"] for r in vocabulary], "<u4"))
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{coded.path}/blocks")
    bases = part_bases(blocks.groupBy("part").agg(F.sum("n_tokens").alias("total")), [F.col("part")]).select("part", "base")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = held.value
        for batch in batches:
            for start, docs, counts, control, data in zip(*(batch.column(i) for i in range(5))):
                n = counts.values.to_numpy()
                ids = ids_of[unpack_ranks(control.as_py(), data.as_py(), int(n.sum()))]
                bounds = np.concatenate([[0], np.cumsum(n)])
                raw = ids.tobytes()
                yield pa.RecordBatch.from_arrays([
                    docs.values, pa.array(start.as_py() + bounds[:-1]), pa.array(n),
                    pa.array([raw[4 * a : 4 * b] for a, b in zip(bounds.tolist(), bounds[1:].tolist())], pa.binary()),
                ], names=["doc_id", "start", "n_tokens", "ids"])

    placed = blocks.join(lookup(bases), "part").select((F.col("base") + F.col("start")).alias("start"), "doc_ids", "counts", "control", "data")
    return placed.mapInArrow(run, DECODED_SCHEMA)
