"""Concatenate and cut: documents in a row, cut into windows of a fixed number of ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_array, lookup, part_bases
from .tokens import END_ID, id_type, token_table

WINDOW = 2048
PIECE_SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
FRAGMENT_SCHEMA = "sequence_id long, offset long, whole boolean, ids binary"


def with_positions(tokens: DataFrame) -> DataFrame:
    """Token table with ``position``: ids of all documents before, over all parts.

    First pass: ids of each part (one row per part). Second pass: their running totals meet the rows again;
    a join on the part number, so nothing is shuffled while the parts (one per input split) are few enough to be sent to every task.
    """
    parts = tokens.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    bases = part_bases(parts, [F.col("part")]).select("part", "base")
    return tokens.join(lookup(bases), "part").withColumn("position", F.col("base") + F.col("start"))


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int | None = END_ID, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Pieces of documents in gapless windows of ``window`` ids; only the last window is short.

    Returns doc_id, start (ids of its document before the piece), length, doc_tokens, sequence_id, offset (place in the
    window), ids (little-endian unsigned 32-bit). A null text is empty and keeps only its end id; a null key stays null; repeated rows are
    packed as often as they occur; an empty table gives no piece. Other columns are not read.
    """
    return cut(token_table(docs, tokenizer, text, key, end_id, name="pack-tokens"), id_type(tokenizer), window)


def cut(tokens: DataFrame, kind: str, window: int = WINDOW) -> DataFrame:
    """``pack`` for a stored token table. Every row is cut where it lies; no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _pieces(batch, kind, window)

    return with_positions(tokens).select("doc_id", "position", "n_tokens", "ids").mapInArrow(run, PIECE_SCHEMA)


def _ids(batch: pa.RecordBatch, kind: str) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index("ids"))
    return np.frombuffer(b"".join(values.to_pylist()), kind)


def _pieces(batch: pa.RecordBatch, kind: str, window: int, limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Pieces of some documents, in steps of about ``limit`` ids."""
    sizes = batch.column(2).to_numpy()
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right")))
        rows, at = batch.slice(at, to - at), to
        position, n = rows.column(1).to_numpy(), rows.column(2).to_numpy()
        ids = _ids(rows, kind)
        first = position // window
        count = np.where(n > 0, (position + n - 1) // window - first + 1, 0)
        row = np.repeat(np.arange(len(n)), count)
        if not len(row):
            continue
        sequence = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        begin = np.maximum(position[row], sequence * window)
        stop = np.minimum(position[row] + n[row], (sequence + 1) * window)
        yield pa.RecordBatch.from_arrays([
            rows.column(0).take(pa.array(row)), pa.array(begin - position[row]), pa.array(stop - begin), pa.array(n[row]),
            pa.array(sequence), pa.array(begin - sequence * window),
            binary_array(ids.astype("<u4").tobytes(), 4 * np.concatenate([[0], np.cumsum(stop - begin)])),
        ], names=[c.split()[0] for c in PIECE_SCHEMA.split(", ")])


def sequences(tokens: DataFrame, kind: str, window: int = WINDOW) -> DataFrame:
    """Whole windows of a stored token table: sequence_id, n_tokens, ids (little-endian unsigned 32-bit).

    A task writes each window it sees whole; of a window that crosses into another task's rows it writes a
    boundary record, and only these records are shuffled (at most two for each contiguous range of rows, each shorter than a window).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, held = 0, np.zeros(0, "<u4")
        for batch in batches:
            out = []
            for position, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(ids, kind).astype("<u4")
                if position != begin + len(held):
                    out.append((begin, held))
                    begin, held = position, own
                else:
                    held = np.concatenate([held, own])
                stop = (begin + len(held)) // window * window
                if stop > begin:
                    edges = [begin, *range(begin // window * window + window, stop + 1, window)]
                    out += [(a, held[a - begin : b - begin]) for a, b in zip(edges, edges[1:])]
                    begin, held = stop, held[stop - begin :]
            yield from _fragments(out, window)
        yield from _fragments([(begin, held)], window)

    parts = with_positions(tokens).select("position", "ids").mapInArrow(run, FRAGMENT_SCHEMA)
    whole = parts.filter("whole").select("sequence_id", "ids")
    pieces = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rest = parts.filter("not whole").groupBy("sequence_id").agg(pieces.alias("p"))
    joined = F.aggregate("p", F.lit(b"").cast("binary"), lambda done, x: F.concat(done, x["ids"]))
    return whole.unionByName(rest.select("sequence_id", joined.alias("ids"))).select("sequence_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids")


def _fragments(found: list[tuple[int, np.ndarray]], window: int) -> Iterator[pa.RecordBatch]:
    found = [(at, ids) for at, ids in found if len(ids)]
    if not found:
        return
    yield pa.RecordBatch.from_arrays([
        pa.array([at // window for at, _ in found], pa.int64()), pa.array([at % window for at, _ in found], pa.int64()),
        pa.array([len(ids) == window for _, ids in found]), pa.array([ids.tobytes() for _, ids in found], pa.binary()),
    ], names=["sequence_id", "offset", "whole", "ids"])
