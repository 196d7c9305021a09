"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import eventloom
from eventloom.session import shared_path

WORD = r"[^\x20\x09-\x0D]+"
"""A word: a run without ASCII white space."""

BATCH_BYTES = 1 << 20
"""Text bytes that a task turns into Python or numpy objects at once; one longer text is a batch of its own."""


@lru_cache(maxsize=None)
def _package(application: str) -> str:
    """A zip file of this package, made once for each application."""
    top = Path(eventloom.__file__).parent
    path = Path(tempfile.mkdtemp(prefix=f"{application}-")) / "eventloom.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    return str(path)


BATCH_ROWS = "1000"
"""Rows that Spark hands a Python worker at once, in place of its 10,000: rows here are whole documents."""
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, which need not have it installed, and bound the batches they get.

    A batch size that the session has set itself stays.
    """
    spark.sparkContext.addPyFile(_package(spark.sparkContext.applicationId))
    if spark.conf.get(BATCH_CONF) == "10000":
        spark.conf.set(BATCH_CONF, BATCH_ROWS)
    return spark


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder once, compressed, and go on from the files.

    The written table cuts the lineage: lost executors lose nothing of it.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def whole_row(df: DataFrame) -> Column:
    """All columns in one struct, so that no name of theirs meets a name of ours."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def words_in(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in record batches of at most ``limit`` text bytes (or one row)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(value_lengths(batch.column(column)))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def value_lengths(values: pa.Array) -> np.ndarray:
    """Bytes of each value of a string or binary array, null as 0."""
    offsets = np.frombuffer(values.buffers()[1], dtype=offset_type(values))[values.offset : values.offset + len(values) + 1]
    lengths = np.diff(offsets)
    return np.where(validity(values), lengths, 0) if values.null_count else lengths


def offset_type(values: pa.Array) -> str:
    return "<i8" if pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type) else "<i4"


def validity(values: pa.Array) -> np.ndarray:
    return values.is_valid().to_numpy(zero_copy_only=False)


def utf8(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array in one buffer, and the offsets of its values (null is empty)."""
    if values.null_count:
        values = values.fill_null("")
    offsets = np.frombuffer(values.buffers()[1], dtype=offset_type(values))[values.offset : values.offset + len(values) + 1].astype(np.int64)
    data = values.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


class RangeHash:
    """Hashes of byte ranges of one buffer: polynomials modulo primes near 2^31, two of them in each 64-bit hash.

    Prefix sums are exact below 2^64 and reduced at range ends only. Different primes make independent hashes (``part``); none
    takes words for equal that only look alike to powers of two.
    """

    # fixed values: the four greatest primes below 2^31, and a primitive start for each polynomial
    PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
    BASES = (1103515245, 1664525, 214013, 69069)
    STEP = 1 << 23
    """Bytes whose products are summed before the sum is reduced."""

    def __init__(self, parts: int = 1) -> None:
        self.parts = parts
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        self.up, self.down = [], []
        for prime, base in list(zip(self.PRIMES, self.BASES))[: 2 * self.parts]:
            for tables, factor in ((self.up, base), (self.down, pow(base, -1, prime))):
                powers = np.ones(1, np.uint64)
                while len(powers) < n:
                    powers = np.concatenate([powers, powers * np.uint64(pow(factor, len(powers), prime)) % np.uint64(prime)])
                tables.append(powers[:n].astype(np.uint32))

    def _modulo(self, k: int, data: np.ndarray, begins: np.ndarray, stops: np.ndarray) -> np.ndarray:
        prime, carry = np.uint64(self.PRIMES[k]), np.uint64(0)
        running = np.zeros(len(data) + 1, np.uint64)
        for at in range(0, len(data), self.STEP):
            end = min(at + self.STEP, len(data))
            np.cumsum(self.up[k][at:end] * (data[at:end].astype(np.uint64) + np.uint64(1)), out=running[at + 1 : end + 1])
            running[at + 1 : end + 1] += carry
            carry = running[end] % prime
        return (running[stops] % prime + prime - running[begins] % prime) % prime * self.down[k][begins] % prime

    def of(self, data: np.ndarray, begins: np.ndarray, stops: np.ndarray, part: int = 0) -> np.ndarray:
        """One hash for each range; equal bytes have equal hashes wherever they lie."""
        if len(data) >= len(self.up[0]):
            self._grow(len(data) + 1 + len(data) // 4)
        first, second = (self._modulo(2 * part + k, data, begins, stops) for k in range(2))
        return scramble(first << np.uint64(32) | second) + (stops - begins).astype(np.uint64)


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that leaves no visible order (the finalizer of splitmix64)."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def binary_array(data: bytes, offsets: np.ndarray) -> pa.Array:
    """Arrow binary values cut from one buffer; 64-bit offsets only where the buffer needs them."""
    if len(data) < 2**31:
        return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype("<i4").tobytes()), pa.py_buffer(data)])
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype("<i8").tobytes()), pa.py_buffer(data)])


LOOKUP_ROWS = 1_000_000
"""Narrow rows that a broadcast table has at most."""


def small_enough(rows: DataFrame) -> bool:
    return rows.limit(LOOKUP_ROWS + 1).count() <= LOOKUP_ROWS


def lookup(small: DataFrame) -> DataFrame:
    """A table that may be joined without a shuffle: marked for broadcast if it has at most LOOKUP_ROWS (narrow) rows, else as it is."""
    return F.broadcast(small) if small_enough(small) else small


def maybe_in(rows: DataFrame, column: str, bits: int = 26):
    """A function of a column of longs: false for values that are surely not in ``rows``.

    A table of 2^``bits`` hash slots (8 MB), built by an aggregate and sent to all workers; values that share a slot are doubtful
    and need an exact join, so a full table only costs time.
    """
    slot = F.pmod(F.xxhash64(column), F.lit(1 << bits))
    words = rows.select(slot.alias("slot")).groupBy(F.shiftright("slot", 5).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 31 as int))")).alias("bits")).toPandas()
    table = np.zeros(1 << bits - 5, np.uint32)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    held = rows.sparkSession.sparkContext.broadcast(table)

    def known(slots):
        import pandas as pd

        at = slots.to_numpy(np.int64)
        return pd.Series((held.value[at >> 5] >> (at & 31).astype(np.uint32) & 1).astype(bool))

    probe = F.pandas_udf(known, "boolean")
    return lambda value: probe(F.pmod(F.xxhash64(value), F.lit(1 << bits)))


def part_bases(parts: DataFrame, order: list[Column], total: str = "total") -> DataFrame:
    """Running total of ``total`` before each row of a small table (one row per partition).

    The window has no key: its input is one row per partition of a stored table, never rows of the corpus.
    """
    from pyspark.sql import Window

    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("base", F.coalesce(F.sum(total).over(before), F.lit(0)))
