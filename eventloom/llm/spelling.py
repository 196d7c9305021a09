"""Spelling variants: words one edit apart, found by products of letter counts.

The letter counts of two words that differ by one inserted, deleted or replaced letter are at squared distance 1 or 2 (0 only for equal
letters, which one edit never leaves), and their lengths differ by at most one. Words are dealt to cells by length and by how many of
their letters fall into each of a few letter groups; one edit moves a word to a known neighbouring cell. A cell meets
its neighbours in blocks: one matrix product of letter counts gives all squared distances of a block, pairs at most two apart
are kept and their letters compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup, store

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = r"[A-Za-zÀ-ÿ]"
GROUPS = 6
"""Letter groups of a cell's signature."""
BITS = 10
"""Bits for a group's count, counts modulo 1,024: longer words share cells and are told apart by their letters."""
CHUNK = 2_048
"""Words of a cell that meet others at once; larger cells are split."""
FLOAT_EXACT = 2_000
"""Longest words whose distances single precision holds exactly."""
STREAM = 4_096


def runs(docs: DataFrame, least: int, key: str, text: str) -> DataFrame:
    """doc, run: every maximal run of at least ``least`` letters of whole texts, with A-Z in lower case."""
    found = F.explode(F.regexp_extract_all(text, F.lit(f"{LETTERS}{{{least},}}"), F.lit(0)))
    return docs.select(F.col(key).cast("string").alias("doc"), found.alias("run")).withColumn("run", F.translate("run", UPPER, UPPER.lower()))


def damaged(found: DataFrame, one_in: int = 31) -> DataFrame:
    """The runs of ``runs`` as ``word``, one code point of about one in ``one_in`` deleted: the one at hash modulo length, where
    the hash is the crc32 of document and run. A null document counts as an empty one."""
    h, at = F.crc32(F.concat(F.coalesce("doc", F.lit("")), F.lit(":"), "run")), F.expr("cast(h % length(run) as int)")
    less = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
    return found.withColumn("h", h).withColumn("at", at).select(F.when(F.col("h") % one_in == 0, less).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, shortest: int = 7, fewest: int = 2, one_in: int = 31, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: the words of at least ``shortest`` code points that occur at least ``fewest`` times in all whole texts."""
    words = damaged(runs(docs, shortest, key, text), one_in).filter(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= fewest)


def letter_bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all words in a row, one byte each, and the length of each word."""
    texts = [w.encode("latin-1") for w in words.to_pylist()]
    return np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64)


def letter_counts(letters: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Occurrences of each byte in each word."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    return np.bincount(owner * 256 + letters, minlength=len(lengths) * 256).reshape(-1, 256)


def letter_groups(words: DataFrame) -> np.ndarray:
    """Group of every letter: the letters, most frequent first, each to the group that has least so far."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            total += np.bincount(letter_bytes(batch.column(0))[0], minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256, dtype=np.int32)), pa.array(total)], names=["letter", "n"])

    counted = words.select("word").mapInArrow(run, "letter int, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect()  # 256 rows
    groups, load = np.zeros(256, np.int64), [0] * GROUPS
    for row in sorted(counted, key=lambda r: (-r.n, r.letter)):
        groups[row.letter] = load.index(min(load))
        load[groups[row.letter]] += row.n
    return groups


def moves() -> np.ndarray:
    """What one edit adds to a signature, one of each pair of opposite moves: an insertion, or a replacement across groups."""
    unit = np.eye(GROUPS, dtype=np.int64)
    return np.concatenate([unit, np.array([unit[a] - unit[b] for a, b in permutations(range(GROUPS), 2) if a < b])])


def pack(signatures: np.ndarray) -> np.ndarray:
    """Signatures as one integer each, counts modulo 2^BITS."""
    return ((signatures % (1 << BITS)) << (BITS * np.arange(GROUPS))).sum(axis=-1)


def with_cells(words: DataFrame, groups: np.ndarray) -> DataFrame:
    """word, n, cell and the neighbouring cells that one edit can lead to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                letters, lengths = letter_bytes(batch.column(0))
                owner = np.repeat(np.arange(len(lengths)), lengths)
                signatures = np.bincount(owner * GROUPS + groups[letters], minlength=len(lengths) * GROUPS).reshape(-1, GROUPS)
                around = pack(signatures[:, None, :] + moves()[None])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pack(signatures)), pa.array(list(around), pa.list_(pa.int64()))], names=["word", "n", "cell", "around"])

    return words.mapInArrow(run, "word string, n long, cell long, around array<bigint>")


class Block:
    """Words of one length: their letters as rows of bytes, and their letter counts ready for distance products."""

    def __init__(self, batch: pa.RecordBatch, rows: np.ndarray, letters: np.ndarray, ends: np.ndarray, length: int):
        self.words, self.n, self.length = batch.column("word").take(pa.array(rows)), batch.column("n").to_numpy()[rows], length
        self.letters = letters[(ends[rows] - length)[:, None] + np.arange(length)]
        kind = np.float32 if length <= FLOAT_EXACT else np.float64
        counts = letter_counts(self.letters.ravel(), np.full(len(rows), length))[:, 97:].astype(kind)
        square, one = (counts**2).sum(axis=1, keepdims=True), np.ones((len(rows), 1), kind)
        self.left, self.right = np.hstack([-2 * counts, square, one]), np.hstack([counts, one, square])


def blocks(batch: pa.RecordBatch) -> Iterator[Block]:
    letters, lengths = letter_bytes(batch.column("word"))
    ends = np.cumsum(lengths)
    for length in np.unique(lengths).tolist():
        yield Block(batch, np.flatnonzero(lengths == length), letters, ends, length)


def one_edit(a: Block, b: Block, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two blocks whose words are one edit apart; in a block with itself each pair once."""
    if abs(a.length - b.length) > 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if a.length > b.length:
        j, i = one_edit(b, a, False)
        return i, j
    near = a.left @ b.right.T <= 2.5  # squared distances are whole
    i, j = np.nonzero(np.triu(near, 1) if same else near)
    if a.length == b.length:
        right = (a.letters[i] != b.letters[j]).sum(axis=1) == 1
    else:
        front = np.logical_and.accumulate(a.letters[i] == b.letters[j][:, :-1], axis=1).sum(axis=1)
        back = np.logical_and.accumulate((a.letters[i] == b.letters[j][:, 1:])[:, ::-1], axis=1).sum(axis=1)
        right = front + back >= a.length
    return i[right], j[right]


def near_pairs(words: DataFrame) -> DataFrame:
    """word, near, near_n: every pair of words one edit apart, in both directions; ``words`` is a stored table of word and n."""
    celled = store(with_cells(words, letter_groups(words)), "spelling-cells")
    weight = F.sum(F.greatest(F.lit(1.0), F.length("word") / 256))
    sizes = lookup(celled.groupBy("cell").agg(F.ceil(weight / CHUNK).cast("int").alias("chunks")))
    placed = celled.join(sizes, "cell").withColumn("chunk", F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int"))
    home = placed.select("cell", "chunk", F.lit(0).alias("kind"), "word", "n")
    beside = placed.filter("chunk > 0").select("cell", F.explode(F.expr("sequence(0, chunk - 1)")).alias("chunk"), F.lit(1).alias("kind"), "word", "n")
    around = celled.select("word", "n", F.explode("around").alias("cell")).join(sizes, "cell")
    around = around.select("cell", F.explode(F.expr("sequence(0, chunks - 1)")).alias("chunk"), F.lit(1).alias("kind"), "word", "n")
    spark = words.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = home.unionByName(beside).unionByName(around).repartition(parts, "cell", "chunk").sortWithinPartitions("cell", "chunk", "kind")

    def meet(mine: list[Block], others: list[Block], same: bool) -> Iterator[pa.RecordBatch]:
        for p, a in enumerate(mine):
            for b in others[p:] if same else others:
                i, j = one_edit(a, b, same and a is b)
                if len(i):
                    both, n = pa.concat_arrays([a.words.take(pa.array(i)), b.words.take(pa.array(j))]), np.concatenate([b.n[j], a.n[i]])
                    yield pa.RecordBatch.from_arrays([both, pa.concat_arrays([both.slice(len(i)), both.slice(0, len(i))]), pa.array(n)], names=["word", "near", "near_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, mine, held = None, None, []

        def gathered() -> list[Block]:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()
            return list(blocks(table[0]))

        for batch in batches:
            for begin, end in stretches(batch):
                piece = batch.slice(begin, end - begin)
                group = piece.column("cell")[0].as_py(), piece.column("chunk")[0].as_py()
                if group != key:
                    if held:
                        own = gathered()
                        yield from meet(own, own, True)
                    key, mine, held = group, None, []
                if piece.column("kind")[0].as_py() == 0:
                    held.append(piece)
                elif held or mine is not None:
                    if mine is None:
                        mine, held = gathered(), []
                        yield from meet(mine, mine, True)
                    yield from meet(mine, list(blocks(piece)), False)
        if held:
            own = gathered()
            yield from meet(own, own, True)

    return dealt.mapInArrow(run, "word string, near string, near_n long")


def stretches(batch: pa.RecordBatch) -> list[tuple[int, int]]:
    """Stretches of rows of one cell, chunk and kind, at most STREAM rows long."""
    if not batch.num_rows:
        return []
    keys = np.stack([batch.column(c).to_numpy() for c in ("cell", "chunk", "kind")], axis=1)
    cuts = np.union1d(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, np.arange(STREAM, batch.num_rows, STREAM)).tolist()
    return list(zip([0, *cuts], [*cuts, batch.num_rows]))


def variants(words: DataFrame, times: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n for a table of distinct words (letters of LETTERS, A-Z lower-cased) and their n.

    A word's form is its near word of largest n, of equal ones the first in code-point order, if that n is at least ``times`` times its
    own; the root is reached by following forms. Rows with a null word or n take no part; an empty table gives no rows.
    """
    words = store(words.select("word", F.col("n").cast("long").alias("n")).dropna(), "spelling-words")
    best = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    judged = words.join(best, "word", "left").withColumn("fits", -F.col("best.less") >= times * F.col("n"))
    judged = store(judged.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.expr("if(fits, best.near, null)").alias("form"), F.expr("if(fits, -best.less, null)").alias("form_n")), "spelling-forms")
    ends = store(judged.filter("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:  # each round doubles the stretch that is skipped; a chain is no longer than the logarithm of the largest n
        on = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = ends.join(on, "root", "left")
        if jumped.filter("further is not null").isEmpty():
            break
        ends = store(jumped.select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, shortest: int = 7, fewest: int = 2, one_in: int = 31, times: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Variants of the words of whole texts. Null and empty texts have no words; repeated rows count again; other columns are not read."""
    return variants(vocabulary(docs, shortest, fewest, one_in, key, text), times)
