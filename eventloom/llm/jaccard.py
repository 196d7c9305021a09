"""N-gram Jaccard join: prefixes of rare tokens, combinations of frequent ones, exact verification, linked groups.

A token is the hash of a shingle. All sets are ordered alike: unmatched tokens (one document only) first, then rare ones (fewer than ``rare``
documents), then frequent ones. Two sets that reach the threshold t share a token of the first |x| - ceil(t|x|) + 1 of either, and two
tokens of the first |x| - ceil(t|x|) + 2. So a pair meets on a rare token, or it shares frequent tokens only; then it meets on
a combination of two frequent tokens, or on a single one where a long prefix would make too many combinations.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil, log2
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RangeHash, maybe_in, scramble, store, text_slices, utf8, whole_row
from .graph import components

BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


SLICE_BYTES = 1 << 19
"""Text bytes hashed at once; the arrays over them take some sixty times as much."""


class Join(NamedTuple):
    """Words in a shingle; threshold in percent; documents from which a token is frequent; longest frequent prefix that is combined."""

    words: int = 3
    percent: int = 90
    rare: int = 8
    combined: int = 24

    def checked(self) -> Join:
        """Itself; the method meets sets on two shared tokens, so one token must not suffice for sets of two and three."""
        if not 50 < self.percent <= 100 or self.words < 1:
            raise ValueError("percent must be above 50 and at most 100, words at least 1")
        return self

    def needed(self, n: np.ndarray | int) -> np.ndarray | int:
        """Least overlap of a set of n tokens with any set that reaches the threshold."""
        return -(-self.percent * n // 100)


class Shingles:
    """Sets of shingle hashes of many texts; ASCII letters are lower-cased, words end at ASCII white space."""

    def __init__(self, words: int):
        self.words, self.hashes = words, RangeHash(parts=2)

    def sets(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct hashes of each text in a row, and where each text's begin. Fewer words than a shingle make one of them all."""
        tokens, _, bounds = self.checked_sets(texts, checks=False)
        return tokens, bounds

    def checked_sets(self, texts: pa.Array, checks: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``sets``, with a second, independent hash of each shingle after the first."""
        data, offsets = utf8(texts)
        full = np.zeros(len(data) + 2, bool)
        full[1:-1] = ~BLANK[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begins = np.flatnonzero(full[1:-1] & (~full[:-2] | edge[:-1]))
        stops = np.flatnonzero(full[1:-1] & (~full[2:] | edge[1:])) + 1
        first = np.searchsorted(begins, offsets)  # first word of each text
        count = np.diff(first)
        size = np.where(count >= self.words, count - self.words + 1, (count > 0).astype(np.int64))
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(first[:-1] - ends[:-1], size) + np.arange(ends[-1])
        length = np.repeat(np.minimum(count, self.words), size)
        low = LOWER[data]

        def combined(part: int) -> np.ndarray:
            words = scramble(self.hashes.of(low, begins, stops, part))
            out = np.zeros(len(at), np.uint64)
            for k in range(self.words):
                inside = k < length
                out = np.where(inside, scramble(out + words[np.minimum(at + k, max(len(words) - 1, 0))] + np.uint64(0x632BE59BD9B4E019)), out) if len(words) else out
            return np.where(length < self.words, scramble(out + length.astype(np.uint64)), out)

        out = combined(0)
        check = combined(1) if checks else out[:0]
        for a, b in zip(ends.tolist(), ends[1:].tolist()):
            if checks:
                order = np.argsort(out[a:b])
                out[a:b], check[a:b] = out[a:b][order], check[a:b][order]
            else:
                out[a:b].sort()
        fresh = np.ones(len(out), bool)
        fresh[1:] = out[1:] != out[:-1]
        fresh[ends[:-1][size > 0]] = True
        return out[fresh], check[fresh] if checks else check, np.concatenate([[0], np.cumsum(fresh)])[ends]


def token_classes(docs: DataFrame, text: str, join: Join) -> tuple[np.ndarray, int]:
    """Class of each token by the leading bits of its hash, four to a byte: 0 one document, 1 rare, 2 and 3 frequent.

    Document frequencies count every token of every text. Tokens are dealt by the leading bits, 32 further bits are kept;
    tokens that agree in those bits, or in the bits of the table, only get a higher class, which costs candidates but loses no link. The table has
    eight slots for each token of two or more documents, between 2^20 and 2^30 slots (256 KB to 256 MB): it may be broadcast.
    """
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    bits = min(max(ceil(log2(max(size / 7 / 2**20, 1))), 8), 24)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, held, n = Shingles(join.words), [], 0
        for batch in text_slices(batches, text, SLICE_BYTES):
            held.append(sets.sets(batch.column(0))[0] >> np.uint64(32 - bits))
            n += len(held[-1])
            if n >= 1 << 21:
                yield _counted(held, bits)
                held, n = [], 0
        if n:
            yield _counted(held, bits)

    counted = docs.select(text).mapInArrow(spread, "bucket int, keys binary, counts binary")
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, keys, counts in _by_bucket(batches):
            distinct, at = np.unique(keys, return_inverse=True)
            total = np.bincount(at, counts, len(distinct)).astype(np.int64)
            kept = total > 1
            yield pa.RecordBatch.from_arrays([
                pa.array([bucket], pa.int32()), pa.array([distinct[kept].tobytes()]), pa.array([np.minimum(total[kept], 2**31).astype("<u4").tobytes()]), pa.array([int(kept.sum())]),
            ], names=["bucket", "keys", "counts", "n"])

    shared = store(counted.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(repeated, "bucket int, keys binary, counts binary, n long"), "jaccard-frequencies")
    several = shared.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    slots = max(min(max(ceil(log2(max(8 * several, 1))), 20), 30), bits + 2)
    limits = np.array([2, join.rare, 8 * join.rare])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, keys, counts in _by_bucket(batches):
            table = np.zeros(1 << slots - bits, np.uint8)
            np.maximum.at(table, keys >> np.uint32(32 - (slots - bits)), np.searchsorted(limits, counts, side="right").astype(np.uint8))
            four = table.reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([(four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).tobytes()])], names=["bucket", "classes"])

    table = np.zeros(1 << slots - 2, np.uint8)
    width = 1 << slots - bits - 2
    for row in shared.select("bucket", "keys", "counts").mapInArrow(packed, "bucket int, classes binary").toLocalIterator():
        table[row["bucket"] * width : (row["bucket"] + 1) * width] = np.frombuffer(row["classes"], np.uint8)
    return table, slots


def _counted(held: list[np.ndarray], bits: int) -> pa.RecordBatch:
    keys, counts = np.unique(np.concatenate(held), return_counts=True)
    buckets = (keys >> np.uint64(32)).astype(np.int64)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(buckets)) + 1, [len(keys)]])
    low = (keys & np.uint64(0xFFFFFFFF)).astype("<u4")
    counts = counts.astype("<u4")
    return pa.RecordBatch.from_arrays([
        pa.array(buckets[edges[:-1]].astype(np.int32)), pa.array([low[a:b].tobytes() for a, b in zip(edges, edges[1:])]), pa.array([counts[a:b].tobytes() for a, b in zip(edges, edges[1:])]),
    ], names=["bucket", "keys", "counts"])


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Keys and counts of each bucket; rows come ordered by bucket."""
    last, held = None, []
    for batch in batches:
        for bucket, keys, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if held and bucket != last:
                yield last, *(np.concatenate(x) for x in zip(*held))
                held = []
            last = bucket
            held.append((np.frombuffer(keys, "<u4"), np.frombuffer(counts, "<u4")))
    if held:
        yield last, *(np.concatenate(x) for x in zip(*held))


PARITY_BITS = 512

SET_SCHEMA = "doc_id long, set_id long, set_check long, n long, open boolean, unmatched long, scarce long, parity array<bigint>, wide boolean, rare array<bigint>, frequent array<bigint>, combined array<bigint>, tokens binary"


def document_sets(docs: DataFrame, classes: tuple[np.ndarray, int], join: Join, text: str, key: str) -> DataFrame:
    """doc_id, set_id (hash of the set), n of every document; where a link is possible at all (``open``) also its signatures and tokens.

    A set with more unmatched tokens than it may miss links with nothing but equal sets and carries no more.
    """
    held, slots = docs.sparkSession.sparkContext.broadcast(classes[0]), classes[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sets = held.value, Shingles(join.words)
        for batch in text_slices(batches, text, SLICE_BYTES):
            tokens, checks, bounds = sets.checked_sets(batch.column(1))
            slot = (tokens >> np.uint64(64 - slots)).astype(np.int64)
            kinds = table[slot >> 2] >> (2 * (slot & 3)).astype(np.uint8) & 3
            n = np.diff(bounds)
            ids, second = set_ids(tokens, bounds), set_ids(checks, bounds)
            unmatched, scarce = (np.diff(np.concatenate([[0], np.cumsum(kinds < k)])[bounds]) for k in (1, 2))
            first = n - join.needed(n) + 1
            possible = (n > 1) & (unmatched < first)
            more: dict[str, list] = {c: [None] * len(n) for c in ("parity", "wide", "rare", "frequent", "combined", "tokens")}
            for i in np.flatnonzero(possible):
                own, kind = tokens[bounds[i] : bounds[i + 1]], kinds[bounds[i] : bounds[i + 1]]
                order = np.argsort(kind, kind="stable")
                begin = int(scarce[i])
                spare = max(int(first[i]) - begin, 0)  # frequent tokens in the first prefix
                more["rare"][i] = own[order[unmatched[i] : min(begin, first[i])]].view(np.int64)
                more["frequent"][i] = own[order[begin : begin + spare]].view(np.int64)
                more["wide"][i] = spare > join.combined
                chosen = own[order[begin : begin + spare + 1]] if 0 < spare <= join.combined else own[:0]
                a, b = np.triu_indices(len(chosen), 1)
                more["combined"][i] = scramble(scramble(chosen[a]) + chosen[b]).view(np.int64)
                more["parity"][i] = np.packbits(np.bincount((own % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) % 2 == 1).view(np.int64)
                more["tokens"][i] = own.tobytes() + checks[bounds[i] : bounds[i + 1]].tobytes()
            kinds_of = {"wide": pa.bool_(), "tokens": pa.binary()}
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()), pa.array(ids.view(np.int64)), pa.array(second.view(np.int64)), pa.array(n), pa.array(possible), pa.array(unmatched), pa.array(scarce),
                *(pa.array(v, kinds_of.get(c, pa.list_(pa.int64()))) for c, v in more.items()),
            ], names=[c.split()[0] for c in SET_SCHEMA.split(", ")])

    return docs.select(key, text).mapInArrow(run, SET_SCHEMA)


def set_ids(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set of tokens, by two sums over its members and their number."""
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(x)]) for x in (tokens, scramble(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)))]
    one, two = (x[bounds[1:]] - x[bounds[:-1]] for x in sums)
    return scramble(scramble(one) + two) ^ np.diff(bounds).astype(np.uint64)


def apart(sets: DataFrame) -> DataFrame:
    """The sets with different ids wherever ``set_id`` and ``set_check`` together differ: equal ids stand for equal 128 bits."""
    clashes = sets.groupBy("set_id").agg(F.min("set_check").alias("low"), F.max("set_check").alias("high")).filter("low != high").select("set_id")
    if clashes.isEmpty():
        return sets
    marked = sets.join(clashes.withColumn("clash", F.lit(True)), "set_id", "left")
    return store(marked.withColumn("set_id", F.when(F.col("clash"), F.xxhash64("set_id", "set_check")).otherwise(F.col("set_id"))).drop("clash"), "jaccard-sets-apart")


def reachable(join: Join, without: str) -> Column:
    """Whether two sets can reach the threshold, by two exact bounds.

    Tokens that are counted in ``without`` are not shared: unmatched ones never, scarce ones not by sets that meet on
    frequent tokens only. And sets that differ in d tokens differ in at most d of the parities of their token counts per hash remainder, while the
    threshold p percent allows d (100 + p) <= (100 - p) (n + n2).
    """
    sizes = F.col("n") + F.col("n2")
    most = F.least(F.col("n") - F.col(without), F.col("n2") - F.col(f"{without}2"))
    odd = [F.bit_count(F.get("parity", F.lit(i)).bitwiseXOR(F.get("parity2", F.lit(i)))) for i in range(PARITY_BITS // 64)]
    differ = reduce(lambda x, y: x + y, odd)
    return (100 * most >= join.percent * (sizes - most)) & ((100 + join.percent) * differ <= (100 - join.percent) * sizes)


def _pair(a: str = "set_id", b: str = "set_id2") -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _second(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c == "token" else f"{c}2") for c in df.columns])


def links(sets: DataFrame, join: Join) -> DataFrame:
    """Verified links (a, b) between sets, enough to connect every two sets that a chain of links connects.

    ``sets`` holds each open set once. Rare tokens lie in fewer than ``rare`` documents, so all their pairs are looked at.
    Frequent tokens first link their sets to the one with the smallest share of scarce tokens; whatever then still lies
    in different groups meets pair by pair on combined or single frequent tokens.
    """
    slim = ("set_id", "n", "unmatched", "scarce", "parity")
    rare = sets.select(*slim, F.explode("rare").alias("token"))
    by_rare = rare.join(_second(rare), "token").filter(F.col("set_id") < F.col("set_id2")).filter(reachable(join, "unmatched")).select(*_pair())
    frequent = store(sets.select(*slim, "wide", F.explode("frequent").alias("token")), "jaccard-frequent")
    order = F.struct((F.col("scarce") / F.col("n")).alias("share"), *slim)
    centers = frequent.groupBy("token").agg(F.min(order).alias("least"), F.count("*").alias("members")).filter("members > 1")
    centers = centers.select("token", *[F.col(f"least.{c}").alias(f"{c}2") for c in slim])
    to_center = frequent.join(centers, "token").filter("set_id != set_id2").filter(reachable(join, "scarce")).select(*_pair())
    found = store(verify(by_rare.unionByName(to_center).distinct(), sets, join), "jaccard-links")
    groups = components(found).select(F.col("node").alias("set_id"), "component")
    placed = frequent.join(groups, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    single = _divided(placed)
    crossing = (F.col("component") != F.col("component2")) & reachable(join, "scarce")
    by_single = single.filter("wide").join(_second(single), "token").filter(crossing).select(*_pair())
    combined = sets.filter("not wide").select(*slim, F.explode("combined").alias("token")).join(groups, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    both = _divided(combined)
    by_pair = both.join(_second(both), "token").filter(F.col("set_id") < F.col("set_id2")).filter(crossing).select(*_pair())
    rest = verify(by_single.unionByName(by_pair).distinct(), sets, join)
    return found.unionByName(rest)


def _divided(members: DataFrame) -> DataFrame:
    """Members of tokens whose sets are not all in one group yet."""
    split = members.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high").select("token")
    return store(members.join(split, "token", "left_semi"), "jaccard-divided")


def verify(pairs: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """The pairs whose sets reach the threshold: 100 * intersection >= percent * union; shingles are shared if 128 bits agree."""
    own = sets.select(F.col("set_id").alias("a"), F.col("tokens").alias("x"))
    other = sets.select(F.col("set_id").alias("b"), F.col("tokens").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(i) for i in (2, 3))
            good = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                (p, p2), (q, q2) = (np.frombuffer(side[i].as_py(), np.uint64).reshape(2, -1) for side in (x, y))
                _, at, to = np.intersect1d(p, q, assume_unique=True, return_indices=True)
                shared = int((p2[at] == q2[to]).sum())
                good[i] = 100 * shared >= join.percent * (len(p) + len(q) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    joined = pairs.join(own, "a").join(other, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(run, "a long, b long")


def group_documents(docs: DataFrame, join: Join = Join(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id of every row, for a threshold above 50 percent (others are refused).

    component_id is the smallest doc_id that links reach, the own one included. A text without words (also null) has no shingle and links with
    nothing. Equal sets are one set; rows repeated whole have the same answer. A row without id can link others but
    never names a group with an id. An empty table gives no rows; other columns are not read.
    """
    sets = apart(store(document_sets(docs, token_classes(docs, text, join.checked()), join, text, key), "jaccard-sets"))
    open_sets = store(_once(sets), "jaccard-open")
    groups = components(links(open_sets, join)).select(F.col("node").alias("set_id"), "component")
    own = sets.filter("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    named = own.join(groups, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    named = store(named, "jaccard-groups")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_set = named.join(smallest, "component").select("set_id", "component_id")
    full = sets.filter("n > 0").select("doc_id", "set_id", "n").join(of_set, "set_id").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = sets.filter("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def _once(sets: DataFrame) -> DataFrame:
    """Each open set once. Equal sets agree in all that is kept, so which row stays makes no difference."""
    kept = sets.filter("open").groupBy("set_id").agg(F.first(F.struct("n", "unmatched", "scarce", "parity", "wide", "rare", "frequent", "combined", "tokens")).alias("s"))
    return kept.select("set_id", "s.*")


def keep_one(docs: DataFrame, join: Join = Join(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without those whose group has a smaller id; all columns stay.

    Of rows that repeat id and text one stays. Texts without words stay, and so do rows without an id, which no group can name.
    """
    groups = store(group_documents(docs, join, text, key), "jaccard-answer")
    first = groups.filter("doc_id = component_id").select("doc_id").distinct()
    doubtful = maybe_in(groups.filter("doc_id <> component_id"), "doc_id")
    rows = docs.filter(F.col(key).isNotNull()).select(whole_row(docs).alias("row"), F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    marked = rows.withColumn("doubtful", doubtful(F.col("doc_id")))
    # rows that surely stay are not shuffled
    kept = marked.filter("not doubtful").unionByName(marked.filter("doubtful").join(first, "doc_id", "left_semi")).drop("doubtful")
    if not groups.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept.select("row.*").unionByName(docs.filter(F.col(key).isNull()))
