"""Mix sources to target weights: whole copies of documents by pivotal dependent rounding, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store, whole_row, words_in

BLOCK = 64
"""Documents that one task rounds in a row, about; each block leaves at most one document for the next level."""
EPS = 1e-9
UNIT = ("doc_id", "content", "rows", "size", "base")


def source_targets(units: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """source, source_size, target: ``share`` of all sizes dealt by weight, no source above ``cap`` times its size.

    Sources in code point order (null last) take the weights in turn. What a source cannot take is dealt again by weight among the
    others: with sources ordered by size per weight, the full ones come first, and one level fits all the rest.
    The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("level", "place")
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    ordered = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    turns = F.array(*[F.lit(float(w)) for w in weights])
    weighed = (
        sources.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(turns, ((F.col("place") - 1) % len(weights) + 1).cast("int")))
        .withColumn("room", F.col("source_size") * F.lit(float(cap)))
        .withColumn("level", F.col("room") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(min(share, cap))))
        .withColumn("rest", (F.col("total") - F.coalesce(F.sum("room").over(before), F.lit(0.0))) / F.sum("weight").over(after))
        .withColumn("fits", F.first(F.when(F.col("rest") <= F.col("level"), F.col("rest")), ignorenulls=True).over(ordered))
    )
    target = F.least("room", F.coalesce(F.col("fits") * F.col("weight"), F.col("room")))
    return weighed.select("source", "source_size", target.alias("target"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _settled(unit: Column, extra: Column) -> Column:
    return F.struct(*[unit[c].alias(c) for c in UNIT], extra.cast("int").alias("extra"))


def _moved(unit: Column, p: Column) -> Column:
    return F.struct(*[unit[c].alias(c) for c in UNIT], p.alias("p"))


def _state(carry: Column, done: Column) -> Column:
    return F.struct(carry.alias("carry"), done.alias("done"))


def _pair(state: Column, b: Column, seed: int, nothing: Column) -> Column:
    """Move words between the carried document and the next one until one of them is whole."""
    a, done = state["carry"], state["done"]

    def step(m: Column) -> Column:
        gain = m["u"] * (m["up"] + m["down"]) < m["down"]  # the carried one gains with this chance, so means stay
        pa = F.when(gain, a["p"] + m["up"] / a["size"]).otherwise(a["p"] - m["down"] / a["size"])
        pb = F.when(gain, b["p"] - m["up"] / b["size"]).otherwise(b["p"] + m["down"] / b["size"])
        return F.struct(pa.alias("a"), pb.alias("b"))

    def whole(p: Column) -> Column:
        return (p < EPS) | (p > 1 - EPS)

    def choose(q: Column) -> Column:
        settled = F.filter(
            F.array(F.when(whole(q["a"]), _settled(a, F.round(q["a"]))), F.when(whole(q["b"]), _settled(b, F.round(q["b"])))),
            lambda x: x.isNotNull(),
        )
        carry = F.when(~whole(q["a"]), _moved(a, q["a"])).when(~whole(q["b"]), _moved(b, q["b"])).otherwise(nothing)
        return _state(carry, F.concat(done, settled))

    mass = F.struct(
        F.least((1 - a["p"]) * a["size"], b["p"] * b["size"]).alias("up"),
        F.least(a["p"] * a["size"], (1 - b["p"]) * b["size"]).alias("down"),
        chance(seed, a["doc_id"], a["content"], b["doc_id"], b["content"]).alias("u"),
    )
    return F.when(a.isNull(), _state(_moved(b, b["p"]), done)).otherwise(let(mass, lambda m: let(step(m), choose)))


def chance(seed: int, *of: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the values alone."""
    return F.xxhash64(F.lit(seed), *of).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 17, block: int = BLOCK,
    text: str = "text", key: str = "doc_id", source: str = "source",
) -> DataFrame:
    """Copies of each document: doc_id, source, content (hash of the text), rows, size, source_size, target, copies.

    Size counts the words of the whole text (null: none). A document of a source with ``target / source_size`` = f gets
    floor(f) or ceil(f) whole copies; within a source the words of all copies meet the target but for the last document
    that stays fractional, which goes to the nearest whole copy. Rows that agree in key, source and text are one unit of ``rows`` rows and share
    ``copies``; null keys and null sources are values like others. The same input and seed give the same copies in any order of the rows.

    Documents of a source fall into hashed blocks; a block pairs them from the longest to the shortest, so long ones
    become whole while shorter ones take up what they leave. What a block carries out at its end goes to the next level, which is
    a ``block``-th as large: a reduction tree whose inner levels are stored tables.
    """
    units = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(source).alias("source"), words_in(F.col(text)).alias("size"), F.xxhash64(F.col(text)).alias("content"))
    units = store(units.groupBy("doc_id", "source", "size", "content").agg(F.count("*").alias("rows")), "mix-units")
    targets = source_targets(units, weights, share, cap)
    f = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    named = units.join(targets.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    placed = store(
        named.withColumn("wanted", f * F.col("rows")).withColumn("base", F.floor(F.col("wanted") + EPS).cast("long"))
        .withColumn("p", F.greatest(F.col("wanted") - F.col("base"), F.lit(0.0))),
        "mix-placed",
    )
    split = (F.col("p") > EPS) & (F.col("size") > 0)
    level = placed.filter(split).select("source", F.struct(*UNIT, "p").alias("unit"))
    rounded: list[DataFrame] = []
    for depth in range(64):
        done, level, last = _round(level, depth, seed, block)
        rounded.append(done)
        if last:
            break
    ends = level.select("source", F.inline(F.array(F.struct(*[F.col(f"unit.{c}").alias(c) for c in UNIT], F.round("unit.p").cast("int").alias("extra")))))
    extras = reduce(DataFrame.unionByName, [*rounded, ends]).select(F.col("doc_id").alias("__d"), F.col("source").alias("__s"), F.col("content").alias("__c"), "extra")
    rest = placed.filter(~split).withColumn("extra", (F.col("p") >= 0.5).cast("int"))
    same = F.col("doc_id").eqNullSafe(F.col("__d")) & F.col("source").eqNullSafe(F.col("__s")) & (F.col("content") == F.col("__c"))
    moved = placed.filter(split).join(extras, same).drop("__d", "__s", "__c")
    return rest.unionByName(moved).select("doc_id", "source", "content", "rows", "size", "source_size", "target", (F.col("base") + F.col("extra")).alias("copies"))


def _round(level: DataFrame, depth: int, seed: int, block: int) -> tuple[DataFrame, DataFrame, bool]:
    """One level: settled documents, what each block carries on, and whether every source had one block."""
    counts = level.groupBy(F.col("source").alias("__s")).agg(F.ceil(F.count("*") / block).cast("long").alias("blocks"))
    # one number comes to the driver
    last = (counts.agg(F.max("blocks")).first()[0] or 1) <= 1
    dealt = level.join(counts, F.col("source").eqNullSafe(F.col("__s"))).select(
        "source", "unit", F.pmod(F.xxhash64(F.lit(seed + depth), "unit.doc_id", "unit.content"), F.col("blocks")).alias("block"),
    )
    key = F.struct((-F.col("unit.size")).alias("order"), F.xxhash64(F.lit(seed), "unit.doc_id", "unit.content").alias("tie"), "unit")
    grouped = dealt.groupBy("source", "block").agg(F.array_sort(F.collect_list(key)).alias("units"))
    unit_type = "struct<doc_id: bigint, content: bigint, rows: bigint, size: bigint, base: bigint, p: double>"
    done_type = "array<struct<doc_id: bigint, content: bigint, rows: bigint, size: bigint, base: bigint, extra: int>>"
    nothing = F.lit(None).cast(unit_type)
    first = _state(nothing, F.array().cast(done_type))
    folded = F.aggregate("units", first, lambda state, x: _pair(state, x["unit"], seed + depth, nothing))
    stored = store(grouped.select("source", folded.alias("state")), f"mix-level-{depth}")
    done = stored.select("source", F.inline("state.done"))
    carried = stored.filter("state.carry is not null").select("source", F.col("state.carry").alias("unit"))
    return done, carried, last


def taken_rows(units: DataFrame) -> DataFrame:
    """One row per document row: doc_id, size, source_size, target, taken (words of its copies)."""
    each = units.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("row"))
    copies = F.floor(F.col("copies") / F.col("rows")) + (F.col("row") <= F.col("copies") % F.col("rows")).cast("long")
    return each.select("doc_id", "size", F.col("source_size"), "target", (copies * F.col("size")).cast("long").alias("taken"))


def take(docs: DataFrame, units: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as its copies say, with all its columns."""
    mine = F.struct(F.col(key).cast("long").alias("doc_id"), F.col(source).alias("source"), F.xxhash64(F.col(text)).alias("content"))
    marked = docs.select(whole_row(docs).alias("row"), mine.alias("mine"))
    chosen = units.filter("copies > 0").select(F.struct("doc_id", "source", "content").alias("unit"), "copies", "rows")
    same = reduce(lambda a, b: a & b, [F.col(f"mine.{c}").eqNullSafe(F.col(f"unit.{c}")) for c in ("doc_id", "source", "content")])
    each = marked.join(chosen, same).withColumn("times", F.floor(F.col("copies") / F.col("rows")))
    # repeated rows share copies that don't divide evenly: one of them takes what is left over
    uneven = marked.join(chosen.filter("rows > 1 and copies % rows > 0"), same).dropDuplicates(["unit"])
    several = each.unionByName(uneven.withColumn("times", F.col("copies") % F.col("rows"))).filter("times > 0")
    return several.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times").cast("long")))).select("row.*")
