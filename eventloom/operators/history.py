"""Events assigned to series and to the time slots of a series."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classes import best_label, NO_LABEL, build_label, class_letter, verification_tag
from ..functions.keys import pick_key_source
from ..functions.times import floor_time
from ..session import materialize
from .asof import between_join
from .interval import match_by_location

CLASSES = ("B", "C", "M", "X")


def key_bridge(key_map: DataFrame, by: str, keys: str) -> DataFrame:
    """One row per (series, region number)."""
    return key_map.select(by, F.explode(keys).alias("key")).distinct()


def map_key(df: DataFrame, key_map: DataFrame, by: str, keys: str) -> DataFrame:
    """Rows with the list of region numbers of their series, NULL when unmapped."""
    return df.join(key_map.select(by, keys), by, "left")


def map_key_inverse(key_map: DataFrame, by: str, keys: str, out: str = "series_list") -> DataFrame:
    """Region number to the sorted list of series that carry it."""
    return key_bridge(key_map, by, keys).groupBy("key").agg(F.sort_array(F.collect_list(by)).alias(out))


def _event_keys(events: DataFrame, cols: list[str], event_id: str = "id") -> DataFrame:
    keys = F.array_distinct(F.array_compact(F.array(*[F.col(c).cast("long") for c in cols])))
    return events.select(event_id, F.explode(keys).alias("key"))


def key_in(events: DataFrame, keys: list[int], cols: list[str]) -> DataFrame:
    """Events with any of the columns in a short list of numbers; no list gives no rows."""
    hit = F.lit(False)
    for c in cols if keys else []:
        hit = hit | F.coalesce(F.col(c).isin(keys), F.lit(False))
    return events.where(hit)


def join_by_any_key(events: DataFrame, key_map: DataFrame, by: str, keys: str, cols: list[str], event_id: str = "id") -> DataFrame:
    """(event, series) pairs that share a region number through any of the event's columns."""
    bridge = key_bridge(key_map, by, keys).withColumn("key", F.col("key").cast("long"))
    return _event_keys(events, cols, event_id).join(bridge, "key").select(event_id, by).distinct()


def union_candidate_series(events: DataFrame, key_map: DataFrame, by: str, keys: str, cols: list[str], event_id: str = "id") -> DataFrame:
    """Per event the sorted distinct series reached through any source's number; empty when none."""
    reached = join_by_any_key(events, key_map, by, keys, cols, event_id)
    lists = reached.groupBy(event_id).agg(F.sort_array(F.collect_list(by)).alias("candidates"))
    empty = F.array().cast("array<bigint>")
    return events.select(event_id).join(lists, event_id, "left").withColumn("candidates", F.coalesce("candidates", empty))


def candidate_series(events: DataFrame, key_map: DataFrame, by: str, keys: str, cols: list[str], event_id: str = "id") -> DataFrame:
    """Distinct series reached by any event."""
    return join_by_any_key(events, key_map, by, keys, cols, event_id).select(by).distinct()


def key_available(wanted: DataFrame, have: DataFrame, by: str, out: str = "available") -> DataFrame:
    """Whether a wanted series key exists."""
    marked = have.select(by).distinct().withColumn(out, F.lit(True))
    return wanted.join(marked, by, "left").withColumn(out, F.coalesce(out, F.lit(False)))


def events_in_slots(events: DataFrame, series: DataFrame, by: list[str], peak: str, on: str) -> DataFrame:
    """Events with the slot that holds their peak: ``slot <= peak < next slot``.

    A peak before the first row or at or after the last row of the series has no slot and is dropped.
    """
    placed = between_join(events, series.select(*by, on), by, peak, on)
    return placed.where(F.col("slot").isNotNull() & F.col("next_slot").isNotNull()).drop("next_slot")


def count_events_in_slots(
    series: DataFrame, events: DataFrame, by: list[str], on: str, peak: str, cls: str, label: Column | None = None,
    event_id: str = "id", classes: tuple[str, ...] = CLASSES, suffix: str = "", grid: timedelta | None = None, tag: Column | None = None,
) -> DataFrame:
    """Series with a count per class and slot and, given ``label``, the ``;``-joined labels in id order.

    With ``grid`` the series is regular, its times are multiples of that width and it has ``pos`` and ``n``: the
    slot then follows from the peak alone, and the series is read once. With ``tag``, the verification of an event, ``<class>FLARE_BEST``
    has the greatest event of the slot as ``mag@id:verification``, so that later steps need not read the label texts.
    """
    if grid is None:
        slotted = events_in_slots(events, series, by, peak, on).withColumnRenamed("slot", on)
    else:
        slotted = events.where(F.col(peak).isNotNull()).withColumn(on, floor_time(F.col(peak), grid))
    letter = class_letter(F.col(cls))
    aggs = [F.count_if(letter == c).alias(f"{c}FLARE{suffix}") for c in classes]
    if label is not None:
        slotted = slotted.withColumn("__label", label)
        for c in classes:
            items = F.sort_array(F.collect_list(F.when(letter == c, F.struct(F.col(event_id), F.col("__label")))))
            aggs.append(F.array_join(F.transform(items, lambda e: e["__label"]), ";").alias(f"{c}FLARE_LABEL{suffix}"))
    if tag is not None:
        slotted = slotted.withColumn("__best", best_label(F.col(cls), F.col(event_id), tag))
        aggs += [F.max(F.when(letter == c, F.col("__best")))["label"].alias(f"{c}FLARE_BEST{suffix}") for c in classes]
    counts = slotted.groupBy(*by, on).agg(*aggs)
    out = series.join(counts, [*by, on], "left")
    if grid is not None:
        open_slot = F.col("pos") < F.col("n") - 1
        out = out.withColumns({c: F.when(open_slot, F.col(c)) for c in counts.columns if c not in (*by, on)})
    fills = {f"{c}FLARE{suffix}": F.coalesce(f"{c}FLARE{suffix}", F.lit(0)) for c in classes}
    if label is not None:
        fills |= {
            f"{c}FLARE_LABEL{suffix}": F.coalesce(F.nullif(F.col(f"{c}FLARE_LABEL{suffix}"), F.lit("")), F.lit(NO_LABEL))
            for c in classes
        }
    if tag is not None:
        fills |= {f"{c}FLARE_BEST{suffix}": F.when(F.coalesce(f"{c}FLARE{suffix}", F.lit(0)) == 0, NO_LABEL).otherwise(F.col(f"{c}FLARE_BEST{suffix}")) for c in classes}
    return out.withColumns(fills)


def _count_listed(series: DataFrame, listed: str, classes: tuple[str, ...], suffix: str, labelled: bool, tagged: bool) -> DataFrame:
    """As ``count_events_in_slots`` for rows that have the events of their slot as a list of structs: ``id``, ``letter`` and, as wanted, ``label`` and ``best``, a ``best_label``."""
    shown = [*(["label"] if labelled else []), *(["best"] if tagged else [])] or ["id"]

    def of_class(c: str, field: str) -> Column:
        return F.transform(F.filter("__items", lambda e: e["letter"] == c), lambda e: e[field])

    out = series.withColumn("__items", F.sort_array(listed)).drop(listed)
    lists = {f"__{c}_{field}": of_class(c, field) for c in classes for field in shown}  # used more than once, made once
    out = out.withColumns(lists).drop("__items")
    size = {c: F.size(f"__{c}_{shown[0]}").cast("long") for c in classes}
    made = {f"{c}FLARE{suffix}": size[c] for c in classes}
    if labelled:
        made |= {f"{c}FLARE_LABEL{suffix}": F.coalesce(F.nullif(F.array_join(f"__{c}_label", ";"), F.lit("")), F.lit(NO_LABEL)) for c in classes}
    if tagged:
        made |= {f"{c}FLARE_BEST{suffix}": F.when(size[c] == 0, NO_LABEL).otherwise(F.array_max(f"__{c}_best")["label"]) for c in classes}
    return out.withColumns(made).drop(*lists)


def event_history(
    series: DataFrame, events: DataFrame, key_map: DataFrame, by: str, on: str, mode: str = "key", labels: bool = True,
    sources: tuple[str, str, str] = ("noaa_active_region", "hinode_ar", "ssw_ar"), keys: str = "keys", grid: timedelta | None = None,
    best: bool = False,
) -> DataFrame:
    """Per-slot counts and labels of the events matched to a series by number or by location.

    Number matches whose deciding source names another region are rejected; location matches keep
    them with region -1. The latter pairs, whose number grows with the product of both sides, are lists of the slots from the start.
    """
    flags = ["primary_verified", "secondary_verified"] if labels else []
    fields = ["id", "peak_time", "goes_class", *sources, *flags]

    def described(at: Callable[[str], Column], own: Column) -> dict[str, Column]:
        region, source = pick_key_source(*[at(c) for c in sources], own)
        made = {"__region": region}
        if labels:
            tag = verification_tag(at("primary_verified"), at("secondary_verified"))
            made |= {"__lab": build_label(at("goes_class"), at("id"), region, source, tag), "__tag": tag}
        return made

    if mode != "key":
        placed = events.where(class_letter(F.col("goes_class")).isin(*CLASSES))
        placed = placed.select(*fields, "start_time", "end_time", F.col("fl_lat").alias("lat"), F.col("fl_lon").alias("lon"))

        def entry(e: Callable[[str], Column]) -> Column:
            made = {"id": e("id")}
            if labels:
                known = described(e, F.col("__keys"))
                made |= {"label": known["__lab"]} | ({"best": best_label(e("goes_class"), e("id"), known["__tag"])} if best else {})
            return F.struct(*[v.alias(n) for n, v in (made | {"letter": class_letter(e("goes_class"))}).items()])

        found = match_by_location(placed, series, [by], on, peak="peak_time", entry=entry, known=key_map.select(by, F.col(keys).alias("__keys")))
        return _count_listed(found, "matched", CLASSES, "_LOC", labels, best and labels)
    pairs = join_by_any_key(events, key_map, by, keys, list(sources))
    matched = events.select(*fields).join(pairs, "id").join(key_map.select(by, keys), by, "left")
    matched = matched.withColumns(described(F.col, F.col(keys))).where(F.col("__region") != -1)
    slim = matched.select("id", by, "peak_time", "goes_class", *(["__lab", "__tag"] if labels else []))
    return count_events_in_slots(
        series, slim, [by], on, "peak_time", "goes_class", F.col("__lab") if labels else None, grid=grid, tag=F.col("__tag") if best and labels else None,
    )


def match_reports(
    events: DataFrame, key_pairs: DataFrame, loc_pairs: DataFrame, by: str, event_id: str = "id", own_pairs: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The seven report tables of a matching run: two of events with their series, five of events.

    With ``own_pairs`` (event, series) the event tables get a column ``series``, the sorted list of the series that the event's own number
    names (NULL for none), matched or not. Pairs may be far more than events: each of the two short lists of events and of series that
    the reports need is aggregated where the pairs are found, and stored.
    """
    if own_pairs is not None:
        events = events.join(series_of_events(own_pairs, by, event_id), event_id, "left")

    def ids(pairs: DataFrame) -> DataFrame:
        return pairs.select(event_id).distinct()

    def only(pairs: DataFrame, others: DataFrame) -> DataFrame:
        return ids(pairs.join(others, by, "left_anti"))

    key_pairs = materialize(key_pairs, "key-pairs")
    key_series, loc_series = (materialize(pairs.select(by).distinct(), "matched-series") for pairs in (key_pairs, loc_pairs))
    loc_ids = materialize(ids(loc_pairs), "matched-events")
    either = ids(key_pairs.select(event_id).unionByName(loc_ids))
    return {
        "event_to_series_by_key": series_of_events(key_pairs, by, event_id),
        "event_to_series_by_location": series_of_events(loc_pairs, by, event_id),
        "only_by_key": events.join(only(key_pairs, loc_series), event_id, "left_semi"),
        "only_by_location": events.join(only(loc_pairs, key_series), event_id, "left_semi"),
        "unmatched_by_key": events.join(ids(key_pairs), event_id, "left_anti"),
        "unmatched_by_location": events.join(loc_ids, event_id, "left_anti"),
        "unmatched": events.join(either, event_id, "left_anti"),
    }


def series_of_events(pairs: DataFrame, by: str, event_id: str = "id") -> DataFrame:
    """Event to the sorted list of its series."""
    return pairs.groupBy(event_id).agg(F.sort_array(F.collect_set(by)).alias("series"))


def match_summary(series_keys: DataFrame, key_map: DataFrame, key_pairs: DataFrame, loc_pairs: DataFrame, by: str, event_id: str = "id") -> DataFrame:
    """One row of counts over a matching run."""
    k, l, m = (df.select(by).distinct().withColumn(flag, F.lit(1)) for df, flag in ((key_pairs, "__k"), (loc_pairs, "__l"), (key_map, "__m")))
    per = series_keys.select(by).distinct().join(k, by, "left").join(l, by, "left").join(m, by, "left")
    has_k, has_l = F.col("__k").isNotNull(), F.col("__l").isNotNull()
    series_side = per.agg(
        F.count_if(has_k).alias("series_key_matched"),
        F.count_if(~has_k).alias("series_key_unmatched"),
        F.count_if(has_l).alias("series_location_matched"),
        F.count_if(~has_l).alias("series_location_unmatched"),
        F.count_if(F.col("__m").isNull()).alias("series_without_key"),
        F.count_if(has_k & ~has_l).alias("series_key_only"),
        F.count_if(has_l & ~has_k).alias("series_location_only"),
    )
    marked = key_pairs.select(event_id, F.lit(True).alias("__by_key")).unionByName(loc_pairs.select(event_id, F.lit(False).alias("__by_key")))
    per_event = marked.groupBy(event_id).agg(F.bool_or("__by_key").alias("k"), F.bool_or(~F.col("__by_key")).alias("l"))
    event_side = per_event.agg(
        F.count_if("k").alias("events_key_matched"), F.count_if("l").alias("events_location_matched"),
        F.count(F.lit(1)).alias("events_matched"),
    )
    one = F.lit(1).alias("__one")
    return series_side.select(one, "*").join(event_side.select(one, "*"), "__one").drop("__one")
