"""Counts, rates and distance statistics over the event catalogue."""

from pyspark.sql import functions as F

from ..operators import events as E
from .registry import query
from .tables import CTES, R, r6

LETTER = "substr(goes_class, 1, 1)"


def named(t):
    return t.cat.withColumn("noaa_active_region", F.col("raw_ar"))


@query("count_by_class", "A1", f"SELECT {LETTER} AS class, count(*) AS n FROM cat GROUP BY 1")
def _(t):
    return E.count_by_class(t.cat)


@query("completeness_table", "A2", f"""
SELECT {LETTER} AS class, count(*) AS total, count(*) FILTER (raw_ar <> 0) AS with_key, count(*) FILTER (raw_ar = 0) AS without_key,
       count(*) FILTER (lat IS NOT NULL) AS with_location, count(*) FILTER (lat IS NULL) AS without_location,
       count(*) FILTER (raw_ar <> 0 AND lat IS NOT NULL) AS key_and_location, count(*) FILTER (raw_ar = 0 AND lat IS NULL) AS no_key_no_location
FROM cat GROUP BY 1""")
def _(t):
    return E.completeness_table(named(t))


@query("nested_counts", "A3", f"""
SELECT class, has_key, has_location, count(*) AS n, CASE grouping_id(class, has_key, has_location) WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS level
FROM (SELECT CASE {LETTER} WHEN 'A' THEN 'B' WHEN 'X' THEN 'M' ELSE {LETTER} END AS class, raw_ar <> 0 AS has_key, lat IS NOT NULL AS has_location FROM cat)
GROUP BY GROUPING SETS ((class), (class, has_key), (class, has_key, has_location))""")
def _(t):
    return E.nested_counts(named(t))


@query("monthly_counts", "A4", f"""
SELECT strftime(start_time, '%Y-%m') AS year_month, {LETTER} AS class, count(*) AS n FROM cat WHERE {LETTER} > 'C' GROUP BY 1, 2""")
def _(t):
    return E.monthly_counts(t.cat)


def _shares(groups):
    share = "count(DISTINCT CASE WHEN {c} AND d < hi THEN d END)::DOUBLE / (date_diff('day', any_value(lo), any_value(hi)) + 1)"
    return " UNION ALL ".join(f"SELECT '{g}' AS class_group, {R(share.format(c=c))} AS share FROM days" for g, c in groups.items())


CTES["days"] = """
SELECT goes_class, CAST(peak_time AS DATE) AS d, (SELECT CAST(min(start_time) AS DATE) FROM goes) AS lo, (SELECT CAST(max(start_time) AS DATE) FROM goes) AS hi FROM goes
"""


@query("climatology", "A13", _shares({
    "x": "goes_class LIKE 'X%'", "m": "goes_class LIKE 'M%'", "c": "goes_class LIKE 'C%'", "b": "goes_class LIKE 'B%'",
    "mx": "goes_class > 'M'", "bc": "goes_class < 'M'"}))
def _(t):
    return E.climatology(t.goes).select("class_group", r6(F.col("share")).alias("share"))


CTES["dists"] = "SELECT id, goes_class, sqrt(x * x + y * y) AS d1, CASE WHEN id % 4 <> 0 THEN value * 2 END AS d2 FROM cat"


def dists(t):
    d1 = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y"))
    return t.cat.select("id", "goes_class", d1.alias("d1"), F.when(F.col("id") % 4 != 0, F.col("value") * 2).alias("d2"))


@query("distance_summary", "A16", f"""
SELECT count(*) AS n, {R("avg(d)")} AS mean, {R("stddev_samp(d)")} AS std, {R("quantile_cont(d, 0.5)")} AS median, {R("quantile_cont(d, 0.95)")} AS q95
FROM (SELECT least(d1, d2) AS d FROM dists WHERE d1 IS NOT NULL AND d2 IS NOT NULL)""")
def _(t):
    return E.distance_summary(dists(t), "d1", "d2").select("n", *[r6(F.col(c)).alias(c) for c in ("mean", "std", "median", "q95")])


@query("distance_summary_large", "A16", f"""
SELECT count(*) AS n, {R("avg(d)")} AS mean, {R("stddev_samp(d)")} AS std, {R("quantile_cont(d, 0.5)")} AS median, {R("quantile_cont(d, 0.95)")} AS q95
FROM (SELECT least(d1, d2) AS d FROM dists WHERE d1 IS NOT NULL AND d2 IS NOT NULL AND goes_class > 'C')""")
def _(t):
    large = E.class_at_least(dists(t), "C")
    return E.distance_summary(large, "d1", "d2").select("n", *[r6(F.col(c)).alias(c) for c in ("mean", "std", "median", "q95")])


@query("histogram_fixed", "A17", """
SELECT CAST(bin AS BIGINT) AS bin, (SELECT min(d2) FROM dists) + bin * 8 AS low, count(d2) AS n
FROM (SELECT unnest(generate_series(0, CAST(ceil((408 - (SELECT min(d2) FROM dists)) / 8) AS BIGINT) - 1)) AS bin) b
LEFT JOIN (SELECT d2, least(CAST(floor((d2 - (SELECT min(d2) FROM dists)) / 8) AS BIGINT), CAST(ceil((408 - (SELECT min(d2) FROM dists)) / 8) AS BIGINT) - 1) AS k FROM dists WHERE d2 IS NOT NULL) h
ON b.bin = h.k GROUP BY bin""")
def _(t):
    return E.histogram_fixed(dists(t), "d2")


@query("invalid_event_breakdown", "A23", f"""
SELECT CASE {LETTER} WHEN 'A' THEN 'B' ELSE {LETTER} END AS class, count(*) FILTER (s = 'validated') AS validated, count(*) FILTER (s = 'no_location') AS no_location,
       count(*) FILTER (s = 'removed') AS removed
FROM (SELECT goes_class, CASE WHEN lat IS NULL THEN 'no_location' WHEN abs(x) <= 163.18 OR abs(y) < 163.18 THEN 'validated' ELSE 'removed' END AS s FROM cat) GROUP BY 1""")
def _(t):
    status = E.validation_status(F.abs("x"), F.abs("y"), 163.18)
    rows = t.cat.withColumn("status", F.when(F.col("lat").isNull(), "no_location").when(status == "invalid", "removed").otherwise("validated"))
    return E.invalid_event_breakdown(rows)
