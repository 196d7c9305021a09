"""Filters, set operations, sorting and de-duplication over the event catalogue."""

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.classes import class_prefix, is_flaring
from ..operators import events as E
from ..operators import series as S
from ..operators.history import key_in
from ..operators.interval import overlap_candidates, overlaps, summarize_candidates, verify_matches
from .registry import query
from .tables import CTES

FROM, TO = datetime(2024, 1, 10), datetime(2024, 1, 20, 12)
SPAN = "TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20 12:00:00'"


@query("class_prefix", "F1", "SELECT id, goes_class FROM cat WHERE goes_class LIKE 'C1%'")
def _(t):
    return t.cat.where(class_prefix(F.col("goes_class"), "C1")).select("id", "goes_class")


@query("class_at_least", "F2", "SELECT id, goes_class FROM cat WHERE goes_class > 'M2.0'")
def _(t):
    return E.class_at_least(t.cat, "M2.0").select("id", "goes_class")


@query("class_below_flux", "F2", """
SELECT id, goes_class FROM cat
WHERE CAST(substr(goes_class, 2) AS DOUBLE) * CASE substr(goes_class, 1, 1) WHEN 'A' THEN 1 WHEN 'B' THEN 10 WHEN 'C' THEN 100 WHEN 'M' THEN 1000 ELSE 10000 END > 91500""")
def _(t):
    return E.class_at_least(t.cat, "X9.15", ">", order="flux").select("id", "goes_class")


@query("same_magnitude", "F3", "SELECT id, goes_class FROM cat WHERE goes_class = 'B2.5'")
def _(t):
    return E.same_magnitude(t.cat, "B2.5").select("id", "goes_class")


@query("key_in", "F4", """
SELECT id FROM (SELECT id, ar AS a, CASE WHEN id % 2 = 0 THEN user_id + 10002 END AS b, CASE WHEN id % 3 = 0 THEN user_id + 10001 END AS c FROM cat)
WHERE a IN (10003, 10007, 10012) OR b IN (10003, 10007, 10012) OR c IN (10003, 10007, 10012)""")
def _(t):
    from .scalars import candidate_numbers

    return key_in(candidate_numbers(t.cat), [10003, 10007, 10012], ["ar", "hinode_ar", "ssw_ar"]).select("id")


for name, closed, covers, cond in (
    ("overlaps_strict", "none", "F5", "start_time < TIMESTAMP '2024-01-20 12:00:00' AND end_time > TIMESTAMP '2024-01-10'"),
    ("overlaps_inclusive", "both", "F6", "start_time <= TIMESTAMP '2024-01-20 12:00:00' AND end_time >= TIMESTAMP '2024-01-10'"),
    ("overlaps_mixed", "left", "F7", "start_time <= TIMESTAMP '2024-01-20 12:00:00' AND end_time > TIMESTAMP '2024-01-10'"),
):
    def _run(t, closed=closed):
        q = [F.lit(v).cast("timestamp_ntz") for v in (FROM, TO)]
        return t.cat.where(overlaps(F.col("start_time"), F.col("end_time"), *q, closed)).select("id")

    query(name, covers, f"SELECT id FROM cat WHERE {cond}")(_run)


@query("drop_time_range", "F8", f"SELECT user_id, ts, p_max FROM hourly WHERE NOT (ts BETWEEN {SPAN})")
def _(t):
    return S.drop_time_range(t.hourly, "ts", F.lit(FROM).cast("timestamp_ntz"), F.lit(TO).cast("timestamp_ntz")).select("user_id", "ts", "p_max")


@query("time_range_report", "F8", f"""
SELECT count(*) FILTER (inside = 0) AS out_of_range, count(*) FILTER (inside > 0 AND inside = n) AS fully_in_range,
       count(*) FILTER (inside > 0 AND inside < n) AS partially_in_range
FROM (SELECT user_id, count(*) FILTER (ts BETWEEN {SPAN}) AS inside, count(*) AS n FROM hourly GROUP BY 1)""")
def _(t):
    return S.time_range_report(t.hourly, ["user_id"], "ts", F.lit(FROM).cast("timestamp_ntz"), F.lit(TO).cast("timestamp_ntz"))


@query("split_by_location", "F9", """
SELECT id, lat IS NOT NULL OR user_id % 2 = 0 AS usable FROM cat""")
def _(t):
    rows = t.cat.withColumn("centroid", F.when(F.col("user_id") % 2 == 0, "(1, 1)"))
    good, bad = E.split_by_location(rows)
    return good.select("id", F.lit(True).alias("usable")).unionByName(bad.select("id", F.lit(False).alias("usable")))


@query("time_anomalies", "F10", """
SELECT id, anomaly FROM (
  SELECT id, unnest(['peak_before_start', 'peak_not_after_start', 'end_before_start', 'end_before_peak', 'longer_than_6h', 'longer_than_8h', 'source_peaks_differ']) AS anomaly,
         unnest([peak_time < start_time, peak_time <= start_time, end_time < start_time, end_time < peak_time, end_time - start_time > INTERVAL 6 HOUR,
                 end_time - start_time > INTERVAL 8 HOUR, abs(epoch_us(end_time) - epoch_us(peak_time)) > 2400000000]) AS hit FROM cat) WHERE hit""")
def _(t):
    return E.time_anomalies(t.cat, peaks=("end_time", "peak_time"))


@query("by_source", "F11", "SELECT id, src FROM cat WHERE src = 'signup'")
def _(t):
    return E.by_source(t.cat, "signup", "src").select("id", "src")


@query("after_before", "F12", f"SELECT id FROM cat WHERE start_time > TIMESTAMP '2024-01-10' AND end_time < TIMESTAMP '2024-01-20 12:00:00'")
def _(t):
    rows = E.after(t.cat, "start_time", F.lit(FROM).cast("timestamp_ntz"))
    return E.before(rows, "end_time", F.lit(TO).cast("timestamp_ntz")).select("id")


@query("validate_by_distance", "F13", """
SELECT substr(goes_class, 1, 1) AS class, status, count(*) AS n
FROM (SELECT goes_class, CASE WHEN coalesce(abs(x) <= 163.18, false) THEN 'validated' WHEN coalesce(abs(y) < 163.18, false) THEN 'rescued' ELSE 'invalid' END AS status FROM cat)
GROUP BY 1, 2""")
def _(t):
    rows = E.validate_by_distance(t.cat.select("goes_class", F.abs("x").alias("d1"), F.abs("y").alias("d2")), "d1", "d2")
    return rows.groupBy(F.substring("goes_class", 1, 1).alias("class"), "status").agg(F.count(F.lit(1)).alias("n"))


@query("verify_matches", "F14", """
SELECT id, coalesce(abs(x) < 275, false) AS ssw_verified, coalesce(abs(y) < 275, false) AS hinode_verified,
       coalesce(abs(x) < 275, false) OR coalesce(abs(y) < 275, false) AS primary_verified, coalesce(abs(x - y) < 275, false) AS secondary_verified FROM cat""")
def _(t):
    rows = t.cat.select("id", F.abs("x").alias("a"), F.abs("y").alias("b"), F.abs(F.col("x") - F.col("y")).alias("c"))
    return verify_matches(rows, "a", "b", "c").drop("a", "b", "c")


@query("is_near_duplicate", "F15", """
SELECT id, n, n = 1 OR (n = 2 AND coalesce(gap < 900, false)) AS near_duplicate FROM (
  SELECT g.id, count(*) AS n, sqrt(pow(arg_min(r.x, (r.start_time, r.id)) - arg_max(r.x, (r.start_time, r.id)), 2) + pow(arg_min(r.y, (r.start_time, r.id)) - arg_max(r.y, (r.start_time, r.id)), 2)) AS gap
  FROM goes g JOIN (SELECT id, start_time, end_time, goes_class, coalesce(x, 1e300 * 1e300) AS x, coalesce(y, 1e300 * 1e300) AS y FROM ssw) r
    ON r.goes_class = g.goes_class AND r.start_time < g.end_time AND r.end_time > g.start_time GROUP BY g.id)""")
def _(t):
    return summarize_candidates(overlap_candidates(t.goes, t.ssw), near=900).select("id", "n", "near_duplicate")


@query("source_split", "F16", """
SELECT id, CASE WHEN b IS NULL THEN 'first_only' WHEN a IS NULL THEN 'second_only' ELSE 'both' END AS origin
FROM (SELECT id, CASE WHEN id % 2 = 0 THEN raw_ar END AS a, CASE WHEN id % 3 = 0 THEN user_id END AS b FROM cat)
WHERE (a IS NOT NULL OR b IS NOT NULL) AND (coalesce(a <> 0, false) OR coalesce(b <> 0, false))""")
def _(t):
    i = F.col("id")
    rows = t.cat.select("id", F.when(i % 2 == 0, F.col("raw_ar")).alias("a"), F.when(i % 3 == 0, F.col("user_id")).alias("b"))
    return E.source_split(rows, "a", "b").select("id", "origin")


@query("active_slots", "F17", "SELECT user_id, ts, p_n FROM (SELECT user_id, ts, coalesce(p_n, 0) AS p_n FROM grid) WHERE p_n <> 0")
def _(t):
    return S.active_slots(t.grid.select("user_id", "ts", F.coalesce("p_n", F.lit(0)).alias("p_n")), "p_n")


@query("is_flaring", "F18", "SELECT sample_id, flaring FROM samples")
def _(t):
    name = F.concat(F.col("sample_id").cast("string"), F.when(F.col("flaring"), "_flare_").otherwise("_quiet_"), F.lit("x"))
    return t.samples.select("sample_id", is_flaring(name).alias("flaring"))


# Copies of events: every event of even users appears twice, with a higher id.
CTES["copies"] = "SELECT * FROM goes UNION ALL SELECT * REPLACE (id + 100000000 AS id) FROM goes WHERE user_id % 2 = 0"


def copies(t):
    return t.goes.unionByName(t.goes.where(F.col("user_id") % 2 == 0).withColumn("id", F.col("id") + 100000000))


@query("union_all", "U1", """
SELECT id, src, x, n FROM (SELECT id, src, x FROM goes UNION ALL SELECT id, src, NULL AS x FROM ssw UNION ALL SELECT id, src, x FROM xrt), (SELECT (SELECT count(*) FROM goes) + (SELECT count(*) FROM ssw) + (SELECT count(*) FROM xrt) AS n)""")
def _(t):
    rows, counts = E.union_checked([t.goes.select("id", "src", "x"), t.ssw.select("id", "src"), t.xrt.select("id", "src", "x")], "union")
    return rows.withColumn("n", F.lit(sum(counts)).cast("long"))


@query("dedupe_first", "U2", """
SELECT id, row_number() OVER (PARTITION BY start_time, end_time, peak_time, raw_ar, goes_class, goes_location ORDER BY id) = 1 AS kept FROM copies""")
def _(t):
    rows = copies(t).withColumn("noaa_active_region", F.col("raw_ar"))
    kept, dropped = E.dedupe_first(rows)
    return kept.select("id", F.lit(True).alias("kept")).unionByName(dropped.select("id", F.lit(False).alias("kept")))


@query("set_difference", "U3", "SELECT user_id FROM goes WHERE goes_class >= 'M' EXCEPT SELECT user_id FROM ssw WHERE goes_class >= 'X'")
def _(t):
    return E.set_difference(t.goes.where(F.col("goes_class") >= "M"), t.ssw.where(F.col("goes_class") >= "X"), "user_id")


@query("tagged_union", "U4", """
SELECT id, goes_class, lat IS NULL AS is_no_loc, lat IS NOT NULL AS is_invalid FROM goes WHERE lat IS NULL OR abs(lat) > 40""")
def _(t):
    cols = t.goes.select("id", "goes_class", "lat")
    groups = {"is_no_loc": cols.where(F.col("lat").isNull()), "is_invalid": cols.where(F.abs("lat") > 40)}
    return E.tagged_union(groups).drop("lat")


@query("unmatched_keys", "U5", """
SELECT DISTINCT ar AS noaa_active_region FROM goes WHERE goes_class > 'B' AND ar IS NOT NULL AND id NOT IN (SELECT id FROM goes WHERE goes_class >= 'M')""")
def _(t):
    rows = t.goes.withColumn("noaa_active_region", F.col("ar"))
    return E.unmatched_keys(rows, rows.where(F.col("goes_class") >= "M"))


@query("sort_by", "O1", "SELECT user_id, min(start_time) AS st, max(end_time) AS et FROM goes GROUP BY 1 ORDER BY et, user_id")
def _(t):
    spans = t.goes.groupBy("user_id").agg(F.min("start_time").alias("st"), F.max("end_time").alias("et"))
    return E.sort_by(spans, ["et", "user_id"])


@query("nearest_one", "O2", """
SELECT user_id, metric, id, goes_class FROM (SELECT user_id, abs(x) AS metric, id, goes_class, row_number() OVER (PARTITION BY user_id ORDER BY abs(x), id) AS rn FROM cat WHERE x IS NOT NULL) WHERE rn = 1""")
def _(t):
    rows = t.cat.where(F.col("x").isNotNull()).withColumn("metric", F.abs("x"))
    return E.nearest_one(rows, ["user_id"], "metric", "id", ["goes_class"])


@query("max_label", "O3", "SELECT id, greatest(goes_class, 'C' || (user_id % 9 + 1) || '.0') AS max_label FROM cat")
def _(t):
    both = F.array("goes_class", F.concat(F.lit("C"), (F.col("user_id") % 9 + 1).cast("string"), F.lit(".0")))
    return E.max_label(t.cat.select("id", both.alias("labels")), "labels").drop("labels")


@query("head", "O4", "SELECT id, start_time FROM cat ORDER BY start_time, id LIMIT 5")
def _(t):
    return E.head(t.cat.select("id", "start_time"), 5, ["start_time", "id"])
