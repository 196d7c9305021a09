"""As-of, overlap, cross-match and key joins."""

from datetime import timedelta

from pyspark.sql import functions as F

from ..operators import asof as A
from ..operators import history as H
from ..operators import interval as I
from ..operators.events import merge_sources_outer
from .registry import query
from .scalars import ROTATION, candidate_numbers
from .tables import CTES, R, r6

HALF_HOUR = timedelta(minutes=30)
BOX = ["lat_min", "lat_max", "lon_min", "lon_max"]


def nearest_sql(tolerance_minutes: int, cols: str) -> str:
    return f"""
    SELECT user_id, ts, {cols} FROM (
      SELECT s.user_id, s.ts, h.*  EXCLUDE (user_id),
             row_number() OVER (PARTITION BY s.user_id, s.ts ORDER BY abs(epoch_us(h.hts) - epoch_us(s.ts)), h.hts DESC) AS rn
      FROM hourly s LEFT JOIN header h ON s.user_id = h.user_id AND abs(epoch_us(h.hts) - epoch_us(s.ts)) <= {tolerance_minutes * 60_000_000})
    WHERE rn = 1"""


@query("asof_nearest", "J1", nearest_sql(360, "hid, lat_min, lat_max, lon_min, lon_max, quality, hts AS match_time"))
def _(t):
    return A.asof_join(
        t.hourly.select("user_id", "ts"), t.header, ["user_id"], "ts", "hts", ["hid", *BOX, "quality"], tolerance=timedelta(hours=6), match_time="match_time"
    )


@query("asof_nearest_subset", "J2", nearest_sql(30, "lat_min, lat_max, lon_min, lon_max"))
def _(t):
    return A.attach_header(t.hourly.select("user_id", "ts"), t.header, ["user_id"], "ts", "hts", BOX, tolerance=HALF_HOUR)


@query("asof_nearest_unbounded", "J1", """
SELECT user_id, ts, hid, (round(delta, 9) + 0.0) AS delta_days FROM (
  SELECT s.user_id, s.ts, h.hid, (epoch_us(h.hts) - epoch_us(s.ts)) / 86400000000.0::DOUBLE AS delta,
         row_number() OVER (PARTITION BY s.user_id, s.ts ORDER BY abs(epoch_us(h.hts) - epoch_us(s.ts)), h.hts DESC) AS rn
  FROM hourly s LEFT JOIN header h ON s.user_id = h.user_id) WHERE rn = 1""")
def _(t):
    out = A.asof_join(t.hourly.select("user_id", "ts"), t.header, ["user_id"], "ts", "hts", ["hid"], delta_days="delta_days")
    return out.withColumn("delta_days", F.round("delta_days", 9) + F.lit(0.0))


@query("asof_measured_cells", "J1", """
SELECT g.id, h.hts AS match_time FROM goes g ASOF LEFT JOIN (SELECT DISTINCT hts FROM header) h ON g.start_time >= h.hts""")
def _(t):
    """All events and all header rows under one key, in cells of at most 200 rows."""
    one = F.lit(1).alias("axis")
    left, right = t.goes.select(one, "id", "start_time"), t.header.select(one, "hts")
    return A.asof_join(left, right, ["axis"], "start_time", "hts", [], direction="prev", match_time="match_time", most=200).select("id", "match_time")


@query("attach_header_checked", "J1", """
SELECT g.user_id, g.start_time AS ts, (SELECT arg_min(h.hid, abs(epoch_us(h.hts) - epoch_us(g.start_time))) FROM header h
                         WHERE h.user_id = g.user_id AND abs(epoch_us(h.hts) - epoch_us(g.start_time)) <= 21600000000) AS hid
FROM goes g WHERE user_id IN (SELECT a.user_id FROM (SELECT user_id, count(*) AS n FROM header GROUP BY 1) a JOIN (SELECT user_id, count(*) AS n FROM goes GROUP BY 1) b ON a.user_id = b.user_id AND a.n = b.n)""")
def _(t):
    series = t.goes.select("user_id", F.col("start_time").alias("ts"))
    return A.attach_header(series, t.header, ["user_id"], "ts", "hts", ["hid"], tolerance=timedelta(hours=6), check_lengths=True)


CTES["nearreg"] = """
SELECT id, ar, peak_time, lat AS e_lat, lon AS e_lon, r_lat, r_lon, location, delta FROM (
  SELECT g.id, g.ar, g.peak_time, g.lat, g.lon, r.lat AS r_lat, r.lon AS r_lon, r.location, (epoch_us(r.ar_time) - epoch_us(g.peak_time)) / 86400000000.0::DOUBLE AS delta,
         row_number() OVER (PARTITION BY g.id ORDER BY abs(epoch_us(r.ar_time) - epoch_us(g.peak_time))) AS rn,
         count(*) OVER (PARTITION BY g.id, abs(epoch_us(r.ar_time) - epoch_us(g.peak_time))) AS ties
  FROM goes g JOIN regtext r ON g.ar = r.region WHERE abs(epoch_us(r.ar_time) - epoch_us(g.peak_time)) < 259200000000)
WHERE rn = 1 AND ties = 1
"""


def regions_for(t):
    return t.regtext.withColumnsRenamed({"region": "ar"})


@query("nearest_region", "J3", """
SELECT g.id, n.location, (round(n.delta, 9) + 0.0) AS delta_days FROM goes g LEFT JOIN nearreg n ON g.id = n.id""")
def _(t):
    out = A.nearest_region(t.goes.select("id", "ar", "peak_time"), regions_for(t), ["ar"], "peak_time", "ar_time", ["location"])
    return out.select("id", "location", (F.round("delta_days", 9) + F.lit(0.0)).alias("delta_days"))


REG_ROT = ROTATION.replace("lat", "r_lat")


@query("attach_centroid", "J4", f"""
SELECT g.id, CASE WHEN r_lon IS NOT NULL THEN {R(f"greatest(-90.0, least(90.0, r_lon + {REG_ROT} * (-delta)))")} END AS c_lon, CAST(r_lat AS DOUBLE) + 0.0 AS c_lat FROM goes g LEFT JOIN
 (SELECT * FROM nearreg) n ON g.id = n.id""")
def _(t):
    out = A.attach_centroid(t.goes.select("id", "ar", "peak_time"), regions_for(t), ["ar"], "peak_time", "ar_time")
    return out.select("id", r6(F.col("centroid_lon")).alias("c_lon"), (F.col("centroid_lat") + F.lit(0.0)).alias("c_lat"))


@query("distance_to_region", "J5", f"""
SELECT g.id, {R("sqrt(pow(sin(radians(e_lon)) * cos(radians(e_lat)) - sin(radians(r_lon)) * cos(radians(r_lat)), 2) + pow(sin(radians(e_lat)) - sin(radians(r_lat)), 2))")} AS region_dist
FROM goes g LEFT JOIN nearreg n ON g.id = n.id""")
def _(t):
    events = t.goes.select("id", "ar", "peak_time", F.col("lon").alias("e_lon"), F.col("lat").alias("e_lat"))
    out = A.distance_to_region(events, regions_for(t), ["ar"], "peak_time", "ar_time", ("e_lon", "e_lat"), ("lon", "lat"))
    return out.select("id", r6(F.col("region_dist")).alias("region_dist"))


@query("region_distance_to_center", "J6", f"""
SELECT g.id, {R("sqrt(pow(sin(radians(r_lon)) * cos(radians(r_lat)), 2) + pow(sin(radians(r_lat)), 2))")} AS center_dist
FROM goes g LEFT JOIN nearreg n ON g.id = n.id""")
def _(t):
    out = A.region_distance_to_center(t.goes.select("id", "ar", "peak_time"), regions_for(t), ["ar"], "peak_time", "ar_time", ("lon", "lat"))
    return out.select("id", r6(F.col("center_dist")).alias("center_dist"))


def cand_sql(right: str, eq: str = "AND l.goes_class = r.goes_class", time: str = "r.start_time < l.end_time AND r.end_time > l.start_time") -> str:
    return f"""
    SELECT l.id, l.x IS NOT NULL AS located, sqrt(pow(r.x - l.x, 2) + pow(r.y - l.y, 2)) AS dist, r.start_time AS c_st, r.id AS c_id, r.x AS c_x, r.y AS c_y, r.ar AS c_ar
    FROM goes l JOIN {right} r ON {time} {eq}"""


CTES["cs"] = cand_sql("ssw")
CTES["ch"] = cand_sql("xrt")


@query("match_overlap_nearest", "J7", f"""
SELECT id, located, c_id AS match_id, {R("dist")} AS dist, c_x AS match_x, c_y AS match_y, c_ar AS match_ar FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY coalesce(dist, 1e300), c_st, c_id) AS rn FROM cs) WHERE NOT located OR rn = 1""")
def _(t):
    return I.match_overlap_nearest(t.goes, t.ssw, radius=275.0).withColumn("dist", r6(F.col("dist")))


@query("min_distance_overlap", "J8", f"""
SELECT id, {R("min(dist)")} AS ssw_dist FROM ({cand_sql("ssw", time="r.start_time <= l.end_time AND r.end_time > l.start_time")}) GROUP BY 1""")
def _(t):
    return I.min_distance_overlap(t.goes, t.ssw, "ssw_dist").withColumn("ssw_dist", r6(F.col("ssw_dist")))


@query("min_distance_overlap_any_class", "J8", f"""
SELECT id, {R("min(dist)")} AS fd_dist FROM ({cand_sql("xrt", eq="", time="r.start_time <= l.end_time AND r.end_time > l.start_time")}) GROUP BY 1""")
def _(t):
    return I.min_distance_overlap(t.goes, t.xrt, "fd_dist", eq_class=False, radius=275.0).withColumn("fd_dist", r6(F.col("fd_dist")))


CTES["pairs_ab"] = """
SELECT s.id, s.c_id AS a_id, h.c_id AS b_id, s.c_x AS a_x, s.c_y AS a_y, s.c_ar AS a_ar, h.c_x AS b_x, h.c_y AS b_y, h.c_ar AS b_ar,
       pow(s.c_x - h.c_x, 2) + pow(s.c_y - h.c_y, 2) AS d2,
       row_number() OVER (PARTITION BY s.id ORDER BY coalesce(pow(s.c_x - h.c_x, 2) + pow(s.c_y - h.c_y, 2), 1e300), s.c_st, s.c_id, h.c_st, h.c_id) AS rn
FROM cs s JOIN ch h ON s.id = h.id
"""


@query("closest_pair", "J9", f"SELECT id, a_id, b_id, {R('sqrt(d2)')} AS pair_dist FROM pairs_ab WHERE rn = 1")
def _(t):
    p = I.closest_overlapping_pair(t.goes, t.ssw, t.xrt)
    gap = F.when(F.col("d2") != float("inf"), F.sqrt("d2"))
    return p.select("id", F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"), r6(gap).alias("pair_dist"))


def side_sql(name: str) -> str:
    return f"""
    SELECT id, any_value(located) AS located, count(*) AS n, count(c_x) AS nl,
           arg_min(c_id, (coalesce(dist, 1e300), c_st, c_id)) AS near_id, min(dist) AS near_dist, arg_min(c_id, (c_st, c_id)) AS first_id, arg_max(c_id, (c_st, c_id)) AS last_id,
           count(*) = 1 OR (count(*) = 2 AND coalesce(sqrt(pow(any_value(fx) - any_value(lx), 2) + pow(any_value(fy) - any_value(ly), 2)) < 50, false)) AS dup
    FROM (SELECT c.*, f.x AS fx, f.y AS fy, l.x AS lx, l.y AS ly
          FROM (SELECT *, first_value(c_id) OVER (PARTITION BY id ORDER BY c_st, c_id) AS fid, first_value(c_id) OVER (PARTITION BY id ORDER BY c_st DESC, c_id DESC) AS lid FROM {name}) c
          JOIN cat f ON f.id = c.fid JOIN cat l ON l.id = c.lid) GROUP BY 1"""


CTES["side_s"] = side_sql("cs")
CTES["side_h"] = side_sql("ch")
CTES["resolved"] = """
SELECT id, CASE WHEN located THEN s_near WHEN by_pair THEN a_id ELSE s_first END AS s_id, CASE WHEN located THEN s_dist END AS s_dist,
       CASE WHEN located THEN h_near WHEN by_pair THEN b_id ELSE h_first END AS h_id, CASE WHEN located THEN h_dist END AS h_dist
FROM (SELECT b.*, p.a_id, p.b_id FROM (
        SELECT coalesce(s.id, h.id) AS id, coalesce(s.located, h.located) AS located, s.near_id AS s_near, s.near_dist AS s_dist, s.first_id AS s_first,
               h.near_id AS h_near, h.near_dist AS h_dist, h.first_id AS h_first,
               coalesce(NOT coalesce(s.located, h.located) AND h.id IS NOT NULL
                        AND ((s.n > 1 AND NOT s.dup AND s.nl > 0) OR (s.n = 1 AND h.n > 1 AND NOT h.dup AND h.nl > 0)), false) AS by_pair
        FROM side_s s FULL OUTER JOIN side_h h ON s.id = h.id) b LEFT JOIN (SELECT * FROM pairs_ab WHERE rn = 1) p ON b.id = p.id)
"""


@query("resolve_secondary_matches", "J10 F15", f"SELECT id, s_id, {R('s_dist')} AS s_dist, h_id, {R('h_dist')} AS h_dist FROM resolved")
def _(t):
    out = I.resolve_secondary_matches(t.ssw, t.xrt, base=t.goes, radius=275.0)
    return out.select(
        "id", F.col("second.id").alias("s_id"), r6(F.col("second_dist")).alias("s_dist"), F.col("third.id").alias("h_id"), r6(F.col("third_dist")).alias("h_dist")
    )


CTES["anykey"] = """
SELECT DISTINCT e.id, b.user_id FROM (
  SELECT id, ar AS key FROM cat UNION SELECT id, user_id + 10002 FROM cat WHERE id % 2 = 0 UNION SELECT id, user_id + 10001 FROM cat WHERE id % 3 = 0) e
JOIN bridge b ON e.key = b.key
"""
NUMBERS = ["ar", "hinode_ar", "ssw_ar"]


@query("join_by_any_key", "J11", "SELECT id, user_id FROM anykey")
def _(t):
    return H.join_by_any_key(candidate_numbers(t.cat), t.keymap, "user_id", "keys", NUMBERS)


@query("map_key", "J12", "SELECT h.user_id, h.ts, k.keys_text FROM hourly h LEFT JOIN keymap k ON h.user_id = k.user_id")
def _(t):
    out = H.map_key(t.hourly.select("user_id", "ts"), t.keymap, "user_id", "keys")
    return out.select("user_id", "ts", F.array_join(F.transform("keys", lambda k: k.cast("string")), ",").alias("keys_text"))


@query("map_key_inverse", "J12", "SELECT key, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS series FROM bridge GROUP BY 1")
def _(t):
    out = H.map_key_inverse(t.keymap, "user_id", "keys")
    return out.select("key", F.array_join(F.transform("series_list", lambda k: k.cast("string")), ",").alias("series"))


@query("map_key_nations", "J12", "SELECT r_name AS region_name, string_agg(n_name, ',' ORDER BY n_name) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def _(t):
    nations = t.read("nation").select(F.col("n_name").alias("name"), F.array("n_regionkey").alias("keys"))
    lists = H.map_key_inverse(nations, "name", "keys")
    named = lists.join(t.read("region"), F.col("key") == F.col("r_regionkey"))
    return named.select(F.col("r_name").alias("region_name"), F.array_join("series_list", ",").alias("nations"))


CTES["byplace"] = """
SELECT id, user_id FROM (
  SELECT e.id, h.user_id, e.lat, e.lon, h.lat_min, h.lat_max, h.lon_min, h.lon_max,
         row_number() OVER (PARTITION BY e.id, h.user_id ORDER BY abs(epoch_us(h.hts) - epoch_us(e.start_time)), h.hts DESC) AS rn
  FROM goes e JOIN (SELECT user_id, min(hts) AS f, max(hts) AS l FROM header GROUP BY 1) s ON e.end_time >= s.f AND e.start_time <= s.l
  JOIN header h ON h.user_id = s.user_id) WHERE rn = 1 AND lat BETWEEN lat_min AND lat_max AND lon BETWEEN lon_min AND lon_max
"""


def by_place(t):
    return I.match_by_location(t.goes, t.header, ["user_id"], "hts")


@query("match_by_location", "J13", "SELECT id, user_id FROM byplace")
def _(t):
    return by_place(t)


CTES["bykey"] = "SELECT id, user_id FROM anykey WHERE id IN (SELECT id FROM goes)"


def by_key(t):
    return H.join_by_any_key(candidate_numbers(t.goes), t.keymap, "user_id", "keys", NUMBERS)


@query("match_reports", "J14 S16", """
SELECT 'only_by_key' AS report, id FROM (SELECT DISTINCT id FROM bykey WHERE user_id NOT IN (SELECT user_id FROM byplace))
UNION ALL SELECT 'only_by_location', id FROM (SELECT DISTINCT id FROM byplace WHERE user_id NOT IN (SELECT user_id FROM bykey))
UNION ALL SELECT 'unmatched_by_key', id FROM goes WHERE id NOT IN (SELECT id FROM bykey)
UNION ALL SELECT 'unmatched_by_location', id FROM goes WHERE id NOT IN (SELECT id FROM byplace)
UNION ALL SELECT 'unmatched', id FROM goes WHERE id NOT IN (SELECT id FROM bykey UNION SELECT id FROM byplace)""")
def _(t):
    reports = H.match_reports(t.goes.select("id"), by_key(t), by_place(t), "user_id")
    names = ["only_by_key", "only_by_location", "unmatched_by_key", "unmatched_by_location", "unmatched"]
    out = None
    for name in names:
        part = reports[name].select(F.lit(name).alias("report"), "id")
        out = part if out is None else out.unionByName(part)
    return out


@query("series_of_events", "A14 S16", """
SELECT id, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS series FROM (SELECT DISTINCT id, user_id FROM bykey) GROUP BY 1""")
def _(t):
    out = H.series_of_events(by_key(t), "user_id")
    return out.select("id", F.array_join(F.transform("series", lambda k: k.cast("string")), ",").alias("series"))


@query("match_summary", "A14", """
SELECT count(*) FILTER (k) AS series_key_matched, count(*) FILTER (NOT k) AS series_key_unmatched, count(*) FILTER (l) AS series_location_matched,
       count(*) FILTER (NOT l) AS series_location_unmatched, count(*) FILTER (NOT m) AS series_without_key,
       count(*) FILTER (k AND NOT l) AS series_key_only, count(*) FILTER (l AND NOT k) AS series_location_only,
       (SELECT count(DISTINCT id) FROM bykey) AS events_key_matched, (SELECT count(DISTINCT id) FROM byplace) AS events_location_matched,
       (SELECT count(*) FROM (SELECT id FROM bykey UNION SELECT id FROM byplace)) AS events_matched
FROM (SELECT user_id, user_id IN (SELECT user_id FROM bykey) AS k, user_id IN (SELECT user_id FROM byplace) AS l, user_id IN (SELECT user_id FROM keymap) AS m
      FROM (SELECT DISTINCT user_id FROM hourly))""")
def _(t):
    return H.match_summary(t.hourly, t.keymap, by_key(t), by_place(t), "user_id")


@query("regions_in_box", "J17", f"""
SELECT h.user_id, h.hts, coalesce(f.txt, '') AS region_numbers FROM header h LEFT JOIN (
  SELECT b.user_id, b.hts, string_agg(CAST(r.region AS VARCHAR), ';' ORDER BY r.region) AS txt
  FROM header b JOIN regions r ON r.ar_time = date_trunc('day', b.hts + INTERVAL 12 HOUR - INTERVAL 1 MICROSECOND)
  WHERE b.user_id IN (SELECT user_id FROM keymap) AND r.lat BETWEEN b.lat_min - 3 AND b.lat_max + 3
    AND r.lon + {ROTATION.replace("lat", "r.lat")} * ((epoch_us(b.hts) - epoch_us(r.ar_time)) / 86400000000.0::DOUBLE) BETWEEN b.lon_min - 3 AND b.lon_max + 3
  GROUP BY 1, 2) f ON h.user_id = f.user_id AND h.hts = f.hts""")
def _(t):
    return I.regions_in_box(t.header, t.regions, ["user_id"], "hts", keyed=t.keymap).select("user_id", "hts", "region_numbers")


@query("regions_in_box_wide", "J17", f"""
SELECT h.user_id, h.hts, coalesce(f.txt, '') AS region_numbers FROM header h LEFT JOIN (
  SELECT b.user_id, b.hts, string_agg(CAST(r.region AS VARCHAR), ';' ORDER BY r.region) AS txt
  FROM header b JOIN (SELECT region, lat, lon, ar_time + to_hours(CAST(region % 24 AS INTEGER)) AS ar_time FROM regions) r
    ON r.ar_time >= b.hts - INTERVAL 36 HOUR AND r.ar_time < b.hts + INTERVAL 36 HOUR
  WHERE r.lat BETWEEN b.lat_min - 3 AND b.lat_max + 3
    AND r.lon + {ROTATION.replace("lat", "r.lat")} * ((epoch_us(b.hts) - epoch_us(r.ar_time)) / 86400000000.0::DOUBLE) BETWEEN b.lon_min - 3 AND b.lon_max + 3
  GROUP BY 1, 2) f ON h.user_id = f.user_id AND h.hts = f.hts""")
def _(t):
    shifted = t.regions.withColumn("ar_time", F.col("ar_time") + F.make_dt_interval(hours=(F.col("region") % 24).cast("int")))
    return I.regions_in_box(t.header, shifted, ["user_id"], "hts", window=timedelta(hours=36)).select("user_id", "hts", "region_numbers")


@query("asof_missing_keys", "J1", """
SELECT g.id, (SELECT max(r.ar_time) FROM regions r WHERE r.region % 5 <> 0 AND r.region = g.ar AND r.ar_time <= g.start_time) AS last_time FROM goes g""")
def _(t):
    right = t.regions.select(F.when(F.col("region") % 5 != 0, F.col("region")).alias("ar"), F.col("ar_time").alias("last_time"))
    return A.asof_join(t.goes.select("id", "ar", "start_time"), right, ["ar"], "start_time", "last_time", ["last_time"], direction="prev").select("id", "last_time")


@query("exists_in_window", "J20", """
SELECT w.id, (SELECT min(e.peak_time) FROM xrt e WHERE e.goes_class > 'M' AND e.peak_time > w.start_time AND e.peak_time < w.end_time) AS ev_time,
       (SELECT arg_min(e.goes_class, (e.peak_time, e.id)) FROM xrt e WHERE e.goes_class > 'M' AND e.peak_time > w.start_time AND e.peak_time < w.end_time) AS ev_goes_class FROM goes w""")
def _(t):
    events = t.xrt.where(F.col("goes_class") > "M").select("peak_time", "goes_class")
    return I.exists_in_window(t.goes.select("id", "start_time", "end_time"), events, "start_time", "end_time", "peak_time", ["goes_class"]).select("id", "ev_time", "ev_goes_class")


@query("merge_sources_outer", "J21", """
SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.goes_class, b.goes_class) AS goes_class, a.n AS n_first, b.n AS n_second,
       CASE WHEN b.n IS NULL THEN 'first_only' WHEN a.n IS NULL THEN 'second_only' ELSE 'both' END AS provenance
FROM (SELECT user_id, goes_class, count(*) AS n FROM goes GROUP BY 1, 2) a FULL OUTER JOIN (SELECT user_id, goes_class, count(*) AS n FROM ssw GROUP BY 1, 2) b
ON a.user_id = b.user_id AND a.goes_class = b.goes_class""")
def _(t):
    a = t.goes.groupBy("user_id", "goes_class").agg(F.count(F.lit(1)).alias("n_first"))
    b = t.ssw.groupBy("user_id", "goes_class").agg(F.count(F.lit(1)).alias("n_second"))
    return merge_sources_outer(a, b, ["user_id", "goes_class"])


@query("union_candidate_series", "J22", """
SELECT c.id, coalesce(l.txt, '') AS candidates FROM cat c LEFT JOIN (SELECT id, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS txt FROM anykey GROUP BY 1) l ON c.id = l.id""")
def _(t):
    out = H.union_candidate_series(candidate_numbers(t.cat), t.keymap, "user_id", "keys", NUMBERS)
    return out.select("id", F.array_join(F.transform("candidates", lambda k: k.cast("string")), ",").alias("candidates"))


@query("candidate_series", "J22", "SELECT DISTINCT user_id FROM anykey")
def _(t):
    return H.candidate_series(candidate_numbers(t.cat), t.keymap, "user_id", "keys", NUMBERS)


@query("key_available", "J24", """
SELECT user_id, user_id IN (SELECT user_id FROM header) AS available FROM (SELECT DISTINCT user_id FROM goes)""")
def _(t):
    wanted = t.goes.select("user_id").distinct()
    return H.key_available(wanted, t.header, "user_id")


INTEGRATED = f"""
SELECT g.id, r.s_id AS ssw_flare_id, {R("r.s_dist")} AS min_ssw_dist, s.ar AS ssw_ar, r.h_id AS hinode_flare_id, {R("r.h_dist")} AS min_hinode_dist, h.ar AS hinode_ar,
       {R("sqrt(pow(s.x - h.x, 2) + pow(s.y - h.y, 2))")} AS ssw_hinode_dist,
       coalesce(r.s_dist < 275, false) AS ssw_verified, coalesce(r.h_dist < 275, false) AS hinode_verified,
       coalesce(r.s_dist < 275, false) OR coalesce(r.h_dist < 275, false) AS primary_verified,
       coalesce(sqrt(pow(s.x - h.x, 2) + pow(s.y - h.y, 2)) < 275, false) AS secondary_verified,
       CASE WHEN g.lat IS NOT NULL THEN 'GOES' WHEN s.x IS NOT NULL THEN 'SSW' WHEN h.x IS NOT NULL THEN 'XRT' ELSE 'NoLocation' END AS fl_loc_src,
       coalesce(CAST(g.ar AS VARCHAR), '-') || ',' || coalesce(CAST(s.ar AS VARCHAR), '-') || ',' || coalesce(CAST(h.ar AS VARCHAR), '-') AS candidate_ars
FROM goes g LEFT JOIN resolved r ON g.id = r.id LEFT JOIN cat s ON r.s_id = s.id LEFT JOIN cat h ON r.h_id = h.id"""


@query("assemble_match_table", "J23", INTEGRATED)
def _(t):
    from ..plans.integrate import assemble_match_table

    names = {"x": "x_hpc", "y": "y_hpc", "ar": "noaa_active_region"}
    primary = t.goes.withColumnsRenamed(names).drop("primary_verified", "secondary_verified").withColumns({
        "fl_location": F.when(F.col("lat").isNotNull(), F.col("goes_location")), "fl_lon": F.col("lon").cast("double"), "fl_lat": F.col("lat").cast("double"),
    })
    table = assemble_match_table(primary, t.ssw.withColumnsRenamed(names), t.xrt.withColumnsRenamed(names))
    flags = ["ssw_verified", "hinode_verified", "primary_verified", "secondary_verified", "fl_loc_src"]
    ars = F.array_join(F.transform("candidate_ars", lambda a: F.coalesce(a.cast("string"), F.lit("-"))), ",")
    return table.select(
        "id", "ssw_flare_id", "ssw_ar", "hinode_flare_id", "hinode_ar", *[r6(F.col(c)).alias(c) for c in ("min_ssw_dist", "min_hinode_dist", "ssw_hinode_dist")],
        *flags, ars.alias("candidate_ars"),
    )
