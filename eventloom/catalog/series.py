"""Grid, slot statistics, quality and smoothing of the hourly series."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ..operators import history as H
from ..operators import interval as I
from ..operators import series as S
from ..operators.scan import positions
from .registry import query
from .scalars import candidate_numbers
from .tables import CTES, HOUR, R, r6

U = ["user_id"]
TAG = "CASE WHEN primary_verified THEN 'Primary' WHEN secondary_verified THEN 'Secondary' ELSE 'Non-verified' END"
LETTER = "substr(goes_class, 1, 1)"


@query("regrid", "J19", f"SELECT user_id, ts, {R('p_avg')} AS p_avg, p_max, p_n FROM grid")
def _(t):
    return S.regrid(t.hourly, U, "ts", HOUR).select("user_id", "ts", r6(F.col("p_avg")).alias("p_avg"), "p_max", "p_n")


@query("positions_measured_cells", "J1 W9", """
SELECT id, row_number() OVER (ORDER BY start_time, id) - 1 AS pos, count(*) OVER () AS n FROM goes WHERE start_time IS NOT NULL""")
def _(t):
    """Place of every event among all events: one key, in cells of at most 200 rows."""
    rows = t.goes.where(F.col("start_time").isNotNull()).select(F.lit(1).alias("axis"), "id", "start_time")
    return positions(rows, ["axis"], "start_time", tie=("id",), most=200).select("id", "pos", "n")


ODD = "date_diff('hour', first_ts, last_ts) % 2 <> 0"


@query("regrid_rejects", "J19", f"SELECT user_id, first_ts, last_ts FROM span WHERE {ODD}")
def _(t):
    return S.regrid_rejects(t.hourly, U, "ts", 2 * HOUR).select("user_id", "first_ts", "last_ts")


@query("regrid_coarse", "J19", f"""
SELECT g.user_id, g.ts, h.p_n FROM (SELECT user_id, unnest(generate_series(first_ts, last_ts, INTERVAL 2 HOUR)) AS ts FROM span WHERE NOT ({ODD})) g
LEFT JOIN hourly h ON g.user_id = h.user_id AND g.ts = h.ts""")
def _(t):
    return S.regrid(t.hourly, U, "ts", 2 * HOUR).select("user_id", "ts", "p_n")


def stats_sql(slots: str, before: int, after: int) -> str:
    return f"""
    SELECT s.ts, coalesce(avg(f.b_avg) FILTER (f.b_avg <> -99999), -99999.0::DOUBLE) AS xr_avg, coalesce(max(f.b_avg) FILTER (f.b_avg <> -99999), -99999.0::DOUBLE) AS xr_max,
           count(*) FILTER (f.b_avg <> -99999) AS xr_qual, string_agg(CAST(f.b_avg AS VARCHAR), ';' ORDER BY f.ts) AS xr_all,
           string_agg(CASE WHEN f.b_avg <> -99999 THEN '1' ELSE '0' END, '' ORDER BY f.ts) AS xr_qual_str
    FROM (SELECT DISTINCT ts FROM {slots}) s JOIN flux f ON f.ts BETWEEN s.ts - INTERVAL {before} MINUTE AND s.ts + INTERVAL {after} MINUTE GROUP BY 1"""


CTES["slotstats"] = stats_sql("grid", 6, 5)


@query("slot_flux_stats", "A15", f"SELECT ts, {R('xr_avg')} AS xr_avg, xr_max, xr_qual, xr_all, xr_qual_str FROM slotstats")
def _(t):
    return S.slot_flux_stats(t.grid, t.flux, "ts", "ts", "b_avg").withColumn("xr_avg", r6(F.col("xr_avg")))


@query("slot_flux_stats_grid", "A15", "SELECT DISTINCT s.ts, s.xr_max, s.xr_qual, s.xr_all FROM slotstats s")
def _(t):
    stats = S.slot_flux_stats(None, t.flux, "ts", "ts", "b_avg", grid=HOUR)
    return stats.join(t.grid.select("ts").distinct(), "ts", "left_semi").select("ts", "xr_max", "xr_qual", "xr_all")


@query("slot_stats_join", "J18", """
SELECT g.user_id, g.ts, coalesce(s.xr_max, -99999.0::DOUBLE) AS xr_max, coalesce(s.xr_qual, 0) AS xr_qual FROM grid g LEFT JOIN slotstats s ON g.ts = s.ts""")
def _(t):
    return S.slot_stats_join(t.grid.select("user_id", "ts"), t.flux, "ts", "ts", "b_avg")


CTES["gplaced"] = """
SELECT e.*, date_trunc('hour', e.peak_time) AS slot FROM goes e JOIN span s ON e.user_id = s.user_id WHERE e.peak_time >= s.first_ts AND e.peak_time < s.last_ts
"""
CTES["placed"] = """
SELECT e.*, (SELECT max(h.ts) FROM hourly h WHERE h.user_id = e.user_id AND h.ts <= e.peak_time) AS slot FROM goes e
WHERE e.peak_time < (SELECT max(h.ts) FROM hourly h WHERE h.user_id = e.user_id)
"""


def counts_sql(slotted: str, series: str, on: str, label: str, suffix: str = "") -> str:
    cols = ", ".join(
        f"coalesce(c.n_{x}, 0) AS \"{x}FLARE{suffix}\", coalesce(c.l_{x}, 'None') AS \"{x}FLARE_LABEL{suffix}\"" for x in "BCMX"
    )
    aggs = ", ".join(
        f"count(*) FILTER ({LETTER} = '{x}') AS n_{x}, string_agg({label}, ';' ORDER BY id) FILTER ({LETTER} = '{x}') AS l_{x}" for x in "BCMX"
    )
    return f"""
    SELECT s.user_id, s.{on}, {cols} FROM (SELECT DISTINCT user_id, {on} FROM {series}) s
    LEFT JOIN (SELECT user_id, slot, {aggs} FROM {slotted} WHERE slot IS NOT NULL GROUP BY 1, 2) c ON s.user_id = c.user_id AND s.{on} = c.slot"""


@query("count_events_in_grid", "J15", counts_sql("gplaced", "gridpts", "ts", "goes_class || '@' || id"))
def _(t):
    label = F.concat("goes_class", F.lit("@"), F.col("id").cast("string"))
    out = H.count_events_in_slots(t.placed.select("user_id", "ts", "pos", "n"), t.goes, U, "ts", "peak_time", "goes_class", label, grid=HOUR)
    return out.drop("pos", "n")


@query("events_in_slots", "J15", "SELECT id, slot FROM placed WHERE slot IS NOT NULL")
def _(t):
    return H.events_in_slots(t.goes, t.hourly, U, "peak_time", "ts").select("id", "slot")


@query("count_events_in_slots", "J15", counts_sql("placed", "hourly", "ts", "goes_class || '@' || id"))
def _(t):
    label = F.concat("goes_class", F.lit("@"), F.col("id").cast("string"))
    return H.count_events_in_slots(t.hourly.select("user_id", "ts"), t.goes, U, "ts", "peak_time", "goes_class", label)


CTES["keylist"] = "SELECT user_id, list(key) AS ks FROM bridge GROUP BY 1"


def decided_sql(pairs: str, series: str, on: str, keep_rejected: bool) -> str:
    return f"""
    SELECT *, (SELECT max(s.{on}) FROM {series} s WHERE s.user_id = q.user_id AND s.{on} <= q.peak_time) AS slot FROM (
      SELECT *, CASE WHEN a IS NOT NULL THEN CASE WHEN list_contains(ks, a) THEN a ELSE -1 END WHEN b IS NOT NULL THEN CASE WHEN list_contains(ks, b) THEN b ELSE -1 END
                     WHEN c IS NOT NULL AND list_contains(ks, c) THEN c ELSE -1 END AS region,
             CASE WHEN a IS NOT NULL THEN CASE WHEN list_contains(ks, a) THEN 'GOES' END WHEN b IS NOT NULL THEN CASE WHEN list_contains(ks, b) THEN 'XRT' END
                  WHEN c IS NOT NULL AND list_contains(ks, c) THEN 'SSW' END AS source
      FROM (SELECT p.id, p.user_id, e.peak_time, e.goes_class, {TAG} AS tag, e.ar AS a, CASE WHEN e.id % 2 = 0 THEN e.user_id + 10002 END AS b,
                   CASE WHEN e.id % 3 = 0 THEN e.user_id + 10001 END AS c, k.ks
            FROM {pairs} p JOIN goes e ON p.id = e.id LEFT JOIN keylist k ON p.user_id = k.user_id)) q
    WHERE {"true" if keep_rejected else "region <> -1"} AND peak_time < (SELECT max(s.{on}) FROM {series} s WHERE s.user_id = q.user_id)"""


JSON_LABEL = """'{"magnitude": "' || goes_class || '", "id": ' || id || ', "NOAA_AR": ' || region || ', "narn_source": '
 || coalesce('"' || source || '"', 'null') || ', "verification": "' || tag || '"}'"""
CTES["dec_key"] = decided_sql("bykey", "hourly", "ts", False)
CTES["dec_loc"] = decided_sql("byplace", "header", "hts", True)


def numbered(t):
    return candidate_numbers(t.goes).withColumnsRenamed({"ar": "noaa_active_region", "lat": "fl_lat", "lon": "fl_lon"})


@query("event_history", "J16 P33", counts_sql("dec_key", "hourly", "ts", JSON_LABEL))
def _(t):
    return H.event_history(t.hourly.select("user_id", "ts"), numbered(t), t.keymap, "user_id", "ts")


@query("event_history_location", "J16", counts_sql("dec_loc", "header", "hts", JSON_LABEL, "_LOC"))
def _(t):
    out = H.event_history(t.header, numbered(t), t.keymap, "user_id", "hts", mode="location")
    return out.drop("hid", "lat_min", "lat_max", "lon_min", "lon_max", "quality")


COLS = ["p_avg", "p_max", "p_n"]


@query("null_counts", "A8", " UNION ALL ".join(f"SELECT user_id, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_missing FROM grid GROUP BY 1" for c in COLS))
def _(t):
    return S.null_counts(t.grid, U, COLS)


@query("null_totals", "A8", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_missing FROM grid" for c in COLS))
def _(t):
    return S.null_totals(t.grid, COLS)


ZERO = "SELECT user_id, p_n - 1 AS extra, p_avg FROM grid"


@query("zero_or_null_counts", "A9", " UNION ALL ".join(
    f"SELECT user_id, '{c}' AS column_name, count(*) FILTER ({c} IS NULL OR {c} = 0) AS n_missing FROM ({ZERO}) GROUP BY 1" for c in ("extra", "p_avg")))
def _(t):
    rows = t.grid.select("user_id", (F.col("p_n") - 1).alias("extra"), "p_avg")
    return S.null_counts(rows, U, ["extra", "p_avg"], zeros=True)


@query("series_length", "A10", "SELECT user_id, count(*) AS rows, count(*)::DOUBLE AS hours FROM grid GROUP BY 1")
def _(t):
    return S.series_length(t.grid, U, HOUR)


CTES["steps"] = "SELECT user_id, ts, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS step_us FROM hourly"


@query("step_diff", "W8", "SELECT user_id, ts, step_us FROM steps")
def _(t):
    return S.step_diff(t.hourly.select("user_id", "ts"), U, "ts")


@query("irregular_step_ratio", "A11", f"SELECT user_id, {R('count(*) FILTER (step_us IS NULL OR step_us <> 3600000000)::DOUBLE / count(*)')} AS irregular_ratio FROM steps GROUP BY 1")
def _(t):
    return S.irregular_step_ratio(t.hourly, U, "ts", HOUR).withColumn("irregular_ratio", r6(F.col("irregular_ratio")))


@query("availability_ratio", "A12", f"""
SELECT user_id, count(*) AS rows, {R("count(*)::DOUBLE / (date_diff('hour', min(ts), max(ts)) + 1)")} AS availability,
       count(*)::DOUBLE / (date_diff('hour', min(ts), max(ts)) + 1) > 1 AS flagged FROM hourly GROUP BY 1""")
def _(t):
    return S.availability_ratio(t.hourly, U, "ts", HOUR).withColumn("availability", r6(F.col("availability")))


CTES["filled"] = """
SELECT user_id, ts, pos, n, coalesce(p_max, lo + (hi - lo) * (pos - lo_pos)::DOUBLE / (hi_pos - lo_pos), lo, hi) AS p_max FROM (
  SELECT *, last_value(p_max IGNORE NULLS) OVER a AS lo, last_value(CASE WHEN p_max IS NOT NULL THEN pos END IGNORE NULLS) OVER a AS lo_pos,
         first_value(p_max IGNORE NULLS) OVER b AS hi, first_value(CASE WHEN p_max IS NOT NULL THEN pos END IGNORE NULLS) OVER b AS hi_pos
  FROM (SELECT user_id, ts, p_max, row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS pos, count(*) OVER (PARTITION BY user_id) AS n FROM grid)
  WINDOW a AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
"""


def filled(t):
    return S.interpolate_linear(t.placed.select("user_id", "ts", "p_max", "pos", "n"), U, "ts", ["p_max"])


@query("interpolate_linear", "W9", f"SELECT user_id, ts, {R('p_max', '1e9')} AS p_max FROM filled")
def _(t):
    return filled(t).select("user_id", "ts", r6(F.col("p_max"), 1e9).alias("p_max"))


@query("scale", "W10", f"""
SELECT user_id, ts, {R("(p_max - lo) / CASE WHEN hi = lo THEN 1.0::DOUBLE ELSE hi - lo END")} AS p_max FROM (
  SELECT *, min(p_max) OVER (PARTITION BY user_id) AS lo, max(p_max) OVER (PARTITION BY user_id) AS hi FROM grid)""")
def _(t):
    return S.scale(t.grid, U, "ts", ["p_max"]).select("user_id", "ts", r6(F.col("p_max")).alias("p_max"))


@query("rolling_mean", "W11", f"""
SELECT user_id, ts, CASE WHEN count(v) OVER w = 11 THEN {R("sum(v) OVER w / 11", "1e9")} END AS v_mean FROM (SELECT user_id, ts, CAST(coalesce(p_n, 0) AS DOUBLE) AS v FROM grid)
WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 10 PRECEDING AND CURRENT ROW)""")
def _(t):
    rows = t.placed.select("user_id", "ts", "pos", "n", F.coalesce("p_n", F.lit(0)).cast("double").alias("v"))
    return S.rolling_mean(rows, U, "ts", ["v"]).select("user_id", "ts", r6(F.col("v_mean"), 1e9).alias("v_mean"))


CTES["cut"] = """
SELECT user_id, ts, pos, (p_max - lo) / CASE WHEN hi = lo THEN 1.0::DOUBLE ELSE hi - lo END AS v FROM (
  SELECT *, min(p_max) OVER (PARTITION BY user_id) AS lo, max(p_max) OVER (PARTITION BY user_id) AS hi FROM filled WHERE pos >= 40 AND pos < n - 40)
"""


@query("smooth_series", "W9 W10 W11 W12", f"""
SELECT user_id, ts, CASE WHEN k >= 11 THEN {R("m")} END AS p_max FROM (
  SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY pos) AS k, avg(v) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) AS m FROM cut)
WHERE k > 20""")
def _(t):
    from ..plans.smooth import smooth_series

    out = smooth_series(t.placed.select("user_id", "ts", "pos", "n", "p_max"), U, "ts", ["p_max"], edge=40, lead=20)
    return out.select("user_id", "ts", r6(F.col("p_max")).alias("p_max"))


@query("trim_edges", "W12", "SELECT user_id, ts FROM filled WHERE pos >= 20 AND pos < n - 30")
def _(t):
    return S.trim_edges(t.grid, U, "ts", 20, 30).select("user_id", "ts")


@query("pre_event_window", "W13", """
SELECT h.user_id, h.ts, h.p_n, e.id FROM hourly h JOIN goes e ON h.user_id = e.user_id AND h.ts BETWEEN e.peak_time - INTERVAL 36 HOUR AND e.peak_time WHERE e.goes_class >= 'M'""")
def _(t):
    chosen = t.goes.where(F.col("goes_class") >= "M").select("user_id", "id", "peak_time")
    return I.pre_event_window(t.hourly.select("user_id", "ts", "p_n"), chosen, U, "ts", "id", "peak_time")


def stamp(text):
    return F.lit(datetime.fromisoformat(text)).cast("timestamp_ntz")


@query("scan_time_range", "S11", """
SELECT user_id, ts, value FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05 03:00:00' AND TIMESTAMP '2024-01-08 21:30:00'""")
def _(t):
    return S.scan_time_range(t.events, "ts", stamp("2024-01-05 03:00:00"), stamp("2024-01-08 21:30:00")).select("user_id", "ts", "value")


@query("max_in_intervals", "A19", """
SELECT g.id, max(h.p_max) / 1e7 AS max_flux, CASE WHEN max(h.p_max) >= 1000 THEN 'X' WHEN max(h.p_max) >= 100 THEN 'M' WHEN max(h.p_max) >= 10 THEN 'C' WHEN max(h.p_max) >= 1 THEN 'B' WHEN max(h.p_max) > 0 THEN 'A' END AS letter
FROM goes g LEFT JOIN hourly h ON h.user_id = g.user_id AND h.ts BETWEEN g.start_time - INTERVAL 40 HOUR AND g.end_time + INTERVAL 75 HOUR GROUP BY g.id""")
def _(t):
    around = t.goes.select("id", "user_id", (F.col("start_time") - F.lit(timedelta(hours=40))).alias("a"), (F.col("end_time") + F.lit(timedelta(hours=75))).alias("b"))
    out = S.max_in_intervals(t.hourly.select("user_id", "ts", "p_max"), around, U, "ts", "p_max", ("a", "b"))
    flux = F.col("max_flux")
    letter = F.when(flux >= 1000, "X").when(flux >= 100, "M").when(flux >= 10, "C").when(flux >= 1, "B").when(flux > 0, "A")
    return out.select("id", (flux / 1e7).alias("max_flux"), letter.alias("letter"))


@query("max_in_interval", "A19", """
SELECT max(b_avg) / 1e7 AS max_flux, CASE WHEN max(b_avg) >= 1000 THEN 'X' WHEN max(b_avg) >= 100 THEN 'M' WHEN max(b_avg) >= 10 THEN 'C' ELSE 'B' END AS letter
FROM flux WHERE ts BETWEEN TIMESTAMP '2024-01-05 03:00:00' AND TIMESTAMP '2024-01-08 21:30:00'""")
def _(t):
    flux = t.flux.select("ts", (F.col("b_avg") / 1e7).alias("w"))
    out = S.max_in_interval(flux, "ts", "w", stamp("2024-01-05 03:00:00"), stamp("2024-01-08 21:30:00"))
    return out.select("max_flux", F.substring("max_class", 1, 1).alias("letter"))
