"""Sliding windows, instance labels and partitions of the annotated hourly series."""

from datetime import timedelta

from pyspark.sql import functions as F

from ..functions.classes import build_label, verification_tag
from ..operators import labels as L
from ..operators import partition as P
from ..operators.asof import asof_join
from ..operators.history import count_events_in_slots
from ..operators.series import slot_stats_join
from ..plans.dataset import labelled_slices
from .registry import query
from .series import LETTER, TAG
from .tables import CTES, HOUR

U = ["user_id"]
CFG = L.WindowConfig(obs=12, lat=2, pred=24, step=2, clear=6)
CFG_CLASSES = L.WindowConfig(obs=12, lat=2, pred=24, step=2, clear=6, use_clear=True, classes="XMCBQ")

CTES["gslot"] = f"""
SELECT e.user_id, date_trunc('hour', e.peak_time) AS ts, {LETTER} AS letter, count(*) AS n, arg_max(goes_class || '@' || id || ':' || {TAG}, (goes_class, -id)) AS best
FROM goes e JOIN span s ON e.user_id = s.user_id WHERE e.peak_time >= s.first_ts AND e.peak_time < s.last_ts GROUP BY 1, 2, 3
"""
CTES["gcounts"] = "SELECT user_id, ts, " + ", ".join(
    f"sum(n) FILTER (letter = '{x}') AS n_{x}, max(best) FILTER (letter = '{x}') AS l_{x}" for x in "BCMX"
) + " FROM gslot GROUP BY 1, 2"
CTES["trust"] = """
SELECT user_id, ts, coalesce(quality = 0, false) AS ok FROM (
  SELECT g.user_id, g.ts, h.quality, row_number() OVER (PARTITION BY g.user_id, g.ts ORDER BY abs(epoch_us(h.hts) - epoch_us(g.ts)), h.hts DESC) AS rn
  FROM gridpts g LEFT JOIN header h ON g.user_id = h.user_id AND abs(epoch_us(h.hts) - epoch_us(g.ts)) <= 172800000000) WHERE rn = 1
"""
CTES["anno"] = """
SELECT g.user_id, g.ts, t.ok, coalesce(s.xr_qual, 0) AS xr_qual, coalesce(c.n_B, 0) AS n_b, coalesce(c.n_C, 0) AS n_c, coalesce(c.n_M, 0) AS n_m, coalesce(c.n_X, 0) AS n_x,
       greatest(CASE WHEN l_M LIKE '%ary' THEN l_M END, CASE WHEN l_X LIKE '%ary' THEN l_X END) AS lv, greatest(l_M, l_X) AS la,
       greatest(CASE WHEN l_B LIKE '%ary' THEN l_B END, CASE WHEN l_C LIKE '%ary' THEN l_C END) AS sv,
       row_number() OVER (PARTITION BY g.user_id ORDER BY g.ts) - 1 AS pos, count(*) OVER (PARTITION BY g.user_id) AS n
FROM gridpts g JOIN trust t ON g.user_id = t.user_id AND g.ts = t.ts LEFT JOIN slotstats s ON g.ts = s.ts
LEFT JOIN gcounts c ON g.user_id = c.user_id AND g.ts = c.ts
"""
CTES["frames"] = """
SELECT user_id, pos AS slice_pos, ts AS obs_start, lead(ts, 11) OVER w AS obs_end, CAST(sum(CAST(ok AS INT)) OVER (w ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING) AS BIGINT) AS obs_trusted,
       count(*) OVER p AS pred_rows, lead(ts, 14) OVER w AS pred_start, max(ts) OVER p AS pred_end, CAST(sum(n_m + n_x) OVER p AS BIGINT) AS pred_large,
       CAST(sum(CASE WHEN xr_qual = 0 THEN 1 ELSE 0 END) OVER p AS BIGINT) AS pred_low_quality,
       CAST(sum(n_m + n_x) OVER (w ROWS BETWEEN 8 FOLLOWING AND 43 FOLLOWING) AS BIGINT) AS clear_large, max(lv) OVER p AS large_verified, max(la) OVER p AS large_any, max(sv) OVER p AS small_verified, n
FROM anno WINDOW w AS (PARTITION BY user_id ORDER BY pos), p AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN 14 FOLLOWING AND 37 FOLLOWING)
"""
CTES["slices"] = "SELECT * FROM frames WHERE slice_pos % 2 = 0 AND slice_pos < n - 14"
CTES["searched"] = """
SELECT f.*, u.peak_time AS um_time, u.goes_class AS um_class FROM slices f LEFT JOIN (
  SELECT w.pred_start AS ps, e.peak_time, e.goes_class FROM (SELECT DISTINCT pred_start FROM slices) w
  ASOF JOIN (SELECT peak_time, goes_class FROM xrt WHERE value >= 300) e ON w.pred_start < e.peak_time) u ON f.pred_start = u.ps AND u.peak_time < f.pred_end
"""


def label_sql(clear: bool, outcome: str) -> str:
    return f"""
    SELECT user_id, slice_pos, obs_start, obs_end, coalesce(reason, {outcome}) AS outcome, CASE WHEN reason IS NULL THEN label WHEN reason = 'NONMATCHED_FL_Filter'
           THEN um_class || '@' || strftime(um_time, '%Y-%m-%d %H:%M:%S') WHEN reason = 'NON_VERIFIED_Filter' THEN large_any END AS label, reason
    FROM (SELECT *, CASE WHEN pred_large = 0 THEN coalesce(small_verified, 'FQ') ELSE large_verified END AS label,
                 CASE WHEN obs_trusted < 10.8 THEN 'TMFI_Filtered' WHEN pred_large = 0 AND um_time IS NOT NULL THEN 'NONMATCHED_FL_Filter'
                      WHEN pred_large = 0 AND pred_low_quality > 0.1 * pred_rows THEN 'XRAY_QUAL_Filter' WHEN {"pred_large = 0 AND clear_large <> 0" if clear else "false"} THEN 'CLEAR_WINDOW_Filter'
                      WHEN pred_large <> 0 AND large_verified IS NULL THEN 'NON_VERIFIED_Filter' END AS reason FROM searched)"""


CTES["inst"] = label_sql(False, "CASE WHEN pred_large = 0 THEN 'NF' ELSE 'FL' END")


def annotated(t):
    """Hourly series with trust flags, event history and flux quality."""
    grid = t.placed.select("user_id", "ts", "pos", "n")
    trusted = asof_join(grid, t.header, U, "ts", "hts", ["quality"], tolerance=timedelta(hours=48))
    trusted = trusted.select("user_id", "ts", "pos", "n", F.coalesce(F.col("quality") == 0, F.lit(False)).alias("IS_TMFI"))
    tag = verification_tag(F.col("primary_verified"), F.col("secondary_verified"))
    label = build_label(F.col("goes_class"), F.col("id"), F.col("ar"), F.lit("GOES"), tag)
    history = count_events_in_slots(trusted, t.goes, U, "ts", "peak_time", "goes_class", label, grid=HOUR, tag=tag)
    return slot_stats_join(history, t.flux, "ts", "ts", "b_avg", cols=("xr_qual",), grid=HOUR).withColumnRenamed("xr_qual", "XR_QUAL")


def parsed(t):
    from ..functions.classes import parse_label_max
    from ..plans.dataset import LABELS

    return annotated(t).withColumns({c: parse_label_max(F.col(c), with_verification=True) for c in LABELS})


def unmatched(t):
    return t.xrt.where(F.col("value") >= 300)


def instances(t):
    return labelled_slices(annotated(t), unmatched(t), "user_id", "ts", CFG)


@query("slice_starts", "W1", "SELECT user_id, slice_pos, obs_start FROM slices")
def _(t):
    return L.slice_starts(t.placed, U, "ts", CFG)


@query("observation_frame", "W2", "SELECT user_id, slice_pos, obs_start, obs_end, obs_trusted FROM slices")
def _(t):
    return L.window_frames(parsed(t), U, "ts", CFG).select("user_id", "slice_pos", "obs_start", "obs_end", "obs_trusted")


@query("prediction_frame", "W3", "SELECT user_id, slice_pos, pred_rows, pred_start, pred_end, pred_large, pred_low_quality, large_verified, large_any, small_verified FROM slices")
def _(t):
    return L.window_frames(parsed(t), U, "ts", CFG).select(
        "user_id", "slice_pos", "pred_rows", "pred_start", "pred_end", "pred_large", "pred_low_quality", "large_verified", "large_any", "small_verified"
    )


@query("clear_frame", "W4", "SELECT user_id, slice_pos, clear_large FROM slices")
def _(t):
    return L.window_frames(parsed(t), U, "ts", CFG_CLASSES).select("user_id", "slice_pos", "clear_large")


@query("label_instances", "W5", "SELECT * FROM inst")
def _(t):
    return instances(t)


@query("label_instances_classes", "W6", label_sql(True, "CASE WHEN label = 'FQ' THEN 'Q' ELSE substr(label, 1, 1) END"))
def _(t):
    return labelled_slices(annotated(t), unmatched(t), "user_id", "ts", CFG_CLASSES)


@query("explode_observations", "W7", """
SELECT i.user_id, i.slice_pos, a.pos, a.ts
FROM (SELECT user_id, slice_pos, unnest(generate_series(slice_pos, slice_pos + 11)) AS pos FROM inst WHERE reason IS NULL) i
JOIN anno a ON i.user_id = a.user_id AND a.pos = i.pos""", stored=True)
def _(t):
    kept = instances(t).where(F.col("reason").isNull()).select("user_id", "slice_pos")
    return L.explode_observations(kept, t.placed.select("user_id", "ts", "pos", "n"), U, "ts", CFG.obs)


@query("filter_counts", "A21", "SELECT reason, count(*) AS n FROM inst WHERE reason IS NOT NULL GROUP BY 1")
def _(t):
    return L.filter_counts(instances(t))


CTES["fcounts"] = """
SELECT user_id, CAST(sum(n_b) AS BIGINT) AS b, CAST(sum(n_c) AS BIGINT) AS c, CAST(sum(n_m) AS BIGINT) AS m, CAST(sum(n_x) AS BIGINT) AS x, min(ts) AS st, max(ts) AS et FROM anno GROUP BY 1
"""


def counts(t):
    history = count_events_in_slots(t.placed.select("user_id", "ts", "pos", "n"), t.goes, U, "ts", "peak_time", "goes_class", grid=HOUR)
    return P.series_event_counts(history, U, "ts")


@query("series_event_counts", "A5", 'SELECT user_id, b AS "BFLARE", c AS "CFLARE", m AS "MFLARE", x AS "XFLARE", st, et FROM fcounts')
def _(t):
    return counts(t)


@query("corpus_counts", "A6", """
SELECT count(*) AS n_series, count(*) FILTER (m <> 0 OR x <> 0) AS n_mx, count(*) FILTER (x <> 0) AS n_x, count(*) FILTER (c <> 0) AS n_c, count(*) FILTER (b <> 0) AS n_b,
       count(*) FILTER (b + c + m + x <> 0) AS n_any, count(*) FILTER (b + c + m + x = 0) AS n_none, CAST(sum(b) AS BIGINT) AS "total_BFLARE", CAST(sum(c) AS BIGINT) AS "total_CFLARE",
       CAST(sum(m) AS BIGINT) AS "total_MFLARE", CAST(sum(x) AS BIGINT) AS "total_XFLARE" FROM fcounts""")
def _(t):
    return P.corpus_counts(counts(t))


K = 4
CTES["scanned"] = "SELECT *, m + x AS mx, row_number() OVER (ORDER BY et, user_id) AS i FROM fcounts WHERE m + x > 0"
CTES["cumulated"] = "SELECT *, sum(mx) OVER (ORDER BY i) AS s, (SELECT sum(mx) FROM scanned) / 4.0::DOUBLE - 1 AS target FROM scanned"
CTES["cut1"] = "SELECT min(s) AS s, arg_min(st, s) AS st FROM cumulated WHERE s >= target"
CTES["cut2"] = "SELECT min(s) AS s, arg_min(st, s) AS st FROM cumulated WHERE s >= (SELECT s FROM cut1) + target"
CTES["cut3"] = "SELECT min(s) AS s, arg_min(st, s) AS st FROM cumulated WHERE s >= (SELECT s FROM cut2) + target"
CTES["parts"] = """
SELECT f.*, CAST(e.p AS INTEGER) AS "partition" FROM fcounts f JOIN (
  SELECT 1 AS p, TIMESTAMP '0001-01-01' AS lo, (SELECT st FROM cut1) AS hi UNION ALL SELECT 2, (SELECT st FROM cut1), (SELECT st FROM cut2)
  UNION ALL SELECT 3, (SELECT st FROM cut2), (SELECT st FROM cut3) UNION ALL SELECT 4, (SELECT st FROM cut3), TIMESTAMP '9999-01-01') e ON f.st > e.lo AND f.st <= e.hi
"""


def parts(t):
    return P.balanced_time_partitions(counts(t), K, "user_id")


@query("balanced_time_partitions", "W14", 'SELECT user_id, st, et, m + x AS mx, "partition" FROM parts')
def _(t):
    return parts(t).select("user_id", "st", "et", (F.col("MFLARE") + F.col("XFLARE")).alias("mx"), "partition")


CTES["customer_years"] = """
SELECT o_custkey AS user_id, count(*) FILTER (o_orderstatus = 'F' AND o_totalprice > 300000) AS m, min(CAST(o_orderdate AS TIMESTAMP)) AS st, max(CAST(o_orderdate AS TIMESTAMP)) AS et
FROM orders GROUP BY 1
"""
CTES["early_scan"] = "SELECT *, sum(m) OVER (ORDER BY et, user_id) AS s, (SELECT sum(m) FROM customer_years) / 2.0::DOUBLE - 1 AS target FROM customer_years WHERE m > 0"


@query("balanced_time_partitions_early", "W14", """
SELECT user_id, m, CASE WHEN st <= (SELECT arg_min(st, s) FROM early_scan WHERE s >= target) THEN 1 ELSE 2 END AS "partition" FROM customer_years""")
def _(t):
    large = F.count_if((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000))
    day = F.col("o_orderdate").cast("timestamp_ntz")
    series = t.read("orders").groupBy(F.col("o_custkey").alias("user_id")).agg(large.alias("MFLARE"), F.min(day).alias("st"), F.max(day).alias("et"))
    series = series.withColumns({c: F.lit(0).cast("long") for c in ("BFLARE", "CFLARE", "XFLARE")})
    return P.balanced_time_partitions(series, 2, "user_id").select("user_id", F.col("MFLARE").alias("m"), "partition")


@query("apply_partitions", "W15", 'SELECT g.user_id, g.ts, p."partition" FROM gridpts g JOIN parts p ON g.user_id = p.user_id')
def _(t):
    return P.apply_partitions(t.grid.select("user_id", "ts"), parts(t), "user_id")


@query("partition_stats", "A7", """
SELECT "partition", count(*) FILTER (x <> 0) AS n_x, count(*) FILTER (m <> 0) AS n_m, count(*) FILTER (c <> 0) AS n_c, count(*) FILTER (b <> 0) AS n_b,
       count(*) FILTER (m <> 0 OR x <> 0) AS n_mx, count(*) AS n_series, CAST(sum(m) AS BIGINT) AS total_m, CAST(sum(x) AS BIGINT) AS total_x, CAST(sum(m + x) AS BIGINT) AS total_mx
FROM parts GROUP BY 1""")
def _(t):
    return P.partition_stats(parts(t))


CTES["mixed"] = 'SELECT i.*, CAST(1 + i.user_id % 3 AS BIGINT) AS "partition" FROM inst i'


def mixed(t):
    return instances(t).withColumn("partition", F.col("user_id") % 3 + 1)


@query("class_mix", "A22", """
SELECT "partition", count(*) FILTER (label LIKE 'X%') AS n_x, count(*) FILTER (label LIKE 'M%') AS n_m, count(*) FILTER (label LIKE 'C%') AS n_c,
       count(*) FILTER (label LIKE 'B%') AS n_b, count(*) FILTER (label LIKE 'FQ%') AS n_quiet FROM mixed WHERE reason IS NULL GROUP BY 1""")
def _(t):
    return L.class_mix(mixed(t))
