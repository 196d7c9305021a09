"""Sampling, month splits, validity and balance of the order samples."""

from pyspark.sql import functions as F

from ..operators import sampling as R_
from ..session import materialize
from .labels import mixed
from .registry import query
from .tables import CTES, R, r6

GROUP_HEX12 = "CAST('0x' || substr(md5('13|' || yr || '|' || minority || '|' || d), 1, 12) AS BIGINT)"
HEX12 = "CAST('0x' || substr(md5('13|' || d), 1, 12) AS BIGINT)"
CTES["shuffled"] = "SELECT *, row_number() OVER (PARTITION BY flaring ORDER BY md5('13|' || sample_id), sample_id) - 1 AS pos FROM samples"
CTES["yearly"] = """
SELECT *, row_number() OVER (PARTITION BY yr, flaring ORDER BY md5('13|' || sample_id), sample_id) - 1 AS pos FROM (SELECT *, substr(month, 1, 4) AS yr FROM samples)
"""
CTES["sizes"] = "SELECT yr, count(*) FILTER (flaring) AS f, count(*) FILTER (NOT flaring) AS q FROM yearly GROUP BY 1"


@query("undersample", "R1", "SELECT sample_id FROM (SELECT sample_id, row_number() OVER (ORDER BY md5('13|' || sample_id), sample_id) AS rn FROM samples) WHERE rn <= 5000")
def _(t):
    return R_.undersample(t.samples, 5000, ["sample_id"]).select("sample_id")


@query("oversample", "R2", f"""
SELECT sample_id, NULL::BIGINT AS draw FROM shuffled WHERE flaring UNION ALL
SELECT s.sample_id, x.d AS draw FROM (SELECT d, {HEX12} % (SELECT count(*) FROM samples WHERE flaring) AS pos
  FROM (SELECT unnest(generate_series(0, (SELECT count(*) FILTER (NOT flaring) - count(*) FILTER (flaring) - 1 FROM samples))) AS d)) x
JOIN shuffled s ON s.flaring AND s.pos = x.pos""")
def _(t):
    majority = t.samples.where(~F.col("flaring")).agg(F.count(F.lit(1)).alias("n")).scalar()
    return R_.oversample(t.samples.where("flaring"), majority, ["sample_id"]).select("sample_id", "draw")


@query("undersample_to_ratio", "R3", """
SELECT user_id, slice_pos, outcome, "partition" FROM (
  SELECT *, row_number() OVER (PARTITION BY "partition", outcome ORDER BY md5('13|' || user_id || '|' || slice_pos), user_id, slice_pos) AS rn,
         count(*) FILTER (outcome = 'FL') OVER (PARTITION BY "partition") AS fl FROM mixed WHERE outcome IN ('FL', 'NF'))
WHERE outcome = 'FL' OR rn <= CAST(floor(fl * ((1 - 0.7::DOUBLE) / 0.7::DOUBLE)) AS BIGINT) + 1""")
def _(t):
    out = R_.undersample_to_ratio(materialize(mixed(t), "slices"), "partition", ["user_id", "slice_pos"], keep_share=0.7)
    return out.select("user_id", "slice_pos", "outcome", "partition")


CTES["monthly"] = "SELECT month, count(*) FILTER (flaring) AS nf, count(*) FILTER (NOT flaring) AS nq FROM samples GROUP BY 1"
CTES["drawn"] = """
SELECT c, month, rn <= ceil(nm * 0.67::DOUBLE) AS is_train, nf, total FROM (
  SELECT c, month, nf, row_number() OVER (PARTITION BY c ORDER BY md5('13|' || c || '|' || month), month) AS rn, count(*) OVER (PARTITION BY c) AS nm, sum(nf) OVER (PARTITION BY c) AS total
  FROM monthly, (SELECT unnest(generate_series(1, 64)) AS c))
"""
CTES["chosen"] = """
SELECT min(c) AS c FROM (SELECT c, sum(nf) FILTER (is_train) AS tr, any_value(total) AS total FROM drawn GROUP BY 1)
WHERE tr > floor(total * 0.60::DOUBLE) AND tr < floor(total * 0.75::DOUBLE)
"""
CTES["split"] = "SELECT month, is_train FROM drawn WHERE c = (SELECT c FROM chosen)"


@query("month_counts", "A20", f"""
SELECT month, nf AS n_flaring, nq AS n_quiet, {R("nf::DOUBLE / (nf + nq)")} AS flaring_share, {R("nq::DOUBLE / (nf + nq)")} AS quiet_share FROM monthly""")
def _(t):
    out = R_.month_counts(t.samples, "month", "flaring")
    return out.withColumns({c: r6(F.col(c)) for c in ("flaring_share", "quiet_share")})


@query("split_by_month", "R4", "SELECT month, is_train FROM split")
def _(t):
    return R_.split_by_month(t.samples, "month", "flaring").select("month", "is_train")


CTES["byday"] = """
SELECT user_id, strftime(start_time, '%Y-%m-%d') AS day, CAST(floor(100.0 * count(*) FILTER (lat IS NULL) / count(*)) AS BIGINT) AS pct_lat,
       CAST(floor(100.0 * count(*) FILTER (ar IS NULL) / count(*)) AS BIGINT) AS pct_ar FROM cat GROUP BY 1, 2
"""


def daily(t):
    return t.cat.withColumn("day", F.date_format("start_time", "yyyy-MM-dd"))


@query("percent_missing", "A18", "SELECT user_id, day, pct_lat, pct_ar, pct_lat + pct_ar AS pct_total FROM byday")
def _(t):
    return R_.percent_missing(daily(t), ["user_id", "day"], ["lat", "ar"])


@query("valid_samples", "R5", """
SELECT c.id FROM cat c JOIN byday b ON c.user_id = b.user_id AND strftime(c.start_time, '%Y-%m-%d') = b.day WHERE pct_lat + pct_ar = 0""")
def _(t):
    return R_.valid_samples(daily(t), ["user_id", "day"], ["lat", "ar"]).select("id")


@query("missing_log", "R5", """
SELECT user_id, day, 'lat' AS column_name, pct_lat AS pct FROM byday WHERE pct_lat > 10 UNION ALL SELECT user_id, day, 'ar', pct_ar FROM byday WHERE pct_ar > 10""")
def _(t):
    return R_.missing_log(daily(t), ["user_id", "day"], ["lat", "ar"])


def by_year(t):
    return t.samples.withColumn("yr", F.substring("month", 1, 4))


@query("balance_under", "R6", "SELECT y.sample_id, y.yr, y.flaring FROM yearly y JOIN sizes s ON y.yr = s.yr WHERE y.pos < least(s.f, s.q)")
def _(t):
    return R_.balance(by_year(t), "yr", "flaring", ["sample_id"]).select("sample_id", "yr", "flaring")


@query("balance_over", "R6", f"""
SELECT sample_id, yr, flaring, NULL::BIGINT AS draw FROM yearly UNION ALL
SELECT y.sample_id, y.yr, y.flaring, x.d FROM (
  SELECT yr, minority, d, {GROUP_HEX12} % m AS pos FROM (SELECT yr, f < q AS minority, least(f, q) AS m, unnest(generate_series(0, abs(f - q) - 1)) AS d FROM sizes)) x
JOIN yearly y ON y.yr = x.yr AND y.flaring = x.minority AND y.pos = x.pos""")
def _(t):
    return R_.balance(by_year(t), "yr", "flaring", ["sample_id"], "over").select("sample_id", "yr", "flaring", "draw")


CTES["validsplit"] = """
SELECT *, row_number() OVER (PARTITION BY sp, flaring ORDER BY md5('13|' || sample_id), sample_id) AS rn, count(*) FILTER (flaring) OVER (PARTITION BY sp) AS f,
       count(*) FILTER (NOT flaring) OVER (PARTITION BY sp) AS q
FROM (SELECT s.sample_id, s.flaring, CASE WHEN m.is_train THEN 'train' ELSE 'test' END AS sp FROM samples s JOIN split m ON s.month = m.month WHERE price <= 400000)
"""


def priced(t):
    return t.samples.withColumn("price", F.when(F.col("price") <= 400000, F.col("price")))


@query("sample_splits", "R7", "SELECT sample_id, flaring, sp AS split FROM validsplit WHERE rn <= least(f, q)")
def _(t):
    return R_.sample_splits(priced(t), "month", "flaring", ["sample_id"], ["price"]).select("sample_id", "flaring", "split")
