"""The test tables seen as catalogues, series, headers, regions and flux.

Every adapter exists twice: as a DataFrame (method of ``Tables``) and as SQL (entry of ``CTES``).
Attributes the test tables lack are computed from ids with integer arithmetic, which is exact in
both engines.
"""

from __future__ import annotations

from datetime import timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import normalize_key_number
from ..functions.times import floor_time
from ..session import fit_shuffles

HOUR = timedelta(hours=1)
CTES: dict[str, str] = {}


def r6(col, scale: float = 1e6):
    """Six digits, by arithmetic that both engines do alike on ties."""
    return F.floor(col * scale + 0.5) / scale


def R(expr: str, scale: str = "1e6") -> str:
    return f"(floor(({expr}) * {scale}::DOUBLE + 0.5::DOUBLE) / {scale}::DOUBLE)"


CTES["cat"] = """
SELECT id, user_id, src, start_time, peak_time, end_time, goes_class, lat, lon,
       CAST(lon * 10 AS DOUBLE) AS x, CAST(lat * 10 AS DOUBLE) AS y,
       CASE WHEN lat IS NULL THEN '(0, 0)' ELSE '(' || lon || ', ' || lat || ')' END AS goes_location,
       raw_ar, CASE WHEN raw_ar = 0 THEN NULL WHEN raw_ar <= 10000 THEN raw_ar + 10000 ELSE raw_ar END AS ar,
       id % 3 = 0 AS primary_verified, id % 5 = 0 AS secondary_verified, value
FROM (
  SELECT event_id AS id, user_id, event_type AS src, ts AS start_time, ts + INTERVAL 5 MINUTE AS peak_time,
         ts + to_minutes(CAST(floor(value) AS INTEGER)) AS end_time, value,
         CASE WHEN value < 5 THEN 'A' WHEN value < 20 THEN 'B' WHEN value < 60 THEN 'C' WHEN value < 150 THEN 'M' ELSE 'X' END
         || CASE WHEN value >= 150 AND event_id % 3 = 2 THEN '10.0'
                 ELSE (1 + event_id % 3) || CASE WHEN user_id % 2 = 0 THEN '.0' ELSE '.5' END END AS goes_class,
         CASE WHEN event_id % 11 <> 0 THEN (event_id * 7919) % 121 - 60 END AS lat,
         CASE WHEN event_id % 11 <> 0 THEN (event_id * 104729) % 181 - 90 END AS lon,
         CASE WHEN event_id % 7 = 0 THEN 0 WHEN user_id % 2 = 0 THEN user_id + 1 ELSE 10001 + user_id END AS raw_ar
  FROM events)
"""
CTES["goes"] = "SELECT * FROM cat WHERE src = 'error'"
CTES["ssw"] = "SELECT * FROM cat WHERE src = 'purchase'"
CTES["xrt"] = "SELECT * FROM cat WHERE src = 'signup'"
CTES["hourly"] = """
SELECT user_id, date_trunc('hour', ts) AS ts, avg(value) AS p_avg, max(value) AS p_max, count(*) AS p_n
FROM events GROUP BY 1, 2
"""
CTES["span"] = "SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts FROM hourly GROUP BY 1"
CTES["gridpts"] = "SELECT user_id, unnest(generate_series(first_ts, last_ts, INTERVAL 1 HOUR)) AS ts FROM span"
CTES["grid"] = "SELECT g.user_id, g.ts, h.p_avg, h.p_max, h.p_n FROM gridpts g LEFT JOIN hourly h ON g.user_id = h.user_id AND g.ts = h.ts"
CTES["header"] = """
SELECT user_id, ts AS hts, event_id AS hid, (event_id * 7919) % 91 - 50 AS lat_min, (event_id * 7919) % 91 - 38 AS lat_max,
       (event_id * 104729) % 151 - 85 AS lon_min, (event_id * 104729) % 151 - 61 AS lon_max,
       CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS quality
FROM events WHERE event_type = 'view'
"""
CTES["keymap"] = """
SELECT DISTINCT user_id, CASE WHEN user_id % 6 = 0 THEN (10001 + user_id) || ',' || (10002 + user_id)
                              ELSE CAST(10001 + user_id AS VARCHAR) END AS keys_text FROM events WHERE user_id % 13 <> 0
"""
CTES["bridge"] = "SELECT user_id, CAST(unnest(string_split(keys_text, ',')) AS BIGINT) AS key FROM keymap"
CTES["regions"] = """
SELECT 10001 + user_id AS region, date_trunc('day', ts) AS ar_time,
       min(event_id * 7919) % 101 - 50 AS lat, min(event_id * 104729) % 141 - 70 AS lon
FROM events WHERE event_type = 'click' GROUP BY 10001 + user_id, date_trunc('day', ts)
"""
CTES["regtext"] = """
SELECT *, CASE WHEN lat >= 0 THEN 'N' ELSE 'S' END || lpad(CAST(abs(lat) AS VARCHAR), 2, '0')
       || CASE WHEN lon >= 0 THEN 'W' ELSE 'E' END || lpad(CAST(abs(lon) AS VARCHAR), 2, '0') AS location FROM regions
"""
CTES["flux"] = """
SELECT date_trunc('minute', ts) AS ts, CASE WHEN min(event_id) % 10 = 0 THEN -99999.0 ELSE round(max(value), 2) END AS b_avg
FROM events GROUP BY 1
"""
CTES["samples"] = """
SELECT o_orderkey AS sample_id, strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus = 'F' AS flaring, o_totalprice AS price FROM orders
"""


class Tables:
    """Lazily read test tables and their adapters for one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        rows = self.read("events")
        fit_shuffles(self.spark, rows.count())
        return rows

    @cached_property
    def cat(self) -> DataFrame:
        i, u, v = F.col("event_id"), F.col("user_id"), F.col("value")
        letter = F.when(v < 5, "A").when(v < 20, "B").when(v < 60, "C").when(v < 150, "M").otherwise("X")
        number = F.when((v >= 150) & (i % 3 == 2), "10.0").otherwise(
            F.concat((i % 3 + 1).cast("string"), F.when(u % 2 == 0, ".0").otherwise(".5"))
        )
        located = i % 11 != 0
        rows = self.events.select(
            i.alias("id"), u, F.col("event_type").alias("src"), F.col("ts").alias("start_time"),
            (F.col("ts") + F.lit(timedelta(minutes=5))).alias("peak_time"),
            F.timestamp_add("MINUTE", F.floor(v), F.col("ts")).alias("end_time"), v,
            F.concat(letter, number).alias("goes_class"),
            F.when(located, (i * 7919) % 121 - 60).alias("lat"), F.when(located, (i * 104729) % 181 - 90).alias("lon"),
            F.when(i % 7 == 0, 0).when(u % 2 == 0, u + 1).otherwise(u + 10001).alias("raw_ar"),
            (i % 3 == 0).alias("primary_verified"), (i % 5 == 0).alias("secondary_verified"),
        )
        text = F.concat(F.lit("("), F.col("lon").cast("string"), F.lit(", "), F.col("lat").cast("string"), F.lit(")"))
        return rows.withColumns({
            "x": (F.col("lon") * 10).cast("double"), "y": (F.col("lat") * 10).cast("double"),
            "goes_location": F.coalesce(text, F.lit("(0, 0)")), "ar": normalize_key_number(F.col("raw_ar")),
        })

    def source(self, name: str) -> DataFrame:
        return self.cat.where(F.col("src") == name)

    @cached_property
    def goes(self) -> DataFrame:
        return self.source("error")

    @cached_property
    def ssw(self) -> DataFrame:
        return self.source("purchase")

    @cached_property
    def xrt(self) -> DataFrame:
        return self.source("signup")

    @cached_property
    def hourly(self) -> DataFrame:
        return self.events.groupBy("user_id", floor_time(F.col("ts"), HOUR).alias("ts")).agg(
            F.avg("value").alias("p_avg"), F.max("value").alias("p_max"), F.count(F.lit(1)).alias("p_n")
        )

    @cached_property
    def grid(self) -> DataFrame:
        from ..operators.series import regrid

        return regrid(self.hourly, ["user_id"], "ts", HOUR)

    @cached_property
    def placed(self) -> DataFrame:
        """Grid times with position and length of the series."""
        from ..operators.series import regrid

        return regrid(self.hourly, ["user_id"], "ts", HOUR, placed=True)

    @cached_property
    def header(self) -> DataFrame:
        i = F.col("event_id")
        return self.events.where(F.col("event_type") == "view").select(
            "user_id", F.col("ts").alias("hts"), i.alias("hid"), ((i * 7919) % 91 - 50).alias("lat_min"),
            ((i * 7919) % 91 - 38).alias("lat_max"), ((i * 104729) % 151 - 85).alias("lon_min"), ((i * 104729) % 151 - 61).alias("lon_max"),
            F.when(i % 5 == 0, 1).otherwise(0).alias("quality"),
        )

    @cached_property
    def keymap(self) -> DataFrame:
        u = F.col("user_id")
        mapped = self.events.where(u % 13 != 0).select("user_id").distinct()
        first = (u + 10001).cast("string")
        text = F.when(u % 6 == 0, F.concat(first, F.lit(","), (u + 10002).cast("string"))).otherwise(first)
        return mapped.select(u, text.alias("keys_text"), F.transform(F.split(text, ","), lambda t: t.cast("bigint")).alias("keys"))

    @cached_property
    def regions(self) -> DataFrame:
        i = F.col("event_id")
        daily = self.events.where(F.col("event_type") == "click").groupBy(
            (F.col("user_id") + 10001).alias("region"), F.to_date("ts").cast("timestamp_ntz").alias("ar_time")
        )
        return daily.agg((F.min(i * 7919) % 101 - 50).alias("lat"), (F.min(i * 104729) % 141 - 70).alias("lon"))

    @cached_property
    def regtext(self) -> DataFrame:
        def part(c: str, positive: str, negative: str):
            v = F.col(c)
            return F.concat(F.when(v >= 0, positive).otherwise(negative), F.lpad(F.abs(v).cast("string"), 2, "0"))

        return self.regions.withColumn("location", F.concat(part("lat", "N", "S"), part("lon", "W", "E")))

    @cached_property
    def flux(self) -> DataFrame:
        return self.events.groupBy(floor_time(F.col("ts"), timedelta(minutes=1)).alias("ts")).agg(
            F.when(F.min("event_id") % 10 == 0, -99999.0).otherwise(F.round(F.max("value"), 2)).alias("b_avg")
        )

    @cached_property
    def samples(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_orderkey").alias("sample_id"), F.date_format("o_orderdate", "yyyy-MM").alias("month"),
            (F.col("o_orderstatus") == "F").alias("flaring"), F.col("o_totalprice").alias("price"),
        )
