"""Readers and writers, run on files that Spark writes from the test tables.

Each query writes the table in the layout a reader expects (below the shared folder), reads it back
and must return what SQL gets from the table itself.
"""

from pyspark.sql import functions as F

from ..operators import history as H
from ..operators.sampling import sample_splits
from ..session import shared_path
from ..sources import readers as RD
from ..sources import writers as WR
from .joins import NUMBERS, by_key, by_place, candidate_numbers
from .labels import mixed
from .registry import query
from .sampling import priced
from .tables import CTES

SEC = "date_trunc('second', {})"


def stored_text(df, name, *partition_by, **options):
    path = shared_path(df.sparkSession, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.options(**options).csv(path)
    return path


def clock(c, fmt):
    return F.date_format(c, fmt).alias(c)


@query("read_events", "S1", f"""
SELECT CAST(id AS VARCHAR) AS id, {SEC.format("start_time")} AS start_time, {SEC.format("peak_time")} AS peak_time, {SEC.format("end_time")} AS end_time, goes_class, ar AS noaa_active_region FROM cat""")
def _(t):
    names = ["id", "start_time", "peak_time", "end_time", "goes_class", "noaa_active_region"]
    rows = t.cat.select("id", *[clock(c, "yyyyMMdd_HHmmss") for c in names[1:4]], "goes_class", F.col("ar").alias("noaa_active_region"))
    path = stored_text(rows, "events", header=True, nullValue="NaN")
    return RD.read_events(t.spark, path, names, numbers={"noaa_active_region": "bigint"})


@query("read_events_iso", "S1", f"SELECT CAST(id AS VARCHAR) AS id, {SEC.format('start_time')} AS start_time, {SEC.format('peak_time')} AS peak_time, {SEC.format('end_time')} AS end_time FROM cat")
def _(t):
    names = ["id", "start_time", "peak_time", "end_time"]
    rows = t.cat.select("id", *[clock(c, RD.ISO_TIME) for c in names[1:]])
    return RD.read_events(t.spark, stored_text(rows, "events", header=True, sep="\t"), names, sep="\t", time_format=RD.ISO_TIME)


def compass(lon="lon", lat="lat"):
    def part(c, positive, negative):
        return F.concat(F.when(F.col(c) >= 0, positive).otherwise(negative), F.lpad(F.abs(F.col(c)).cast("string"), 2, "0"))

    return F.concat(part(lat, "N", "S"), part(lon, "W", "E"))


@query("read_hinode_events", "S2", """
SELECT CAST(id AS VARCHAR) AS id, date_trunc('minute', start_time) AS start_time, date_trunc('minute', peak_time) AS peak_time, date_trunc('minute', end_time) AS end_time, goes_class,
       CAST(ar AS DOUBLE) AS noaa_active_region, 'POINT(' || lon || ' ' || lat || ')' AS ar_location, CAST(lat AS DOUBLE) + 0.0 AS fl_lat, CAST(lon AS DOUBLE) + 0.0 AS fl_lon, x AS x_hpc, y AS y_hpc
FROM xrt WHERE start_time >= TIMESTAMP '2024-01-03 00:01:00'""")
def _(t):
    fmt = "yyyy/MM/dd HH:mm"
    rows = t.xrt.select(
        "id", *[F.date_format(f"{c}_time", fmt).alias(c) for c in ("start", "peak", "end")], compass().alias("loc1"),
        F.concat(F.lit(" "), F.col("goes_class"), F.lit(" ")).alias("class"), F.coalesce(F.col("ar").cast("string"), F.lit("----")).alias("region"),
        F.col("x").alias("X"), F.col("y").alias("Y"),
    )
    path = stored_text(rows, "xrt", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    out = RD.read_hinode_events(t.spark, path, after="2024-01-03")
    return out.withColumns({c: F.col(c) + F.lit(0.0) for c in ("fl_lat", "fl_lon")})


@query("read_series", "S3", """
SELECT CAST(strftime(ts, '%d') AS INTEGER) AS harpnum, date_trunc('second', ts) AS ts, value AS "TOTUSJH", CASE WHEN event_id % 9 <> 0 THEN CAST(user_id AS DOUBLE) END AS "R_VALUE" FROM events""")
def _(t):
    rows = t.events.select(
        F.day("ts").alias("harpnum"), F.date_format("ts", "yyyyMMdd_HHmmss").alias("Timestamp"), F.col("value").alias("TOTUSJH"),
        F.when(F.col("event_id") % 9 != 0, F.col("user_id").cast("double")).alias("R_VALUE"),
    )
    path = stored_text(rows, "series", "harpnum", header=True, sep="\t", nullValue="NaN")
    return RD.read_series(t.spark, path, "Timestamp string, TOTUSJH double, R_VALUE double", files="*/*.csv", key_pattern=r"harpnum=(\d+)/")


@query("read_series_header", "S4", """
SELECT CAST(strftime(hts, '%d') AS INTEGER) AS harpnum, date_trunc('minute', hts) AS ts, CAST(lat_min AS DOUBLE) AS "LAT_MIN", CAST(lat_max AS DOUBLE) AS "LAT_MAX", CAST(quality AS DOUBLE) AS "QUALITY" FROM header""")
def _(t):
    rows = t.header.select(
        F.day("hts").alias("harpnum"), F.date_format("hts", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("DATE__OBS"), F.col("lat_min").alias("LAT_MIN"),
        F.col("lat_max").alias("LAT_MAX"), F.col("quality").alias("QUALITY"),
    )
    path = stored_text(rows, "header", "harpnum", header=True, sep="\t")
    return RD.read_series_header(t.spark, path, fields=["DATE__OBS", "LAT_MIN", "LAT_MAX", "QUALITY"], files="*/*.csv", key_pattern=r"harpnum=(\d+)/")


@query("read_key_map", "S5", "SELECT CAST(user_id AS INTEGER) AS harpnum, keys_text FROM keymap")
def _(t):
    rows = t.keymap.select(F.col("user_id").alias("HARPNUM"), F.col("keys_text").alias("NOAA_ARS"))
    out = RD.read_key_map(t.spark, stored_text(rows, "keymap", header=True, sep=" "))
    return out.select("harpnum", F.array_join(F.transform("keys", lambda k: k.cast("string")), ",").alias("keys_text"))


@query("read_fixed_width_regions", "S6", """
SELECT CAST(strftime(ar_time, '%Y') AS INTEGER) AS "year", CAST(strftime(ar_time, '%m') AS INTEGER) AS "month", CAST(strftime(ar_time, '%d') AS INTEGER) AS "day", region AS noaa_ar_no,
       'B' AS greenwich, 'Bxo' AS mcintosh, CAST(lat AS DOUBLE) + 0.0 AS latitude, CAST(lon AS DOUBLE) + 0.0 AS central_meridian_dist FROM regions""")
def _(t):
    def at(value, size):
        return F.lpad(value.cast("string"), size, " ")

    d = F.col("ar_time")
    line = F.concat(
        F.date_format(d, "yyyy"), at(F.month(d), 2), at(F.day(d), 2), F.lit(".000"), at(F.col("region"), 8), F.lit(" B   "), F.lit(" Bxo"),
        F.lit("   18    3   10 0.406 303.9 215.0"), F.lit(" "), at(F.col("lat").cast("double"), 5), F.lit(" "), at(F.col("lon").cast("double"), 5),
    )
    path = shared_path(t.spark, "regions")
    t.regions.select(line.alias("value")).write.text(path)
    out = RD.read_fixed_width_regions(t.spark, path)
    zero = F.lit(0.0)
    return out.select(
        "year", "month", "day", F.col("noaa_ar_no").cast("bigint").alias("noaa_ar_no"), "greenwich", "mcintosh", (F.col("latitude") + zero).alias("latitude"),
        (F.col("central_meridian_dist") + zero).alias("central_meridian_dist"),
    )


def reports(t):
    """Daily region reports as text files, one report a file; at most 1000 regions go into one report."""
    spot = F.concat_ws(" ", (F.col("region") - 10000).cast("string"), "location", F.abs("lon").cast("string"), F.lit("0120 Dai  08   12 Beta"))
    plage = F.concat_ws(" ", (F.col("region") - 10000).cast("string"), "location", F.abs("lon").cast("string"))
    is_plage = F.col("region") % 4 == 0
    text = F.when(is_plage, plage).otherwise(spot)
    lines = t.regtext.select(F.date_format("ar_time", "yyyyMMdd").alias("day"), F.floor(F.col("region") / 1000).alias("bucket"), "region", is_plage.alias("plage"), text.alias("line"))
    def joined(flag):
        items = F.sort_array(F.collect_list(F.when(F.col("plage") == flag, F.struct("region", "line"))))
        return F.array_join(F.transform(items, lambda i: i["line"]), "\n")

    head = "\n".join([":Product: 0412SRS.txt", ":Issued: 0030 UTC", "# Prepared jointly", "#", "Joint Summary", "SRS Number", "Report compiled", "", "Header"])
    body = F.concat_ws(
        "\n", F.lit(head), F.lit("I.  Regions with Sunspots.  Locations Valid at 12/2400Z"), F.lit("Nmbr Location  Lo  Area  Z   LL   NN Mag Type"), F.nullif(joined(False), F.lit("")),
        F.lit("IA. H-alpha Plages without Spots.  Locations Valid at 12/2400Z"), F.lit("Nmbr  Location  Lo"), F.nullif(joined(True), F.lit("")),
        F.lit("II. Regions Due to Return 13 Jan to 15 Jan"), F.lit("Nmbr Lat    Lo"), F.lit("9999 N15    110"),
    )
    path = shared_path(t.spark, "reports")
    lines.groupBy("day", "bucket").agg(body.alias("value")).select("day", "value").write.partitionBy("day").option("lineSep", "\x00").option("maxRecordsPerFile", 1).text(path)
    return {"folder": path, "files": "*/*.txt", "day_pattern": r"day=(\d{8})/"}


@query("read_sectioned_report", "S7", """
SELECT CAST(strftime(ar_time, '%Y') AS INTEGER) AS "year", CAST(strftime(ar_time, '%m') AS INTEGER) AS "month", CAST(strftime(ar_time, '%d') AS INTEGER) AS "day", CAST(region AS INTEGER) AS noaa_ar_no,
       CAST(lon AS INTEGER) AS central_meridian_dist, CAST(lat AS INTEGER) AS latitude, CAST(abs(lon) AS INTEGER) AS carrington_longitude,
       CASE WHEN region % 4 <> 0 THEN 120 END AS corr_whole_spot_area, CASE WHEN region % 4 <> 0 THEN 'Dai' ELSE 'None' END AS mcintosh, CASE WHEN region % 4 <> 0 THEN 8 END AS "LL",
       CASE WHEN region % 4 <> 0 THEN 12 END AS number_of_spots, CASE WHEN region % 4 <> 0 THEN 'Beta' ELSE 'Plage' END AS greenwich FROM regions""")
def _(t):
    return RD.read_sectioned_report(t.spark, **reports(t))


@query("read_region_rows", "S8", """
SELECT strftime(ar_time, '%Y-%m-%d') AS date, CAST(region - 10000 AS VARCHAR) AS region_number, location, CAST(abs(lon) AS VARCHAR) AS longitude, '0120' AS area, 'Dai' AS z_class, '08' AS ll, '12' AS num_spots
FROM regtext WHERE region % 4 <> 0""")
def _(t):
    return RD.read_region_rows(t.spark, **reports(t))


@query("read_flux_after_marker", "S9", "SELECT ts, CAST(0 AS DOUBLE) AS b_qual_flag, b_avg FROM flux")
def _(t):
    line = F.concat_ws(",", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit("0"), F.col("b_avg").cast("string"))
    items = F.array_join(F.sort_array(F.collect_list(line)), "\n")
    daily = t.flux.groupBy(F.date_format("ts", "yyyyMMdd").alias("day")).agg(
        F.concat_ws("\n", F.lit("netcdf g15 {\n:title = x\ntime_tag, not here"), F.lit("data:"), F.lit("time_tag,B_QUAL_FLAG,B_AVG"), items).alias("value")
    )
    path = shared_path(t.spark, "flux")
    daily.write.partitionBy("day").text(path)
    return RD.read_flux_after_marker(t.spark, f"{path}/*", ["time_tag", "b_qual_flag", "b_avg"])


@query("read_flux_series", "S10", "SELECT ts, b_avg, 'spaced' AS fmt FROM flux UNION ALL SELECT ts, b_avg, 'csv' FROM flux")
def _(t):
    text, table = shared_path(t.spark, "flux-text"), shared_path(t.spark, "flux-csv")
    t.flux.select(F.concat_ws("  ", F.date_format("ts", "dd-MMM-yyyy HH:mm:ss"), F.col("b_avg").cast("string")).alias("value")).write.text(text)
    t.flux.select(F.date_format("ts", RD.DASHED_TIME).alias("a"), F.col("b_avg").alias("b")).write.option("header", True).csv(table)
    spaced = RD.read_flux_series(t.spark, text).withColumn("fmt", F.lit("spaced"))
    return spaced.unionByName(RD.read_flux_series(t.spark, table, "csv").withColumn("fmt", F.lit("csv")))


@query("write_series", "S12", "SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, coalesce(CAST(p_n AS VARCHAR), 'NaN') AS p_n FROM grid")
def _(t):
    path = shared_path(t.spark, "series-out")
    WR.write_series(t.grid.select("user_id", "ts", "p_n"), path, fmt="csv")
    return t.spark.read.csv(path, schema="user_id long, ts string, p_n string", header=True, sep="\t")


@query("write_series_by_day", "S12 S11", "SELECT user_id, ts, p_max, CAST(ts AS DATE) AS day FROM hourly WHERE ts BETWEEN TIMESTAMP '2024-01-05 03:00:00' AND TIMESTAMP '2024-01-08 21:00:00'")
def _(t):
    from ..operators.series import scan_time_range
    from .series import stamp

    path = shared_path(t.spark, "series-day")
    WR.write_series(t.hourly.select("user_id", "ts", "p_max", F.to_date("ts").alias("day")).repartition("day"), path, partition_by="day")
    return scan_time_range(t.spark.read.parquet(path), "ts", stamp("2024-01-05 03:00:00"), stamp("2024-01-08 21:00:00"))


@query("write_instances", "S13", """
SELECT CAST("partition" AS INTEGER) AS "partition", CASE WHEN reason IS NOT NULL THEN 'filtered' ELSE outcome END AS folder, count(*) AS n FROM mixed GROUP BY 1, 2""")
def _(t):
    path = shared_path(t.spark, "instances")
    WR.write_instances(mixed(t), path)
    return t.spark.read.parquet(path).groupBy("partition", "folder").agg(F.count(F.lit(1)).alias("n"))


def stored_dataset(t):
    path = shared_path(t.spark, "dataset")
    rows = sample_splits(priced(t), "month", "flaring", ["sample_id"], ["price"])
    WR.write_dataset(rows.select("sample_id", "price", "split", F.when(F.col("flaring"), "F").otherwise("NF").alias("label")), path, "sample_id")
    return path


@query("write_dataset", "S14 R7", "SELECT upper(sp) || CASE WHEN flaring THEN '-F' ELSE '-NF' END AS role, sample_id AS item FROM validsplit WHERE rn <= least(f, q)")
def _(t):
    return RD.read_manifest(t.spark, stored_dataset(t))


@query("read_dataset", "S15", "SELECT v.sample_id, s.price FROM validsplit v JOIN samples s ON v.sample_id = s.sample_id WHERE rn <= least(f, q) AND sp = 'train' AND v.flaring")
def _(t):
    return RD.read_dataset(t.spark, stored_dataset(t), "train", "F").select("sample_id", "price")


@query("export_csv", "S15", "SELECT v.sample_id, s.price FROM validsplit v JOIN samples s ON v.sample_id = s.sample_id WHERE rn <= least(f, q) AND sp = 'test'")
def _(t):
    path = shared_path(t.spark, "export")
    WR.export_csv(RD.read_dataset(t.spark, stored_dataset(t), "test").select("sample_id", "price"), path)
    return t.spark.read.csv(path, schema="sample_id long, price double", header=True, sep="\t")


REPORTS = {
    "only_by_key": "id IN (SELECT id FROM bykey WHERE user_id NOT IN (SELECT user_id FROM byplace))",
    "only_by_location": "id IN (SELECT id FROM byplace WHERE user_id NOT IN (SELECT user_id FROM bykey))",
    "unmatched_by_key": "id NOT IN (SELECT id FROM bykey)",
    "unmatched_by_location": "id NOT IN (SELECT id FROM byplace)",
    "unmatched": "id NOT IN (SELECT id FROM bykey UNION SELECT id FROM byplace)",
}
LISTS = {"event_to_series_by_key": "bykey", "event_to_series_by_location": "byplace"}
CTES["ownseries"] = """
SELECT g.id, string_agg(DISTINCT CAST(b.user_id AS VARCHAR), ',' ORDER BY CAST(b.user_id AS VARCHAR)) AS series FROM goes g JOIN bridge b ON g.ar = b.key GROUP BY g.id
"""


@query("write_match_report", "S16", " UNION ALL ".join([
    *[f"SELECT '{name}' AS report, id, NULL AS goes_class, string_agg(DISTINCT CAST(user_id AS VARCHAR), ',' ORDER BY CAST(user_id AS VARCHAR)) AS series FROM {pairs} GROUP BY id" for name, pairs in LISTS.items()],
    *[f"SELECT '{name}', g.id, g.goes_class, o.series FROM (SELECT id, goes_class FROM goes WHERE {which}) g LEFT JOIN ownseries o ON o.id = g.id" for name, which in REPORTS.items()],
]))
def _(t):
    path = shared_path(t.spark, "match-report")
    own = H.join_by_any_key(candidate_numbers(t.goes), t.keymap, "user_id", "keys", NUMBERS[:1])
    WR.write_match_report(H.match_reports(t.goes.select("id", "goes_class"), by_key(t), by_place(t), "user_id", own_pairs=own), path)
    listed = F.array_join(F.array_sort(F.transform("series", lambda k: k.cast("string"))), ",")
    out = None
    for name, rows in RD.read_match_report(t.spark, path, (*LISTS, *REPORTS)).items():
        rows = rows.select(F.lit(name).alias("report"), "id", (F.col("goes_class") if "goes_class" in rows.columns else F.lit(None).cast("string")).alias("goes_class"), listed.alias("series"))
        out = rows if out is None else out.unionByName(rows)
    return out
