"""Column functions over the event catalogue."""

from datetime import timedelta

from pyspark.sql import functions as F

from ..functions import classes as C
from ..functions import keys as K
from ..functions import places as P
from ..functions import times as T
from ..operators.events import select_columns
from .registry import query
from .tables import R, r6



@query("parse_point", "P1", f"""
SELECT id, CAST(lon AS DOUBLE) AS p_lon, CAST(lat AS DOUBLE) AS p_lat FROM cat""")
def _(t):
    point = P.format_point(F.col("lon"), F.col("lat"))
    text = F.when(F.col("id") % 2 == 0, point).otherwise(F.when(F.col("lat").isNotNull(), F.col("goes_location")).otherwise("unknown"))
    lon, lat = P.parse_point(text)
    return t.cat.select("id", lon.alias("p_lon"), lat.alias("p_lat"))


@query("parse_compass", "P2", """
SELECT region, ar_time, CAST(lon AS DOUBLE) AS w_lon, CAST(lat AS DOUBLE) AS w_lat, CAST(-lon AS DOUBLE) + 0.0 AS e_lon FROM regtext""")
def _(t):
    lon, lat = P.parse_compass(F.col("location"))
    east, _ = P.parse_compass(F.col("location"), east_sign=1)
    zero = F.lit(0.0)
    return t.regtext.select("region", "ar_time", (lon + zero).alias("w_lon"), (lat + zero).alias("w_lat"), (east + zero).alias("e_lon"))


@query("format_point", "P3", """
SELECT id, 'POINT(' || lon || ' ' || lat || ')' AS point_text, '(' || lon || ', ' || lat || ')' AS pair_text FROM cat""")
def _(t):
    lon, lat = F.col("lon"), F.col("lat")
    return t.cat.select("id", P.format_point(lon, lat).alias("point_text"), P.format_point(lon, lat, "pair").alias("pair_text"))


@query("disc_xy", "P4", f"""
SELECT id, {R("sin(radians(lon)) * cos(radians(lat))")} AS disc_x, {R("sin(radians(lat))")} AS disc_y FROM cat""")
def _(t):
    x, y = P.disc_xy(F.col("lon"), F.col("lat"))
    return t.cat.select("id", r6(x).alias("disc_x"), r6(y).alias("disc_y"))


def earth_view_sql(source: str, ts: str) -> str:
    """Rows of ``source`` with distance ``d`` (solar radii) and tilt ``b0`` (radians) at ``ts``."""
    return f"""
    SELECT *, 1.000001018 * (1 - ecc * ecc) / (1 + ecc * cos(anom + radians(cen))) * (149597870.7 / 695700.0) AS d,
           asin(sin(radians(ml + cen - 0.00569) - node) * sin(radians(7.25))) AS b0
    FROM (SELECT *, (1.914602 - cty * 0.004817 - cty * cty * 0.000014) * sin(anom) + (0.019993 - cty * 0.000101) * sin(2 * anom)
                    + 0.000289 * sin(3 * anom) AS cen
          FROM (SELECT *, radians(357.52911 + cty * 35999.05029 - cty * cty * 0.0001537) AS anom,
                       280.46646 + cty * 36000.76983 + cty * cty * 0.0003032 AS ml,
                       0.016708634 - cty * 0.000042037 - cty * cty * 0.0000001267 AS ecc,
                       radians(73.6667 + (cty * 36525.0 + 2451545.0 - 2396758.0) * (1.3958333 / 36525.0)) AS node
                FROM (SELECT *, (epoch_us({ts}) / 86400000000.0::DOUBLE - 10957.5::DOUBLE) / 36525.0::DOUBLE AS cty FROM {source})))"""


HPC = """
SELECT id, atan2(hx, dz) * 648000 / pi() AS tx, asin(hy / sqrt(hx * hx + hy * hy + dz * dz)) * 648000 / pi() AS ty, d, b0
FROM (SELECT *, cos(b) * sin(l) AS hx, sin(b) * cos(b0) - cos(b) * cos(l) * sin(b0) AS hy,
             d - (sin(b) * sin(b0) + cos(b) * cos(l) * cos(b0)) AS dz
      FROM (SELECT *, radians(lon) AS l, radians(lat) AS b FROM ({view})))"""


@query("hgs_to_hpc", "P5", f"""
SELECT id, (round(tx, 4) + 0.0) AS x_hpc, (round(ty, 4) + 0.0) AS y_hpc FROM ({HPC.format(view=earth_view_sql("cat", "start_time"))})""")
def _(t):
    rows = P.add_hpc(t.cat, "lon", "lat", "start_time")
    return rows.select("id", *[(F.round(c, 4) + F.lit(0.0)).alias(c) for c in ("x_hpc", "y_hpc")])


@query("hpc_to_hgs", "P6", f"""
SELECT id, (round(degrees(atan2(x3, z3 * cos(b0) - y3 * sin(b0))), 4) + 0.0) AS hgs_lon,
       (round(degrees(asin(y3 * cos(b0) + z3 * sin(b0))), 4) + 0.0) AS hgs_lat
FROM (SELECT *, ray * cos(py) * sin(px) AS x3, ray * sin(py) AS y3, d - ray * cos(py) * cos(px) AS z3
      FROM (SELECT *, q - sqrt(CASE WHEN q * q - d * d + 1 >= 0 THEN q * q - d * d + 1 END) AS ray
            FROM (SELECT *, d * cos(px) * cos(py) AS q
                  FROM (SELECT *, radians(x / 3600.0::DOUBLE) AS px, radians(y / 3600.0::DOUBLE) AS py FROM ({earth_view_sql("cat", "peak_time")})))))""")
def _(t):
    rows = P.add_hgs(t.cat, "x", "y", "peak_time", ("hgs_lon", "hgs_lat"))
    return rows.select("id", *[(F.round(c, 4) + F.lit(0.0)).alias(c) for c in ("hgs_lon", "hgs_lat")])


ROTATION = "(14.11 - 1.7 * pow(sin(radians(lat)), 2) - 2.35 * pow(sin(radians(lat)), 4))"


@query("rotation_lon_delta", "P7", f"SELECT id, {R(ROTATION + ' * (value / 23)')} AS lon_delta FROM cat")
def _(t):
    return t.cat.select("id", r6(P.rotation_lon_delta(F.col("lat"), F.col("value") / 23)).alias("lon_delta"))


@query("advance_centroid", "P8", f"""
SELECT id, {R(f"lon + {ROTATION} * (value / 47)")} AS moved,
       CASE WHEN lon IS NOT NULL THEN {R(f"greatest(-90.0, least(90.0, lon + {ROTATION} * (value / 47)))")} END AS clamped FROM cat""")
def _(t):
    lon, lat, days = F.col("lon"), F.col("lat"), F.col("value") / 47
    return t.cat.select(
        "id", r6(P.advance_centroid(lon, lat, days)).alias("moved"), r6(P.advance_centroid(lon, lat, days, 90)).alias("clamped")
    )


CENTRAL = """degrees(atan2(sqrt(pow(cos({b}) * sin({dl}), 2) + pow(cos({a}) * sin({b}) - sin({a}) * cos({b}) * cos({dl}), 2)),
 sin({a}) * sin({b}) + cos({a}) * cos({b}) * cos({dl})))"""
CENTRAL_EVENTS = CENTRAL.format(a="radians(lat)", b="radians(value / 10)", dl="(radians(lon) - radians(value / 5))")
ANGLE = CENTRAL.format(a="radians(lat - value / 100)", b="radians(0.0)", dl="radians(lon - value / 10)")


@query("great_circle_deg", "P9", f"SELECT id, {R(CENTRAL_EVENTS)} AS angle FROM cat")
def _(t):
    v = F.col("value")
    return t.cat.select("id", r6(P.great_circle_deg(F.col("lat"), F.col("lon"), v / 10, v / 5)).alias("angle"))


@query("heliocentric_angle", "P10", f"SELECT id, {R(ANGLE)} AS hc_angle FROM cat")
def _(t):
    v = F.col("value")
    return t.cat.select("id", r6(P.heliocentric_angle(F.col("lon"), F.col("lat"), v / 10, v / 100)).alias("hc_angle"))


@query("trust_flags", "P11", """
SELECT id, coalesce(value < 70, false) AS spei, coalesce(value < 70, false) AND coalesce(lat % 5 = 0, false) AS is_tmfi FROM cat""")
def _(t):
    inside, trusted = P.trust_flags(F.col("value"), F.col("lat") % 5)
    return t.cat.select("id", inside.alias("spei"), trusted.alias("is_tmfi"))


@query("normalize_key_number", "P12", "SELECT id, ar AS key_number FROM cat")
def _(t):
    return t.cat.select("id", K.normalize_key_number(F.col("raw_ar")).alias("key_number"))


@query("normalize_key_number_offset", "P13", """
SELECT id, CASE WHEN raw_ar <> 0 THEN raw_ar + 10000 END AS key_number FROM cat WHERE lat IS NOT NULL""")
def _(t):
    from ..plans.integrate import prepare_secondary

    text = F.coalesce(P.format_point(F.col("lon"), F.col("lat")), F.lit("POINT(nan nan)"))
    rows = t.cat.withColumns({"ssw_location": text, "noaa_active_region": F.col("raw_ar")})
    return prepare_secondary(rows).select("id", F.col("noaa_active_region").alias("key_number"))


@query("coalesce_sources", "P14", """
SELECT id, coalesce(CASE WHEN id % 2 = 0 THEN peak_time END, CASE WHEN id % 3 = 0 THEN start_time END, end_time) AS peak,
       coalesce(nullif(raw_ar, 0), nullif(user_id, 0)) AS region FROM cat""")
def _(t):
    i = F.col("id")
    peak = K.coalesce_sources(F.when(i % 2 == 0, F.col("peak_time")), F.when(i % 3 == 0, F.col("start_time")), F.col("end_time"))
    return t.cat.select("id", peak.alias("peak"), K.coalesce_sources(F.col("raw_ar"), F.col("user_id"), invalid=(0,)).alias("region"))


@query("consolidate_location", "P15", """
SELECT id, coalesce(CASE WHEN id % 2 = 0 THEN nullif(goes_location, '(0, 0)') END, CASE WHEN lat IS NOT NULL THEN 'POINT(' || (lon + 1) || ' ' || (lat + 1) || ')' END) AS loc_text,
       CAST(lon + CASE WHEN id % 2 = 0 THEN 0 ELSE 1 END AS DOUBLE) AS loc_lon,
       CAST(lat + CASE WHEN id % 2 = 0 THEN 0 ELSE 1 END AS DOUBLE) AS loc_lat FROM cat""")
def _(t):
    first = F.when(F.col("id") % 2 == 0, F.col("goes_location")).otherwise("(0, 0)")
    text, lon, lat = P.consolidate_location(first, P.format_point(F.col("lon") + 1, F.col("lat") + 1))
    return t.cat.select("id", text.alias("loc_text"), lon.alias("loc_lon"), lat.alias("loc_lat"))


@query("fill_location_from_centroid", "P16", """
SELECT id, CASE WHEN lat IS NULL THEN '(' || user_id || ', 5)' ELSE goes_location END AS filled,
       CAST(coalesce(lon, user_id) AS DOUBLE) AS f_lon, CAST(coalesce(lat, 5) AS DOUBLE) AS f_lat FROM cat""")
def _(t):
    centroid = F.concat(F.lit("("), F.col("user_id").cast("string"), F.lit(", 5)"))
    text, lon, lat = P.fill_location_from_centroid(F.col("goes_location"), centroid)
    return t.cat.select("id", text.alias("filled"), lon.alias("f_lon"), lat.alias("f_lat"))


@query("location_with_source", "P17", """
SELECT id, CASE WHEN lat IS NOT NULL AND id % 2 = 0 THEN 'GOES' WHEN id % 3 = 0 THEN 'SSW' WHEN id % 5 = 0 THEN 'XRT' ELSE 'NoLocation' END AS fl_loc_src,
       CASE WHEN lat IS NOT NULL AND id % 2 = 0 THEN CAST(lon AS DOUBLE) END AS own_lon,
       CASE WHEN lat IS NOT NULL AND id % 2 = 0 THEN true ELSE id % 3 = 0 OR id % 5 = 0 END AS located FROM cat""")
def _(t):
    i, own = F.col("id"), F.col("lat").isNotNull() & (F.col("id") % 2 == 0)
    rows = t.cat.select(
        "id", "peak_time", F.when(own, F.col("goes_location")).alias("fl_location"), F.when(own, F.col("lon").cast("double")).alias("fl_lon"),
        F.when(own, F.col("lat").cast("double")).alias("fl_lat"),
        F.when(i % 3 == 0, 100.0).alias("sx"), F.when(i % 3 == 0, -50.0).alias("sy"),
        F.when(i % 5 == 0, -300.0).alias("hx"), F.when(i % 5 == 0, 20.0).alias("hy"),
    )
    out = P.location_with_source(rows, ("fl_location", "fl_lon", "fl_lat"), ("sx", "sy"), ("hx", "hy"), "peak_time")
    return out.select(
        "id", "fl_loc_src", F.when(F.col("fl_loc_src") == "GOES", F.col("fl_lon")).alias("own_lon"), F.col("fl_lon").isNotNull().alias("located")
    )


@query("class_letter", "P18", """
SELECT id, substr(goes_class, 1, 1) AS letter, CASE substr(goes_class, 1, 1) WHEN 'A' THEN 'B' WHEN 'X' THEN 'M' ELSE substr(goes_class, 1, 1) END AS merged FROM cat""")
def _(t):
    c = F.col("goes_class")
    return t.cat.select("id", C.class_letter(c).alias("letter"), C.class_letter(c, {"A": "B", "X": "M"}).alias("merged"))


SCALE = "CASE substr(goes_class, 1, 1) WHEN 'A' THEN 1e-8 WHEN 'B' THEN 1e-7 WHEN 'C' THEN 1e-6 WHEN 'M' THEN 1e-5 ELSE 1e-4 END::DOUBLE"
FLUX = f"(CAST(substr(goes_class, 2) AS DOUBLE) * {SCALE})"


@query("class_to_flux", "P19", f"SELECT id, (round({FLUX} * 1e9, 3) + 0.0) AS nano_flux FROM cat")
def _(t):
    return t.cat.select("id", (F.round(C.class_to_flux(F.col("goes_class")) * 1e9, 3) + F.lit(0.0)).alias("nano_flux"))


@query("flux_to_class", "P20", """
SELECT id, letter || printf('%.1f', num) AS flux_class
FROM (SELECT id, CASE WHEN value < 5 THEN 'A' WHEN value < 20 THEN 'B' WHEN value < 60 THEN 'C' WHEN value < 150 THEN 'M' ELSE 'X' END AS letter,
             (1 + id % 8) + 0.23 AS num FROM cat)""")
def _(t):
    scale = C.class_to_flux(F.concat(C.class_letter(F.col("goes_class")), F.lit("1")))
    return t.cat.select("id", C.flux_to_class(scale * (F.col("id") % 8 + 1.23)).alias("flux_class"))


@query("date_parts", "P21", """
SELECT id, strftime(start_time, '%Y') AS "year", strftime(start_time, '%m') AS "month", strftime(start_time, '%d') AS "day",
       strftime(start_time, '%H') AS "hour", strftime(start_time, '%M') AS "minute", strftime(start_time, '%Y-%m') AS year_month,
       strftime(start_time, '%Y-%m-%d') AS year_month_day FROM cat""")
def _(t):
    return t.cat.select("id", *T.date_parts(F.col("start_time")))


@query("select_columns", "P22", "SELECT id, goes_class AS class_text, peak_time AS peak FROM cat")
def _(t):
    return select_columns(t.cat, ["id", "goes_class", "peak_time"], {"goes_class": "class_text", "peak_time": "peak"})


@query("fix_midnight_rollover", "P23", """
SELECT id, peak2 AS peak, CASE WHEN peak2 > e THEN e + INTERVAL 1 DAY ELSE e END AS end_fixed
FROM (SELECT *, CASE WHEN s > p THEN p + INTERVAL 1 DAY ELSE p END AS peak2
      FROM (SELECT id, start_time AS s, date_trunc('day', start_time) + (peak_time - date_trunc('day', peak_time)) AS p,
                   date_trunc('day', start_time) + (end_time - date_trunc('day', end_time)) AS e FROM cat))""")
def _(t):
    def on_start_day(c):
        day = F.to_date("start_time").cast("timestamp_ntz")
        return day + (F.col(c) - F.to_date(c).cast("timestamp_ntz"))

    peak, end = T.fix_midnight_rollover(F.col("start_time"), on_start_day("peak_time"), on_start_day("end_time"))
    return t.cat.select("id", peak.alias("peak"), end.alias("end_fixed"))


@query("combine_date_and_time", "P24", """
SELECT id, date_trunc('second', date_trunc('day', start_time) + (peak_time - date_trunc('day', peak_time))) AS peak FROM cat""")
def _(t):
    start, clock = F.date_format("start_time", "yyyy/MM/dd HH:mm:ss"), F.date_format("peak_time", "HH:mm:ss")
    return t.cat.select("id", T.combine_date_and_time(start, clock).alias("peak"))


@query("build_label", "P26", """
SELECT id, '{"magnitude": "' || goes_class || '", "id": ' || id || ', "NOAA_AR": ' || coalesce(CAST(ar AS VARCHAR), 'null') || ', "narn_source": '
       || CASE WHEN ar IS NULL THEN 'null' ELSE '"GOES"' END || ', "verification": "' ||
       CASE WHEN primary_verified THEN 'Primary' WHEN secondary_verified THEN 'Secondary' ELSE 'Non-verified' END || '"}' AS label FROM cat""")
def _(t):
    tag = C.verification_tag(F.col("primary_verified"), F.col("secondary_verified"))
    source = F.when(F.col("ar").isNotNull(), "GOES")
    return t.cat.select("id", C.build_label(F.col("goes_class"), F.col("id"), F.col("ar"), source, tag).alias("label"))


def three_labels():
    """Label text of three events made from one row: own class, B1.0 and the class of its user."""
    tag = C.verification_tag(F.col("primary_verified"), F.col("secondary_verified"))
    own = C.build_label(F.col("goes_class"), F.col("id"), F.col("ar"), F.lit("GOES"), tag)
    small = C.build_label(F.lit("B1.0"), F.col("id") + 1, F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("Non-verified"))
    other = C.build_label(F.concat(F.lit("C"), (F.col("user_id") % 9 + 1).cast("string"), F.lit(".0")), F.col("id") + 2, F.col("ar"), F.lit("SSW"), F.lit("Secondary"))
    return F.when(F.col("id") % 4 == 0, "None").otherwise(F.concat_ws(";", own, small, other))


@query("parse_label_max", "P27", """
SELECT id, CASE WHEN id % 4 = 0 THEN 'None' ELSE best END AS label, CASE WHEN id % 4 = 0 THEN 'None' ELSE best || ':' || ver END AS label_verified,
       CASE WHEN id % 4 = 0 THEN 'None' ELSE best || ':Secondary' END AS label_compat
FROM (SELECT id, CASE WHEN goes_class >= 'B1.0' AND goes_class >= other THEN goes_class || '@' || id WHEN other > 'B1.0' THEN other || '@' || (id + 2) END AS best,
             CASE WHEN goes_class >= 'B1.0' AND goes_class >= other THEN own ELSE 'Secondary' END AS ver
      FROM (SELECT *, 'C' || (user_id % 9 + 1) || '.0' AS other,
                   CASE WHEN primary_verified THEN 'Primary' WHEN secondary_verified THEN 'Secondary' ELSE 'Non-verified' END AS own FROM cat))""")
def _(t):
    text = three_labels()
    return t.cat.select(
        "id", C.parse_label_max(text).alias("label"), C.parse_label_max(text, True).alias("label_verified"),
        C.parse_label_max(text, True, compat_last_verification=True).alias("label_compat"),
    )


@query("verification_tag", "P28", """
SELECT id, CASE WHEN primary_verified THEN 'Primary' WHEN secondary_verified THEN 'Secondary' ELSE 'Non-verified' END AS tag FROM cat""")
def _(t):
    return t.cat.select("id", C.verification_tag(F.col("primary_verified"), F.col("secondary_verified")).alias("tag"))


@query("minkowski_within", "P29", """
SELECT id, coalesce(sqrt(pow(lon - value / 3, 2) + pow(lat - value / 5, 2)) < 15, true) AS near_l2,
       coalesce(abs(lon - value / 3) + abs(lat - value / 5) < 15, true) AS near_l1 FROM cat""")
def _(t):
    a = (F.col("lon"), F.col("lat"), F.col("value") / 3, F.col("value") / 5)
    return t.cat.select("id", P.minkowski_within(*a, 15).alias("near_l2"), P.minkowski_within(*a, 15, 1).alias("near_l1"))


@query("row_min", "P30", "SELECT id, least(x, y, value) AS smallest FROM (SELECT id, CAST(lon AS DOUBLE) AS x, CAST(lat AS DOUBLE) AS y, value FROM cat)")
def _(t):
    return t.cat.select("id", K.row_min(F.col("lon").cast("double"), F.col("lat").cast("double"), F.col("value")).alias("smallest"))


@query("rows_to_hours", "P31", "SELECT user_id, count(*) AS n, count(*) / 5.0::DOUBLE AS hours FROM hourly GROUP BY 1")
def _(t):
    counts = t.hourly.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("hours", T.rows_to_hours(F.col("n"), timedelta(minutes=12)))


@query("has_location_has_key", "P32", "SELECT id, goes_location <> '(0, 0)' AS has_location, raw_ar <> 0 AS has_key FROM cat")
def _(t):
    return t.cat.select("id", P.has_location(F.col("goes_location")).alias("has_location"), K.has_key(F.col("raw_ar")).alias("has_key"))


PICK = """
SELECT id, user_id, CASE WHEN a IS NOT NULL THEN CASE WHEN list_contains(ks, a) THEN a ELSE -1 END
                WHEN b IS NOT NULL THEN CASE WHEN list_contains(ks, b) THEN b ELSE -1 END
                WHEN c IS NOT NULL AND list_contains(ks, c) THEN c ELSE -1 END AS region,
       CASE WHEN a IS NOT NULL THEN CASE WHEN list_contains(ks, a) THEN 'GOES' END
            WHEN b IS NOT NULL THEN CASE WHEN list_contains(ks, b) THEN 'XRT' END
            WHEN c IS NOT NULL AND list_contains(ks, c) THEN 'SSW' END AS source
FROM (SELECT id, cat.user_id, ar AS a, CASE WHEN id % 2 = 0 THEN 10001 + (cat.user_id + 1) END AS b, CASE WHEN id % 3 = 0 THEN 10001 + cat.user_id END AS c,
             list_transform(string_split(keys_text, ','), lambda s: CAST(s AS BIGINT)) AS ks
      FROM cat LEFT JOIN keymap ON cat.user_id = keymap.user_id)"""


def candidate_numbers(df):
    u, i = F.col("user_id"), F.col("id")
    return df.withColumns({"hinode_ar": F.when(i % 2 == 0, u + 10002), "ssw_ar": F.when(i % 3 == 0, u + 10001)})


@query("pick_key_source", "P33", PICK)
def _(t):
    rows = candidate_numbers(t.cat).join(t.keymap.select("user_id", "keys"), "user_id", "left")
    number, source = K.pick_key_source(F.col("ar"), F.col("hinode_ar"), F.col("ssw_ar"), F.col("keys"))
    return rows.select("id", "user_id", number.alias("region"), source.alias("source"))


@query("numeric_coerce", "P34", """
SELECT id, TRY_CAST(CASE WHEN id % 3 = 0 THEN '----' ELSE CAST(user_id AS VARCHAR) END AS DOUBLE) AS number FROM cat""")
def _(t):
    text = F.when(F.col("id") % 3 == 0, "----").otherwise(F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(" ")))
    return t.cat.select("id", K.numeric_coerce(text).alias("number"))


@query("clean_scraped_events", "P25", """
SELECT id, s AS start_time, peak2 AS peak_time, CASE WHEN peak2 > e THEN e + INTERVAL 1 DAY ELSE e END AS end_time, goes_class,
       raw_ar AS noaa_active_region, goes_location
FROM (SELECT *, CASE WHEN s > p THEN p + INTERVAL 1 DAY ELSE p END AS peak2
      FROM (SELECT id, goes_class, raw_ar, date_trunc('second', start_time) AS s,
                   date_trunc('second', date_trunc('day', start_time) + (peak_time - date_trunc('day', peak_time))) AS p,
                   date_trunc('second', date_trunc('day', start_time) + (end_time - date_trunc('day', end_time))) AS e,
                   'POINT(' || lon || ' ' || lat || ')' AS goes_location FROM cat))""")
def _(t):
    from ..plans.integrate import clean_scraped_events

    def signed(c, positive, negative):
        return F.concat(F.when(F.col(c) >= 0, positive).otherwise(negative), F.lpad(F.abs(F.col(c)).cast("string"), 2, "0"))

    number = F.when(F.col("raw_ar") == 0, "").otherwise(F.col("raw_ar").cast("string"))
    scraped = t.cat.select(
        "id", F.date_format("start_time", "yyyy/MM/dd HH:mm:ss").alias("Start"), F.date_format("peak_time", "HH:mm:ss").alias("Peak"),
        F.date_format("end_time", "HH:mm:ss").alias("Stop"), F.col("goes_class").alias("GOES Class"),
        F.concat(signed("lat", "N", "S"), signed("lon", "W", "E")).alias("Derived Position"),
        F.concat(F.lit(" ( "), number, F.lit(" ) ")).alias("NOAA_AR"),
    )
    return clean_scraped_events(scraped)
