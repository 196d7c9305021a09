"""Column functions on edge values."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventloom.functions import classes as C
from eventloom.functions import keys as K
from eventloom.functions import places as P
from eventloom.functions import times as T


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


@pytest.mark.parametrize("text, want", [
    ("POINT(54 16)", (54.0, 16.0)), ("(-3.5, 12)", (-3.5, 12.0)), ("POINT(nan nan)", (None, None)), ("(0, 0)", (0.0, 0.0)),
    ("N/A", (None, None)), ("POINT(5)", (None, None)), (None, (None, None)), ("POINT(1e1 -2)", (10.0, -2.0)),
])
def test_parse_point(spark, text, want):
    assert one(spark, *P.parse_point(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("text, want", [
    ("N16W54", (54.0, 16.0)), (" S29E66", (-66.0, -29.0)), ("N**W54", (None, None)), ("", (None, None)), (None, (None, None)),
])
def test_parse_compass(spark, text, want):
    assert one(spark, *P.parse_compass(F.lit(text).cast("string"))) == want
    if want[0] is not None:
        assert one(spark, P.parse_compass(F.lit(text), east_sign=1)[0])[0] == -want[0]


# Positions and their published arcsecond coordinates.
GOLDEN = [
    ("2009-12-23 03:36:00", 54.0, 16.0, 760.352008308263, 288.02762310385003),
    ("2009-12-23 09:45:00", 66.0, -29.0, 780.5398129434775, -461.37649850435685),
]


def test_hpc_golden(spark):
    for ts, lon, lat, x, y in GOLDEN:
        df = spark.range(1).select(F.lit(lon).alias("lon"), F.lit(lat).alias("lat"), F.lit(ts).cast("timestamp_ntz").alias("ts"))
        row = P.add_hpc(df, "lon", "lat", "ts").first()
        assert abs(row.x_hpc - x) < 0.1 and abs(row.y_hpc - y) < 0.1


@pytest.mark.parametrize("day, tilt", [("2012-09-08", 7.25), ("2012-03-06", -7.25), ("2015-06-07", 0.0), ("2015-12-08", 0.0)])
def test_tilt_over_the_year(spark, day, tilt):
    df = spark.range(1).select(F.lit(day).cast("timestamp_ntz").alias("ts"))
    row = P.with_earth_view(df, "ts").first()
    assert abs(math.degrees(row[P.VIEW[1]]) - tilt) < 0.15
    assert 210 < row[P.VIEW[0]] < 220


def test_hpc_round_trip_and_off_disc(spark):
    df = spark.range(1).select(F.explode(F.array(*[F.lit(float(v)) for v in range(-80, 81, 20)])).alias("lon"), F.lit("2013-08-01 05:00:00").cast("timestamp_ntz").alias("ts"))
    df = df.withColumn("lat", F.col("lon") / 3)
    back = P.add_hgs(P.add_hpc(df, "lon", "lat", "ts"), "x_hpc", "y_hpc", "ts", ("lon2", "lat2")).collect()
    assert all(abs(r.lon - r.lon2) < 1e-6 and abs(r.lat - r.lat2) < 1e-6 for r in back)
    far = P.add_hgs(df.select(F.lit(1200.0).alias("x"), F.lit(900.0).alias("y"), "ts"), "x", "y", "ts").first()
    assert far.fl_lon is None and far.fl_lat is None


def test_key_numbers(spark):
    col = F.explode(F.array(*[F.lit(v) for v in (0, 1234, 10000, 11067)]))
    rows = spark.range(1).select(col.alias("k"))
    assert [r[0] for r in rows.select(K.normalize_key_number(F.col("k"))).collect()] == [None, 11234, 20000, 11067]
    assert [r[0] for r in rows.select(K.normalize_key_number_offset(F.col("k"))).collect()] == [None, 11234, 20000, 21067]


def test_key_hierarchy_rejects(spark):
    keys = F.array(F.lit(11093).cast("long"), F.lit(11099).cast("long"))
    null = F.lit(None).cast("long")
    assert one(spark, *K.pick_key_source(F.lit(11093), null, null, keys)) == (11093, "GOES")
    assert one(spark, *K.pick_key_source(F.lit(11000), F.lit(11093), F.lit(11093), keys)) == (-1, None)
    assert one(spark, *K.pick_key_source(null, F.lit(11099), F.lit(1), keys)) == (11099, "XRT")
    assert one(spark, *K.pick_key_source(null, null, F.lit(11099), keys)) == (11099, "SSW")
    assert one(spark, *K.pick_key_source(null, null, null, keys)) == (-1, None)
    assert one(spark, *K.pick_key_source(F.lit(11093), null, null, F.lit(None).cast("array<bigint>"))) == (-1, None)


def test_class_order_is_text_unless_flux(spark):
    c = F.lit("X10.0")
    assert one(spark, C.class_compare(c, ">", "X9.3"), C.class_compare(c, ">", "X9.3", "flux"), C.class_compare(F.lit("M1.0"), ">", "M")) == (False, True, True)


def test_class_flux(spark):
    flux, missing = one(spark, C.class_to_flux(F.lit("M1.3")), C.class_to_flux(F.lit("junk")))
    assert flux == pytest.approx(1.3e-5) and missing is None
    assert one(spark, *[C.flux_to_class(F.lit(v)) for v in (1.3e-5, 9.96e-6, 2e-4, 5e-9)]) == ("M1.3", "C10.0", "X2.0", "A0.5")


LOW = '{"magnitude": "A1.0", "id": 1, "NOAA_AR": 1, "narn_source": "GOES", "verification": "Primary"}'
BIG = '{"magnitude": "M2.0", "id": 7, "NOAA_AR": -1, "narn_source": null, "verification": "Primary"}'
TWIN = '{"magnitude": "M2.0", "id": 8, "NOAA_AR": 2, "narn_source": "XRT", "verification": "Secondary"}'
SMALL = '{"magnitude": "M1.0", "id": 9, "NOAA_AR": 2, "narn_source": "XRT", "verification": "Non-verified"}'


@pytest.mark.parametrize("text, plain, full, compat", [
    ("None", "None", "None", "None"), (LOW, None, None, None), (f"{BIG};{TWIN};{SMALL}", "M2.0@7", "M2.0@7:Primary", "M2.0@7:Non-verified"),
    (f"{SMALL};{BIG}", "M2.0@7", "M2.0@7:Primary", "M2.0@7:Primary"),
])
def test_parse_label(spark, text, plain, full, compat):
    t = F.lit(text)
    assert one(spark, C.parse_label_max(t), C.parse_label_max(t, True), C.parse_label_max(t, True, True)) == (plain, full, compat)


def test_label_text_round_trip(spark):
    label = C.build_label(F.lit("M2.0"), F.lit(7), F.lit(-1), F.lit(None).cast("string"), F.lit("Primary"))
    assert one(spark, label)[0] == BIG


def test_midnight_rollover(spark):
    ts = [F.lit(v).cast("timestamp_ntz") for v in ("2010-01-01 23:50:00", "2010-01-01 00:05:00", "2010-01-01 00:20:00")]
    assert one(spark, *T.fix_midnight_rollover(*ts)) == (datetime(2010, 1, 2, 0, 5), datetime(2010, 1, 2, 0, 20))


def test_micros_ignore_session_zone(spark):
    text = ("2010-03-14 02:30:00.123456", "1969-12-31 23:59:59.999999")
    got = []
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        got.append(one(spark, *[T.micros(F.lit(v).cast("timestamp_ntz")) for v in text]))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got[0] == got[1] == (1268533800123456, -1)


def test_parse_time_ignores_session_zone(spark):
    from datetime import datetime as d

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    got = one(spark, *[T.parse_time(F.lit(v), "yyyyMMdd_HHmmss") for v in ("20100314_023000", "junk", "20101107_013000")])
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == (d(2010, 3, 14, 2, 30), None, d(2010, 11, 7, 1, 30))


def test_missing_distance_is_a_match(spark):
    null = F.lit(None).cast("double")
    assert one(spark, P.minkowski_within(F.lit(0.0), F.lit(0.0), null, F.lit(1.0), 15)) == (True,)
    assert one(spark, P.minkowski_within(F.lit(0.0), F.lit(0.0), F.lit(9.0), F.lit(12.0), 15)) == (False,)


def test_trust_flags_never_null(spark):
    null = F.lit(None).cast("double")
    assert one(spark, *P.trust_flags(null, null)) == (False, False)
    assert one(spark, *P.trust_flags(F.lit(70.0), F.lit(0))) == (False, False)
    assert one(spark, *P.trust_flags(F.lit(69.9), F.lit(0))) == (True, True)
