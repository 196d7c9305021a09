"""Daily region reports and the report tables of a matching run."""

from datetime import datetime

import __spark_entry__ as entry
from compare import connect, differences, duck_rows, spark_rows
from pyspark.sql import functions as F

from eventloom.sources import readers as RD


def test_every_report_of_a_day_is_read(spark, tmp_path):
    """Regions of one day fill several reports, all written by one task."""
    rows = spark.range(6000, numPartitions=1).select(
        F.col("id").alias("event_id"), F.lit(datetime(2024, 1, 2)).cast("timestamp_ntz").alias("ts"), F.floor(F.col("id") / 2).alias("user_id"),
        F.when(F.col("id") % 2 == 0, "click").otherwise("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props"),
    )
    rows.write.parquet(str(tmp_path / "events.parquet"))
    con = connect(str(tmp_path))
    con.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    for name in ("read_sectioned_report", "read_region_rows"):
        got = spark_rows(entry.queries()[name](spark, str(tmp_path)))
        assert len(got[1]) > 2000 and differences(got, duck_rows(con, entry.oracle_sql()[name])) is None


def test_a_line_of_a_report_carries_no_other_lines(spark, tmp_path):
    head = "\n".join([f"h{i}" for i in range(8)])
    spots, plages = (["%d N10W20 %d 0120 Dai 08 12 Beta" % (n, n % 90) for n in range(a, a + 3000)] for a in (1, 4001))
    text = "\n".join([head, RD.SPOTS, *spots, "", RD.PLAGES, *plages, RD.RETURN, "9999 N15    110"])
    (tmp_path / "20240102SRS.txt").write_text(text)
    out = RD.read_sectioned_report(spark, str(tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "array_position" not in plan[: plan.index("Generate")]  # sections are found once a report, not once a line
    found = {r.noaa_ar_no: r.greenwich for r in out.collect()}
    assert found == {**{10000 + n: "Beta" for n in range(1, 3001)}, **{10000 + n: "Plage" for n in range(4001, 7001)}}
    (tmp_path / "20240103SRS.txt").write_text("\n".join([head, RD.SPOTS, *spots[:5]]))  # neither plages nor a section II
    (tmp_path / "20240104SRS.txt").write_text("\n".join([head, RD.RETURN, *spots[:5]]))
    assert RD.read_sectioned_report(spark, str(tmp_path)).where("day > 2").groupBy("day", "greenwich").count().collect() == [(3, "Beta", 5)]
