"""Readers for event lists, series, key maps, region reports and flux files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import KEY_OFFSET, numeric_coerce
from ..functions.places import parse_compass
from ..functions.times import parse_time
from .schemas import HEADER_FIELDS, REGION_FIXED_WIDTH, SERIES_RAW, text_schema
from .versions import current_version

TIME_COLUMNS = ("start_time", "peak_time", "end_time")
DEFAULT_TIME = "yyyyMMdd_HHmmss"
DASHED_TIME = "yyyy-MM-dd HH:mm:ss"
ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss"


FILE_NUMBER = r"(\d+)\.\w+$"
REPORT_DAY = r"(\d{8})SRS\.txt$"


def _file_key(pattern: str) -> Column:
    """Part of the file path, e.g. a series number or a day."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


def read_events(
    spark: SparkSession, path: str, columns: list[str], sep: str = ",", time_format: str = DEFAULT_TIME,
    numbers: dict[str, str] | None = None, times: tuple[str, ...] = TIME_COLUMNS,
) -> DataFrame:
    """Event list with a header line; times in one format per feed, unreadable fields NULL."""
    raw = spark.read.csv(path, schema=text_schema(columns), header=True, sep=sep, nullValue="NaN", enforceSchema=False)
    casts = {t: parse_time(F.col(t), time_format) for t in times}
    casts |= {c: numeric_coerce(F.col(c), to) for c, to in (numbers or {}).items()}
    return raw.withColumns(casts)


XRT_COLUMNS = ["id", "start", "peak", "end", "loc1", "class", "region", "X", "Y"]


def read_hinode_events(spark: SparkSession, path: str, columns: list[str] = XRT_COLUMNS, after: str | None = None) -> DataFrame:
    """Second telescope's list: trimmed class, compass location, renamed coordinates."""
    raw = spark.read.csv(path, schema=text_schema(columns), header=True, enforceSchema=False)
    lon, lat = parse_compass(F.col("loc1"))
    out = raw.select(
        "id", *[parse_time(F.col(c), "yyyy/MM/dd HH:mm").alias(f"{c}_time") for c in ("start", "peak", "end")],
        F.trim("class").alias("goes_class"), numeric_coerce(F.col("region")).alias("noaa_active_region"),
        F.concat(F.lit("POINT("), lon.cast("int").cast("string"), F.lit(" "), lat.cast("int").cast("string"), F.lit(")")).alias("ar_location"),
        lat.alias("fl_lat"), lon.alias("fl_lon"),
        numeric_coerce(F.col("X")).alias("x_hpc"), numeric_coerce(F.col("Y")).alias("y_hpc"),
    )
    return out if after is None else out.where(F.col("start_time") > F.lit(after).cast("timestamp_ntz"))


def read_series(
    spark: SparkSession, folder: str, schema=SERIES_RAW, time_format: str = DEFAULT_TIME, key: str = "harpnum", files: str = "*.csv",
    key_pattern: str = FILE_NUMBER,
) -> DataFrame:
    """All series of a folder in one scan; the key comes from the file path, the time column is ``ts``."""
    raw = spark.read.csv(f"{folder}/{files}", schema=schema, header=True, sep="\t", nullValue="NaN", enforceSchema=False)
    named = raw.withColumn(key, _file_key(key_pattern).try_cast("int"))
    return named.withColumn("ts", parse_time(F.col("Timestamp"), time_format)).drop("Timestamp")


def read_series_header(
    spark: SparkSession, folder: str, key: str = "harpnum", fields: list[str] = HEADER_FIELDS, files: str = "*.txt",
    key_pattern: str = FILE_NUMBER,
) -> DataFrame:
    """Header tables of a folder; times cut to the minute, listed columns kept as numbers."""
    raw = spark.read.csv(f"{folder}/{files}", schema=text_schema(fields), header=True, sep="\t", nullValue="NaN", enforceSchema=False)
    minute = F.substring(F.regexp_replace(fields[0], "[T_]", " "), 1, 16)
    return raw.select(
        _file_key(key_pattern).try_cast("int").alias(key), parse_time(minute, "yyyy-MM-dd HH:mm").alias("ts"),
        *[numeric_coerce(F.col(c)).alias(c) for c in fields[1:]],
    )


def read_key_map(spark: SparkSession, path: str, key: str = "harpnum") -> DataFrame:
    """Series number and the array of its region numbers."""
    raw = spark.read.csv(path, schema=text_schema(["HARPNUM", "NOAA_ARS"]), header=True, sep=" ")
    numbers = F.array_compact(F.transform(F.split("NOAA_ARS", ","), lambda t: t.try_cast("int")))
    return raw.select(F.col("HARPNUM").try_cast("int").alias(key), numbers.alias("keys"))


def read_fixed_width_regions(spark: SparkSession, path: str) -> DataFrame:
    """Yearly region records: fifteen fields by character position."""
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    return lines.select(*[F.trim(F.substring("value", at, size)).try_cast(to).alias(name) for name, at, size, to in REGION_FIXED_WIDTH])


def _report_lines(spark: SparkSession, folder: str, files: str, day_pattern: str) -> DataFrame:
    """Lines of daily reports with their day; one report is one small file."""
    raw = spark.read.text(f"{folder}/{files}", wholetext=True)
    day = F.to_date(_file_key(day_pattern), "yyyyMMdd")
    return raw.select(day.alias("date"), F.split("value", r"\r?\n").alias("lines"))


# fixed values: section titles of the daily report
SPOTS, PLAGES, RETURN = "I.  Regions with Sunspots.", "IA. H-alpha Plages without Spots.", "II. Regions Due to Return"


def read_sectioned_report(
    spark: SparkSession, folder: str, preamble: int = 9, files: str = "*SRS.txt", day_pattern: str = REPORT_DAY
) -> DataFrame:
    """Daily region reports: spot and plage sections up to section II, numbers plus 10000.

    Sections are cut while a report is still one row, so a line takes nothing but itself, its day and its section along.
    """
    reports = _report_lines(spark, folder, files, day_pattern)
    plage_at = F.array_position(F.transform("lines", lambda l: F.startswith(l, F.lit(PLAGES))), True).cast("int")
    stop_at = F.array_position(F.transform("lines", lambda l: F.startswith(l, F.lit(RETURN))), True).cast("int")
    last = F.when(F.col("s") > 0, F.col("s") - 1).otherwise(F.size("lines"))

    def section(after: Column, to: Column, is_plage: bool) -> Column:
        lines = F.slice("lines", after + 1, F.greatest(to - after, F.lit(0)))
        return F.transform(F.filter(lines, lambda l: F.rlike(l, F.lit(r"^\s*\d+\s"))), lambda l: F.struct(l.alias("line"), F.lit(is_plage).alias("plage")))

    spots = section(F.lit(preamble), F.when(F.col("p") > 0, F.least("p", last)).otherwise(last), False)
    plages = section(F.greatest("p", F.lit(preamble)), F.when(F.col("p") > 0, last).otherwise(0), True)
    cut = reports.withColumns({"p": plage_at, "s": stop_at}).select("date", F.explode(F.concat(spots, plages)).alias("row"))
    body = cut.select("date", "row.*")
    w = F.split(F.trim("line"), r"\s+")
    plage = F.col("plage")
    lon, lat = parse_compass(F.get(w, F.lit(1)))

    def spot_field(index: int, to: str | None = None) -> Column:
        value = F.get(w, F.lit(index))
        return F.when(~plage, value.try_cast(to) if to else value)

    return body.select(
        F.year("date").alias("year"), F.month("date").alias("month"), F.day("date").alias("day"),
        (F.get(w, F.lit(0)).try_cast("int") + KEY_OFFSET).alias("noaa_ar_no"),
        lon.cast("int").alias("central_meridian_dist"), lat.cast("int").alias("latitude"),
        F.get(w, F.lit(2)).try_cast("int").alias("carrington_longitude"),
        spot_field(3, "int").alias("corr_whole_spot_area"), F.coalesce(spot_field(4), F.lit("None")).alias("mcintosh"),
        spot_field(5, "int").alias("LL"), spot_field(6, "int").alias("number_of_spots"),
        F.when(plage, "Plage").otherwise(F.get(w, F.lit(7))).alias("greenwich"),
    )


# fixed values: fields of a sunspot line in their order
REGION_ROW_FIELDS = ("region_number", "location", "longitude", "area", "z_class", "ll", "num_spots")


def read_region_rows(spark: SparkSession, folder: str, files: str = "*SRS.txt", day_pattern: str = REPORT_DAY) -> DataFrame:
    """The sunspot section of daily reports by pattern, fields as text."""
    reports = _report_lines(spark, folder, files, day_pattern)
    is_start = F.transform("lines", lambda l: F.contains(F.lower(l), F.lit("regions with sunspots")))
    begin = F.array_position(is_start, True)
    tail = F.slice("lines", begin + 2, F.size("lines"))
    stop = F.transform(tail, lambda l: (F.trim(l) == "") | F.contains(F.lower(l), F.lit("h-alpha plages without spots")))
    cut = F.array_position(stop, True)
    kept = F.when(cut > 0, F.slice(tail, 1, cut - 1)).otherwise(tail)
    rows = reports.where(begin > 0).select("date", F.explode(kept).alias("line")).select("date", F.trim("line").alias("line"))
    fields = F.split("line", r"\s+")
    value = {name: F.get(fields, F.lit(i)) for i, name in enumerate(REGION_ROW_FIELDS)}
    whole = F.lit(True)
    for name, text in value.items():
        whole = whole & F.coalesce(F.rlike(text, F.lit(r"^\w+$" if name in ("location", "z_class") else r"^\d+")), F.lit(False))
    return rows.where(whole).select(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        *[F.regexp_extract(text, r"^\w+" if name in ("location", "z_class") else r"^\d+", 0).alias(name) for name, text in value.items()],
    )


def _marked(spark: SparkSession, folder: str, marker: str) -> DataFrame:
    raw = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.split("value", r"\r?\n").alias("lines"))
    return raw.withColumn("at", F.array_position(F.transform("lines", lambda l: F.trim(l)), marker))


def _header(lines: Column, at: Column) -> Column:
    return F.transform(F.split(F.get(lines, at.cast("int")), ","), lambda name: F.lower(F.trim(name)))


def read_flux_after_marker(
    spark: SparkSession, folder: str, columns: list[str], marker: str = "data:", time_format: str = "yyyy-MM-dd HH:mm:ss.SSS",
) -> DataFrame:
    """CSV tables that start after a marker line and a header line; one file is one day or month.

    ``columns`` names the time column first. Columns are found by the file's own header, in any order and letter case; one that a file
    lacks is NULL. Files without the marker or the time column are left to ``flux_file_rejects``.
    """
    marked = _marked(spark, folder, marker).where(F.col("at") > 0).withColumn("names", _header(F.col("lines"), F.col("at")))
    rows = marked.where(F.array_contains("names", columns[0].lower())).select("names", F.explode(F.slice("lines", F.col("at") + 2, F.size("lines"))).alias("line"))
    fields = rows.where(F.length("line") > 0).select("names", F.split("line", ",").alias("f"))

    def value(name: str) -> Column:
        place = F.array_position("names", name.lower()).cast("int")
        return F.when(place > 0, F.get("f", place - 1))

    return fields.select(parse_time(F.trim(value(columns[0])), time_format).alias("ts"), *[numeric_coerce(value(c)).alias(c) for c in columns[1:]])


def flux_file_rejects(spark: SparkSession, folder: str, columns: list[str], marker: str = "data:") -> DataFrame:
    """Files that ``read_flux_after_marker`` cannot read, with the reason."""
    marked = _marked(spark, folder, marker)
    named = F.array_contains(_header(F.col("lines"), F.col("at")), columns[0].lower())
    reason = F.when(F.col("at") == 0, "no marker").when(~F.coalesce(named, F.lit(False)), "no time column")
    return marked.select("file", reason.alias("reason")).where(F.col("reason").isNotNull())


def read_flux_series(spark: SparkSession, path: str, fmt: str = "spaced") -> DataFrame:
    """Two-column flux: ``spaced`` (double space, day-month-year) or ``csv`` (no header, first row skipped)."""
    if fmt == "spaced":
        parts = F.split(F.trim("value"), "  ")
        rows = spark.read.text(path).where(F.length(F.trim("value")) > 0)
        return rows.select(
            parse_time(F.get(parts, F.lit(0)), "dd-MMM-yyyy HH:mm:ss").alias("ts"), numeric_coerce(F.get(parts, F.lit(1))).alias("b_avg")
        )
    raw = spark.read.csv(path, schema=text_schema(["Timestamp", "B_AVG"]), header=True, enforceSchema=True)
    return raw.select(parse_time(F.col("Timestamp"), DASHED_TIME).alias("ts"), numeric_coerce(F.col("B_AVG")).alias("b_avg"))


def read_dataset(spark: SparkSession, path: str, split: str | None = None, label: str | None = None) -> DataFrame:
    """The current version of a written dataset, or one of its roles by partition pruning."""
    rows = spark.read.parquet(f"{current_version(spark, path)}/rows")
    if split is not None:
        rows = rows.where(F.col("split") == split)
    return rows if label is None else rows.where(F.col("role") == label)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Role and item of every row of the current version of a dataset."""
    return spark.read.parquet(f"{current_version(spark, path)}/manifest")


def read_match_report(spark: SparkSession, path: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Named tables of the current version of the match reports."""
    folder = current_version(spark, path)
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}
