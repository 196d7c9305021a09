"""The three program chains end to end on files with the original layouts."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventloom.operators.labels import WindowConfig
from eventloom.plans.annotate import annotate_series
from eventloom.plans.dataset import build_dataset, labelled_slices
from eventloom.plans.integrate import assemble_match_table, clean_scraped_events, prepare_primary, prepare_secondary
from eventloom.sources import readers as RD
from eventloom.sources import schemas as SC
from eventloom.sources import writers as WR

T0 = datetime(2012, 5, 1)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Two series of 240 rows with a gap, their headers, a key map and one-minute flux."""
    base = tmp_path_factory.mktemp("files")
    for sub in ("series", "header"):
        (base / sub).mkdir()
    fields = [*SC.FIELD_PARAMETERS, "CRVAL1", "CRLN_OBS"]
    for key in (1, 2):
        rows, heads = ["\t".join(["Timestamp", *fields])], ["\t".join(SC.HEADER_FIELDS)]
        for i in range(240):
            if key == 2 and i in (50, 51):
                continue
            values = [f"{i}.5"] * 24 + [f"{100 + 20 * (key - 1)}.0", "100.0"]
            if i == 3:
                values[0] = "NaN"
            rows.append("\t".join([at(12 * i).strftime("%Y%m%d_%H%M%S"), *values]))
            heads.append("\t".join([at(12 * i).strftime("%Y-%m-%dT%H:%M:34.5"), "-10", "10", "-20", "20", "0", *["1.0"] * 6, "0.0", "5.0"]))
        (base / "series" / f"{key}.csv").write_text("\n".join(rows) + "\n")
        (base / "header" / f"{key}.txt").write_text("\n".join(heads) + "\n")
    (base / "map.txt").write_text("HARPNUM NOAA_ARS\n1 11067\n2 11064,11070\n")
    (base / "flux.txt").write_text("".join(f"{at(m):%d-%b-%Y %H:%M:%S}  {1e-6 if m % 50 else -99999}\n" for m in range(-6, 12 * 240)))
    return base


@pytest.fixture(scope="module")
def catalogue(spark):
    rows = [
        (1, "C1.0", 30, 40, 60, 11067, None, None, 5.0, 0.0, True, False),
        (2, "M2.0", 1500, 1512, 1530, None, 11070, None, 80.0, 80.0, False, True),
        (3, "X1.0", 1600, 1605, 1630, 11000, None, 11067, 0.0, 0.0, True, True),
        (4, "B5.0", 40, 41, 42, None, None, 11067, None, None, False, False),
        (5, "M9.0", 2860, 2868, 2870, 11064, None, None, 0.0, 0.0, True, True),
    ]
    rows = [(i, c, at(a), at(b), at(e), *rest) for i, c, a, b, e, *rest in rows]
    return spark.createDataFrame(rows, "id long, goes_class string, start_time timestamp_ntz, peak_time timestamp_ntz, end_time timestamp_ntz, noaa_active_region long, "
                                       "hinode_ar long, ssw_ar long, fl_lon double, fl_lat double, primary_verified boolean, secondary_verified boolean")


@pytest.fixture(scope="module")
def annotated(spark, folder, catalogue):
    series = RD.read_series(spark, f"{folder}/series")
    header = RD.read_series_header(spark, f"{folder}/header")
    keys = RD.read_key_map(spark, f"{folder}/map.txt")
    flux = RD.read_flux_series(spark, f"{folder}/flux.txt")
    return annotate_series(series, header, catalogue, keys, flux, aligned=True).cache()


def test_annotation(annotated):
    assert annotated.columns == ["harpnum", "ts", *SC.FINAL_COLUMNS]
    rows = {(r.harpnum, r.ts): r for r in annotated.collect()}
    assert len(rows) == 480
    gap = rows[(2, at(600))]
    assert gap.TOTUSJH is None and gap.IS_TMFI is False and gap.LAT_MIN is None
    first = rows[(1, at(36))]
    assert first.TOTUSJH is None and first.IS_TMFI is True and round(first.HC_ANGLE, 6) == 5.0
    slot = rows[(1, at(36))]
    assert (slot.CFLARE, slot.BFLARE) == (1, 1) and '"narn_source": "GOES", "verification": "Primary"' in slot.CFLARE_LABEL and '"SSW"' in slot.BFLARE_LABEL
    assert slot.CFLARE_LOC == 1 and rows[(2, at(36))].CFLARE_LOC == 1 and rows[(2, at(36))].CFLARE == 0 and '"NOAA_AR": -1' in rows[(2, at(36))].CFLARE_LABEL_LOC
    assert rows[(2, at(1512))].MFLARE == 1 and rows[(2, at(1512))].MFLARE_LOC == 0 and rows[(1, at(1512))].MFLARE_LABEL == "None"
    assert sum(r.XFLARE for r in rows.values()) == 0 and rows[(1, at(1596))].XFLARE_LOC == 1
    assert sum(r.MFLARE for r in rows.values()) == 1, "a peak in the last slot is never counted"
    assert slot.XR_QUAL == 12 and rows[(1, at(48))].XR_QUAL == 11 and slot.XR_MAX == 1e-6


def test_both_alignments_agree(spark, folder, catalogue, annotated):
    parts = (RD.read_series(spark, f"{folder}/series"), RD.read_series_header(spark, f"{folder}/header"), catalogue, RD.read_key_map(spark, f"{folder}/map.txt"), RD.read_flux_series(spark, f"{folder}/flux.txt"))
    general = annotate_series(*parts, aligned=False)
    assert general.exceptAll(annotated).count() == 0 and annotated.exceptAll(general).count() == 0


def test_dataset(spark, annotated, tmp_path):
    unmatched = spark.createDataFrame([(at(2000), "M1.0"), (at(300), "C9.0")], "peak_time timestamp_ntz, goes_class string")
    slices = labelled_slices(annotated, unmatched, cfg=WindowConfig(obs=10, lat=0, pred=20, step=5))
    rows = slices.collect()
    assert len(rows) == 2 * 46
    assert any(r.outcome == "FL" and r.label == "M2.0@2:Secondary" for r in rows) and any(r.reason == "NONMATCHED_FL_Filter" for r in rows)
    built = build_dataset(annotated, unmatched, k=2, cfg=WindowConfig(obs=10, lat=0, pred=20, step=5), keep_share=0.5)
    built = built.withColumn("item", F.concat_ws("_", "harpnum", "slice_pos")).cache()
    assert {r.outcome for r in built.select("outcome").distinct().collect()} == {"FL", "NF"}
    WR.write_dataset(built, str(tmp_path / "out"), "item", split="partition", label="outcome")
    part = built.first()["partition"]
    back = RD.read_dataset(spark, str(tmp_path / "out"), part, "FL")
    assert back.count() == built.where((F.col("partition") == part) & (F.col("outcome") == "FL")).count()


def test_scraped_list_to_integrated_catalogue(spark):
    scraped = spark.createDataFrame(
        [("g1", "2012/05/01 23:50:00", "00:05:00", "00:20:00", "M1.0", "N16W54", " ( 1467 ) ", "1"), ("g2", "2012/05/02 10:00:00", "10:05:00", "10:20:00", "C1.0", "N**W54", " (  ) ", "2")],
        ["EName", "Start", "Peak", "Stop", "GOES Class", "Derived Position", "NOAA_AR", "Event#"],
    )
    clean = clean_scraped_events(scraped).withColumnsRenamed({"EName": "id", "goes_location": "ssw_location"})
    rows = {r.id: r for r in clean.collect()}
    assert rows["g1"].end_time == datetime(2012, 5, 2, 0, 20) and rows["g1"].noaa_active_region == 1467 and rows["g1"].ssw_location == "POINT(54 16)"
    second = prepare_secondary(clean)
    regions = spark.createDataFrame([(11467, datetime(2012, 5, 2), "N16W55")], "region_number long, date timestamp_ntz, location string")
    primary = spark.createDataFrame([(1, at(1429), at(1446), at(1460), "M1.0", "(0, 0)", 11467)], "id long, start_time timestamp_ntz, peak_time timestamp_ntz, end_time timestamp_ntz, goes_class string, goes_location string, noaa_active_region long")
    primary = prepare_primary(primary, regions)
    third = second.withColumns({"x_hpc": F.col("x_hpc") + 5, "id": F.concat(F.lit("h"), "id")})
    row = assemble_match_table(primary, second, third).first()
    assert row.ssw_flare_id == "g1" and row.hinode_flare_id == "hg1" and row.primary_verified and row.secondary_verified
    assert row.fl_loc_src == "GOES" and row.candidate_ars == [11467, 11467, 11467] and round(row.ssw_hinode_dist, 6) == 5.0
    assert abs(row.fl_lon + 55) > 100  # west is positive: the centre lies near +55
