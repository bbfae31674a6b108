"""Decode, checks, cleaning, features and risk on small hand-written tables."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kerbstone import constants as C
from kerbstone.functions.scalars import (
    hour_of, label_of, number_or_null, recall_oriented, risk_band, round_even_places,
)
from kerbstone.operators import checks, clean, decode, features, hotspots, profile, risk
from kerbstone.sources import raw

SCHEMA = raw.PREPARED_SCHEMA


def record(i, day, hour, road, weather, surface, speed, vehicles, severity, light="Daylight"):
    return (
        str(i), dt.date.fromisoformat(day), hour, "Leeds", 53.8, -1.5, road, "Crossroads",
        weather, light, surface, speed, vehicles, severity,
    )


@pytest.fixture(scope="module")
def three(spark):
    rows = [
        record(1, "2023-01-02", 8.0, "Roundabout", "Fine no high winds", "Dry", 40.0, 1.0, "Minor"),
        record(2, "2023-06-17", 23.0, "Slip road", None, "Wet or damp", None, 2.0, "Fatal",
               "Darkness - no lighting"),
        record(3, "2023-11-05", 14.0, None, "Fog or mist", None, 60.0, 1.0, "Serious"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_validate_passes_and_rejects(three):
    checks.validate(three)
    with pytest.raises(checks.DataValidationError, match="severity"):
        checks.validate(three.drop("severity"))
    with pytest.raises(checks.DataValidationError, match="Catastrophic"):
        checks.validate(three.withColumn("severity", F.lit("Catastrophic")))
    with pytest.raises(checks.DataValidationError, match="3 rows"):
        checks.validate(three.withColumn("latitude", F.lit(200.0)))
    with pytest.raises(checks.DataValidationError, match="3 rows"):
        checks.validate(three.withColumn("longitude", F.lit(None).cast("double")))
    with pytest.raises(checks.DataValidationError, match="no rows"):
        checks.validate(three.where("false"))
    checks.validate(three.withColumn("severity", F.lit(None).cast("string")))


def test_class_weight_and_date_checks(three):
    checks.require_all_classes(three)
    with pytest.raises(checks.DataValidationError, match="Fatal"):
        checks.require_all_classes(three.where("severity <> 'Fatal'"))
    checks.require_weights(three)
    with pytest.raises(checks.DataValidationError):
        checks.require_weights(three.withColumn("severity", F.lit("x")))
    with pytest.raises(checks.DataValidationError):
        checks.require_dates(three.withColumn("date", F.lit(None).cast("date")))


def test_fill_with_unknown_and_median(three):
    rows = {r["accident_id"]: r for r in clean.clean(three).collect()}
    assert rows["3"]["road_type"] == rows["2"]["weather"] == rows["3"]["road_surface"] == "Unknown"
    assert rows["2"]["speed_limit"] == 50  # median of 40 and 60
    assert all(v is not None for r in rows.values() for v in r)


def test_nothing_to_take_a_median_of(three):
    with pytest.raises(Exception, match="hour has no number"):
        clean.clean(three.withColumn("hour", F.lit(None).cast("double"))).collect()


def test_bad_date_fails(three):
    with pytest.raises(Exception, match="no readable date"):
        clean.clean(three.withColumn("date", F.lit("soon"))).collect()


def test_rounding_and_truncation(spark, three):
    df = three.withColumns(
        {"speed_limit": F.lit(42.5), "hour": F.lit(7.9), "num_vehicles_involved": F.lit(2.7)}
    )
    r = clean.clean(df).first()
    assert (r["speed_limit"], r["hour"], r["num_vehicles_involved"]) == (42, 7, 2)


def test_dedup_keeps_the_least_row_with_nulls_last(spark, three):
    again = three.where("accident_id = '3'").withColumn("road_type", F.lit("Slip road"))
    no_id = three.limit(2).withColumn("accident_id", F.lit(None).cast("string"))
    out = clean.remove_duplicates(three.union(three).union(again).union(no_id))
    assert out.count() == 4  # three ids, and those without one as a group
    assert out.where("accident_id = '3'").first()["road_type"] == "Slip road"


def test_derived_features(three):
    rows = {r["accident_id"]: r for r in features.add_features(clean.clean(three)).collect()}
    assert rows["1"]["day_of_week"] == "Monday" and rows["2"]["day_of_week"] == "Saturday"
    assert [rows[i]["is_weekend"] for i in "123"] == [0, 1, 1]
    assert [rows[i]["is_rush_hour"] for i in "123"] == [1, 0, 0]
    assert [rows[i]["is_night"] for i in "123"] == [0, 1, 0]
    assert rows["2"]["hour_bucket"] == "Late Night (22-23)"
    assert rows["3"]["weather_severity_index"] > rows["1"]["weather_severity_index"] == 0


@pytest.mark.parametrize("hour,bucket", [
    (0, "Night (00-05)"), (5, "Night (00-05)"), (6, "Morning (06-11)"), (11, "Morning (06-11)"),
    (12, "Afternoon (12-16)"), (16, "Afternoon (12-16)"), (17, "Evening (17-21)"),
    (21, "Evening (17-21)"), (22, "Late Night (22-23)"), (23, "Late Night (22-23)"),
    (24, "Unknown"), (-1, "Unknown"),
])
def test_hour_bucket_edges(three, hour, bucket):
    df = clean.clean(three).withColumn("hour", F.lit(hour))
    assert features.add_features(df).first()["hour_bucket"] == bucket


def test_numbers_and_hours_as_a_text_parser_reads_them(spark):
    texts = ["1", " 1.5 ", "-2e3", "1d", "0x10", "nan", "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(number_or_null(df, "t")).collect()] == [
        1.0, 1.5, -2000.0, None, None, None, None, None, None]
    times = ["7:05", "07:05", "23:59", "24:00", "99:99", "7", "007:05", None, "12:60"]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    assert [r[0] for r in df.select(hour_of("t")).collect()] == [
        7, 7, 23, None, None, None, None, None, None]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-5, 120).map(str), st.text(max_size=4), st.none()), min_size=1))
def test_decode_is_total(spark, codes):
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    for labels in (C.ROAD_TYPE_CODES, C.JUNCTION_CODES, C.WEATHER_CODES, C.LIGHT_CODES, C.SURFACE_CODES):
        got = [r[0] for r in df.select(label_of(number_or_null(df, "c"), labels, "Unknown")).collect()]
        for code, label in zip(codes, got):
            assert label in set(labels.values())
            if code is not None and code.lstrip("-").isascii() and code.lstrip("-").isdigit():
                assert label == labels.get(int(code), "Unknown")


def test_codes_compare_as_numbers(spark):
    df = spark.createDataFrame([("1",), ("1.0",), (" 1 ",), ("12",)], "c string")
    got = [r[0] for r in df.select(label_of(number_or_null(df, "c"), C.ROAD_TYPE_CODES, "Unknown")).collect()]
    assert got == ["Roundabout"] * 3 + ["One way street / Slip road"]


def test_raw_files_to_prepared(spark, tmp_path):
    head = ",".join(raw.RAW_COLUMNS + ["extra"])
    lines = [
        "0012,1/2/2023,08:15,1,6,0,1,1,1, E01 ,53.1,-1.5,30,2,z",
        "0013,31/02/2023,99:99,3,12,42,NA,4,9,E02,53.1,-1.5,99,x,z",
        "0014,05/06/2023,12:00,,6,0,1,1,1,E01,53.1,-1.5,30,2,z",
        "0015,05/06/2023,12:00,2,6,0,1,1,1,E01,999,-1.5,30,2,z",
    ]
    (tmp_path / "raw.csv").write_text("\n".join([head, *lines]) + "\n")
    (tmp_path / "codes.csv").write_text(
        "field name,code/format,label\nlocal_authority_ons_district,E01,Old\n"
        "road_type,E01,None of it\nlocal_authority_ons_district, E01 , New \n"
    )
    got = decode.prepare(
        raw.read_raw_csv(spark, str(tmp_path / "raw.csv")),
        raw.read_code_list(spark, str(tmp_path / "codes.csv")),
    )
    assert got.columns == C.RECORD_COLUMNS
    rows = {r["accident_id"]: r for r in got.collect()}
    assert set(rows) == {"0012", "0013"}
    assert rows["0012"]["city"] == "New" and rows["0013"]["city"] == "Unknown"
    assert rows["0012"]["date"] == dt.date(2023, 2, 1) and rows["0013"]["date"] is None
    assert rows["0012"]["hour"] == 8 and rows["0013"]["hour"] is None
    assert rows["0013"]["speed_limit"] is None and rows["0013"]["num_vehicles_involved"] is None
    assert rows["0013"]["weather"] == "Unknown"
    got.where("date is not null").write.csv(str(tmp_path / "prepared"), header=True)
    back = raw.read_prepared_csv(spark, str(tmp_path / "prepared"))
    assert [tuple(r) for r in back.select(*C.RECORD_COLUMNS).collect()] == [
        tuple(r) for r in got.where("date is not null").collect()]


def test_numpy_rounding(spark):
    df = spark.createDataFrame([(24.285,), (0.125,), (1.005,)], "x double")
    assert [r[0] for r in df.select(round_even_places(F.col("x"), 2)).collect()] == [24.28, 0.12, 1.0]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-50, 200, allow_nan=False), min_size=1, max_size=20))
def test_band_edges(spark, scores):
    df = spark.createDataFrame([(float(s),) for s in scores], "s double")
    for r in df.select("s", risk_band(F.col("s")).alias("b")).collect():
        expected = next((n for n, lo, hi in C.RISK_BANDS if lo <= r["s"] < hi), "Critical")
        assert r["b"] == expected


def test_threshold_table(spark):
    df = spark.createDataFrame(
        [([0.9, 0.09, 0.01],), ([0.5, 0.35, 0.15],), ([0.2, 0.3, 0.5],), ([0.45, 0.45, 0.1],)],
        "p array<double>",
    )
    assert [r[0] for r in df.select(recall_oriented(F.col("p"), 0.15)).collect()] == [0, 2, 2, 0]


def test_risk_lookup_is_smoothed_and_skips_null_keys(spark, three):
    featured = features.add_features(clean.clean(three))
    broken = featured.withColumn(
        "road_type", F.when(F.col("accident_id") == "1", None).otherwise(F.col("road_type"))
    )
    rows = risk.risk_lookup(broken).collect()
    assert len(rows) == 2 and all(0 <= r["risk_score"] <= 100 for r in rows)
    mean = (1 + 6 + 3) / 3
    fatal = next(r for r in rows if r["fatal_count"])
    assert fatal["smoothed_avg_weight"] == pytest.approx((6 + 8 * mean) / 9)
    assert {r["risk_level"] for r in rows} <= {"Low", "Medium", "High", "Critical"}


def test_hotspots_rank_ties_modes_and_empty(spark):
    rows = [(str(i), c, s, d, 1.0 * i, 2.0) for i, (c, s, d) in enumerate([
        (0, "Minor", "b"), (0, "Minor", "a"), (1, "Minor", None), (1, "Minor", None),
        (2, "Fatal", "z"), (2, "Minor", "z"), (-1, "Fatal", "q"), (-2, "Fatal", "q")])]
    df = spark.createDataFrame(
        rows, "accident_id string, cluster int, severity string, city string, latitude double, longitude double")
    got = hotspots.rank_hotspots(df, 3).orderBy("rank").collect()
    assert [(r["rank"], r["cluster"], r["dominant_district"], r["severity_weighted_score"]) for r in got] == [
        (1, 2, "z", 7), (2, 0, "a", 2), (3, 1, "Unknown", 2)]
    empty = hotspots.rank_hotspots(df.where("cluster < 0"))
    assert empty.count() == 0 and len(empty.columns) == 9
    with pytest.raises(Exception, match="no risk weight"):
        hotspots.rank_hotspots(df.withColumn("severity", F.lit("?"))).collect()


def test_district_column(spark):
    assert profile.district_column(["x", " City "]) == " City "
    assert profile.district_column(["District", "LOCAL_AUTHORITY_DISTRICT"]) == "District"
    assert profile.district_column(["x"]) is None
    df = spark.createDataFrame([(" b ",), ("NaN",), ("a",), ("",), (None,), ("UNKNOWN",)], "City string")
    assert [r[0] for r in profile.districts(df).collect()] == ["a", "b"]


def test_one_pass_of_tallies_and_the_quarantine(spark, small):
    from kerbstone.operators import checks
    from kerbstone.queries import prepared

    rows = prepared(spark, small)
    good = checks.tallies(rows).first()
    assert good["n_rows"] == rows.count()
    for s in ("Minor", "Serious", "Fatal"):
        assert good[f"n_{s.lower()}"] == rows.where(f"severity = '{s}'").count()
    n = rows.count()
    bad = rows.limit(5).withColumn("severity", F.lit("Odd")).union(
        rows.limit(3).withColumn("latitude", F.lit(200.0)).withColumn("date", F.lit(None).cast("date")))
    both = rows.union(bad)
    counts = checks.tallies(both).first()
    assert (counts["n_rows"], counts["n_labels_bad"], counts["bad_label"]) == (n + 8, 5, "Odd")
    assert counts["n_coordinates_bad"] == good["n_coordinates_bad"] + 3
    assert counts["n_dates_bad"] >= 3
    reasons = [tuple(r["reasons"]) for r in checks.quarantined(bad).collect()]
    assert sum("label" in r for r in reasons) == 5 and reasons.count(("coordinates", "date")) == 3
    with pytest.raises(checks.DataValidationError, match="Odd"):
        checks.require_tallies(counts)
    with pytest.raises(checks.DataValidationError, match="no record is Fatal"):
        checks.require_tallies(checks.tallies(rows.where("severity <> 'Fatal'")).first(), dates=False)
