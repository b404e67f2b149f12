"""Scalar functions against plain Python, and the traps of dates, numbers and nulls."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from fairgrid.functions import dates, geo, numbers, text


def values(spark, column, rows, kind):
    return [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], f"i int, v {kind}").select("i", column.alias("c")).orderBy("i").select("c").collect()]


def test_mixed_dates(spark):
    given = ["26년06월11일", "2026년06월11일", "2026/06/11", "20260611", "97년1월1일", "2026.6.1", "", None, "2026-02-30", "x", "26년6월"]
    d = dt.date
    assert values(spark, dates.parse_date(F.col("v")), given, "string") == [d(2026, 6, 11)] * 4 + [d(1997, 1, 1), d(2026, 6, 1), None, None, None, None, None]
    assert values(spark, dates.parse_date(F.col("v"), 80), ["60년1월1일"], "string") == [d(2060, 1, 1)]


def test_saturday_weeks(spark):
    given = [dt.date(2026, 11, 27), dt.date(2026, 11, 28), dt.date(2026, 11, 29), None]
    assert values(spark, dates.saturday_week(F.col("v")), given, "date") == [dt.date(2026, 11, 28), dt.date(2026, 11, 28), dt.date(2026, 12, 5), None]


def test_week_labels(spark):
    given = [f"26년06월{w}주" for w in range(1, 6)] + ["26년02월5주", "bad", None]
    assert values(spark, dates.week_label_end(F.col("v")), given, "string") == [dt.date(2026, 6, k) for k in (7, 14, 21, 28, 30)] + [dt.date(2026, 2, 28), None, None]


def test_numbers(spark):
    given = ["1,234.5", '"12"', "-", "", "nan", "None", None, " 7 ", "-3"]
    assert values(spark, numbers.parse_number(F.col("v")), given, "string") == [1234.5, 12.0, None, None, None, None, None, 7.0, -3.0]


def test_policy_shift_bounds(spark):
    got = values(spark, numbers.policy_shift(F.lit(745.89), F.col("v")), [0.0, 1.0, 0.15, None, -0.1], "double")
    assert got[:2] == [0.0, 0.0] and got[3:] == [0.0, 0.0] and got[2] == pytest.approx(745.89 * 0.15 * 1.1)


def test_judgement(spark):
    rows = [(None, 1.0, 0.0, 2.0, None), (3.0, 1.0, 0.0, 2.0, "expensive"), (-1.0, 1.0, 0.0, 2.0, "cheap"), (1.5, 1.0, 0.0, 2.0, "fair"), (1.5, 1.0, None, 2.0, "expensive"), (0.5, 1.0, None, None, "cheap"), (1.0, None, None, None, None)]
    df = spark.createDataFrame(rows, "a double, f double, l double, h double, want string")
    assert all(r.want == r.got for r in df.withColumn("got", numbers.judge(*map(F.col, "aflh"))).collect())


def test_missing_stays_missing_and_rebuild(spark):
    assert values(spark, numbers.clip_low(F.col("v")), [None, -2.0, 3.0], "double") == [None, 0.0, 3.0]
    got = values(spark, numbers.rebuild_level(F.lit(100.0), F.col("v")), [10.0, float("nan"), float("inf"), None], "double")
    assert got[0] == pytest.approx(100 * math.exp(0.1)) and got[1:] == [None, None, None]


def test_rounding_half_up_after_noise(spark):
    assert values(spark, numbers.half_up(F.col("v"), 3), [0.0005, 263589.09749999997, -0.0005, None], "double") == [0.001, 263589.098, -0.001, None]


def test_brands_and_regions(spark):
    given = ["sk 주유소", "GS칼텍스", "현대오일뱅크", "S-Oil", "알뜰", "농협", "자가상표", "", None, "etc"]
    want = ["SK에너지", "GS칼텍스", "HD현대오일뱅크", "S-OIL", "알뜰", "NH-OIL", "자가상표", "기타", "기타", "기타"]
    assert values(spark, text.brand_class(F.col("v")), given, "string") == want
    assert values(spark, text.short_region(F.col("v")), ["강원특별자치도", "강원", None], "string") == ["강원", "강원", None]
    assert values(spark, text.address_variants(F.col("v")), ["a (b) c - 변경 2020"], "string") == [["a (b) c - 변경 2020", "a c - 변경 2020", "a c"]]


def test_metres_and_back(spark):
    pts = [(126.978, 37.5665), (129.0756, 35.1796), (127.5, 38.0)]
    df = spark.createDataFrame(pts, "lon double, lat double")
    e, n = geo.to_metres(F.col("lon"), F.col("lat"))
    lon, lat = geo.to_degrees(F.col("e"), F.col("n"))
    for (x, y), r in zip(pts, df.withColumn("e", e).withColumn("n", n).select("e", "n", lon.alias("x"), lat.alias("y")).collect(), strict=True):
        assert abs(r.x - x) < 1e-8 and abs(r.y - y) < 1e-8
        if (x, y) == (127.5, 38.0):
            assert abs(r.e - 1_000_000) < 1e-3 and abs(r.n - 2_000_000) < 1e-3


def test_haversine(spark):
    got = spark.range(1).select(geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(90.0), F.lit(0.0))).first()[0]
    assert got == pytest.approx(6371.0088 * math.pi / 2)


def test_a_date_is_looked_at_twice_at_most(spark):
    given = ["/97/1/1", "////", " 1997/1/1\n", "123-1-1", "20000229", "19970229", "97 년 1 월 1 일", "1/2020/1/1", "0000-01-01", "1997122"]
    assert values(spark, dates.parse_date(F.col("v")).cast("string"), given, "string") == [None, None, "1997-01-01", "0123-01-01", "2000-02-29", None, "1997-01-01", None, "0000-01-01", None]
    plan = spark.createDataFrame([("a",)], "v string").select(dates.parse_date(F.col("v")).alias("d"))
    told = plan._jdf.queryExecution().analyzed().toString().lower()
    assert "regexp_extract" not in told and "format_string" not in told
