"""Readers, writers and streaming jobs on small files."""

import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairgrid.sources import readers, sinks
from fairgrid.streaming import jobs


def test_encodings(spark, tmp_path):
    for name, encoding in (("a.csv", "utf-8-sig"), ("b.csv", "cp949"), ("c.csv", "utf-8")):
        (tmp_path / name).write_text("번호,지역,기간\nA1,서울,20240102\nB,부산,x\n", encoding=encoding)
        df = readers.read_csv_any(spark, str(tmp_path / name), ["번호", "지역", "기간"], id_column="번호")
        assert df.columns == ["번호", "지역", "기간"] and [r[1] for r in df.collect()] == ["서울", "부산"]
    (tmp_path / "bad.csv").write_text("x,y\n1,2\n")
    with pytest.raises(ValueError, match="expected headers"):
        readers.read_csv_any(spark, str(tmp_path / "bad.csv"), ["번호", "지역"])


def test_daily_and_weekly_sources(spark, tmp_path):
    (tmp_path / "crude.csv").write_text('기간,Dubai,Brent,WTI\n26년06월12일,"1,088.57",-,87\n26년06월11일,88.57,90.38,87.71\nnot a date,1,2,3\n')
    got = [tuple(r) for r in readers.read_dataset(spark, str(tmp_path / "crude.csv"), "crude").collect()]
    assert got == [(dt.date(2026, 6, 11), 88.57, 90.38, 87.71), (dt.date(2026, 6, 12), 1088.57, None, 87.0)]
    (tmp_path / "week.csv").write_text("구분,보통휘발유,자동차용경유\n26년06월2주,1,2\n26년06월2주,3,4\n26년06월5주,5,\n")
    got = sorted(tuple(r) for r in readers.read_refinery_weeks(spark, str(tmp_path / "week.csv")).collect())
    assert got == [(dt.date(2026, 6, 14), 3.0, 4.0), (dt.date(2026, 6, 30), 5.0, None)]


def test_tax_table_and_polygons(spark, tmp_path):
    rows = "".join(f"<tr><td>{a}</td><td>{b}</td><td>414.00</td><td>&nbsp;</td><td>1,2</td><td><b>5</b></td><td>9</td></tr>" for a, b in (("변동일자", "관세"), ("1997년01월01일", "-")))
    (tmp_path / "tax.xls").write_text(f"<html><table>{rows}</table></html>")
    assert [tuple(r) for r in readers.read_tax(spark, str(tmp_path / "tax.xls")).collect()] == [(dt.date(1997, 1, 1), None, 414.0, None, 12.0, 5.0)]
    ring = [[0, 0], [1, 0], [1, 1]]
    features = [{"properties": {"name": "강원도"}, "geometry": {"type": "Polygon", "coordinates": [ring]}}, {"properties": {"name": "x"}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring, ring]]}}]
    (tmp_path / "g.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    assert [(r.name, r.ordinal, len(r.rings)) for r in readers.read_polygons(spark, str(tmp_path / "g.json")).collect()] == [("강원", 0, 1), ("x", 1, 1), ("x", 1, 2)]


def test_history_facilities_policies_newest(spark, tmp_path):
    meta = {"A1": {"region": "서울", "brand": [["20240101", "SK"], ["bad", "x"]], "location": [["2024-01-01", "37.5", "127.0"]]}}
    (tmp_path / "m.json").write_text(json.dumps(meta))
    assert [(r.station_id, r["values"]) for r in readers.read_station_history(spark, str(tmp_path / "m.json"), "location").collect()] == [("A1", ["37.5", "127.0"])]
    assert readers.read_station_history(spark, str(tmp_path / "m.json"), "brand").count() == 1
    (tmp_path / "f.csv").write_text("구분,이름,경도,위도\n항만,p,127.1,37.2\n공항,q,x,\n")
    assert [(r.facility_id, r.lon) for r in readers.read_facilities(spark, str(tmp_path / "f.csv")).collect()] == [("F000001", 127.1), ("F000002", None)]
    (tmp_path / "p.csv").write_text("정책명,시작일,종료일,유종,가격,카테고리\ncut,2008-03-10,2008-12-31,휘발유,-10,0\n,2008-03-10,,경유,1,0\n")
    p = readers.read_policies(spark, str(tmp_path / "p.csv")).collect()
    assert len(p) == 1 and p[0].rate == pytest.approx(0.1)
    assert readers.newest_file(spark, str(tmp_path), "p*.csv").endswith("p.csv")
    with pytest.raises(FileNotFoundError):
        readers.newest_file(spark, str(tmp_path), "none*.csv")


def test_land_prices(spark):
    df = spark.createDataFrame([(0, 0, 1.0, None), (500, 0, 2.0, 3.0)], "cell_x int, cell_y int, p_20200101 double, p_20210101 double")
    assert readers.land_price_snapshots(df).count() == 3
    with pytest.raises(ValueError, match="more than once"):
        readers.land_price_snapshots(df.union(df))


def test_upserts_and_cache(spark, tmp_path):
    old = spark.createDataFrame([(dt.date(2024, 1, 1), "s", 1.0), (dt.date(2024, 1, 2), "s", 2.0)], "date date, station_id string, price double")
    new = spark.createDataFrame([(dt.date(2024, 1, 2), "s", None), (dt.date(2024, 1, 3), "s", 3.0)], "date date, station_id string, price double")
    assert sorted(r.price for r in sinks.upsert_cells(old, new).collect()) == [1.0, 2.0, 3.0]
    assert sorted((r.date.day, r.price) for r in sinks.upsert_by_date(old, new).collect()) == [(1, 1.0), (2, None), (3, 3.0)]
    sinks.write_parquet(old, f"{tmp_path}/in")
    calls = []
    build = lambda: calls.append(1) or old
    for conditions in ({"a": 1}, {"a": 1}, {"a": 2}):
        assert sinks.cached(spark, f"{tmp_path}/cache", conditions, [f"{tmp_path}/in"], build).count() == 2
    sinks.write_parquet(new, f"{tmp_path}/in")
    sinks.cached(spark, f"{tmp_path}/cache", {"a": 1}, [f"{tmp_path}/in"], build)
    assert len(calls) == 3


def _rows(n, seed):
    r = random.Random(seed)
    return [(dt.date(2024, 1, 1) + dt.timedelta(days=r.randrange(6)), f"G{r.randrange(4)}", float(r.randrange(100)), seed * 1000 + i) for i in range(n)]


@pytest.mark.parametrize("order", [(1, 2), (2, 1)])
def test_state_is_the_same_in_any_delivery_order(spark, tmp_path, order):
    schema = "date date, grid_id string, price double, seq long"
    for k in order:
        spark.createDataFrame(_rows(30, k), schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        jobs.keep_last_state(stream, f"{tmp_path}/state", f"{tmp_path}/offsets", skip_without_gain=False).awaitTermination()
    want = {}
    for d, g, p, s in sorted(_rows(30, 1) + _rows(30, 2), key=lambda x: x[3]):
        want[d, g] = p
    got = {(r.date, r.grid_id): r.price for r in jobs.read_state(spark, f"{tmp_path}/state").collect()}
    assert got == want


def test_batches_without_gain_are_skipped_and_late_rows_go(spark, tmp_path):
    schema = "date date, grid_id string, price double, seq long"

    def deliver(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        jobs.keep_last_state(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/state", f"{tmp_path}/offsets", days=10, skip_without_gain=True).awaitTermination()
        return sorted((r.date.day, r.price) for r in spark.read.parquet(f"{tmp_path}/state").collect())

    d = lambda k: dt.date(2024, 1, k)
    assert deliver([(d(20), "G", 1.0, 1)]) == [(20, 1.0)]
    assert deliver([(d(20), "G", 9.0, 2)]) == [(20, 1.0)]
    assert deliver([(d(2), "G", 5.0, 3), (d(21), "G", 6.0, 4)]) == [(20, 1.0), (21, 6.0)]
    # the state forgets: folders ten days before the newest are gone, and what comes for them is late
    assert deliver([(d(30), "G", 7.0, 5), (d(25), "G", 7.5, 6)]) == [(21, 6.0), (25, 7.5), (30, 7.0)]
    assert deliver([(d(20), "G", 8.0, 7), (d(31), "G", 9.0, 8), (d(31), "H", 9.5, 9)]) == [(25, 7.5), (30, 7.0), (31, 9.0), (31, 9.5)]
    assert sorted(f.name for f in tmp_path.joinpath("state").glob("day=*")) == ["day=2024-01-25", "day=2024-01-30", "day=2024-01-31"]


def test_next_day_by_a_stored_model(spark, tmp_path):
    r = random.Random(3)
    prices = {(k, g): 100 + 10 * g + r.random() for k in range(1, 15) for g in range(5) if (k, g) != (9, 2)} | {(15, 0): 99.0}
    state = spark.createDataFrame([(dt.date(2024, 1, k), f"G{g}", p) for (k, g), p in prices.items()], "date date, grid_id string, price double")
    jobs.fit_next_day(state, f"{tmp_path}/model")
    gaps, learn = {}, []
    for g in range(5):
        days = sorted(k for k, h in prices if h == g)
        for i, k in enumerate(days):
            last = [prices[d, g] for d in days[max(0, i - 6) : i + 1]]
            gaps[k, g] = prices[k, g] - sum(last) / len(last)
            if (k + 1, g) in prices:
                learn.append((gaps[k, g], prices[k + 1, g] - prices[k, g]))
    slope, intercept = np.polyfit(*zip(*learn, strict=True), 1)
    guess = lambda k, g: prices[k, g] + intercept + slope * gaps[k, g]

    def told(published):
        days = spark.createDataFrame([(dt.date(2024, 1, k),) for k in published], "date date")
        return {(x.date.day, int(x.grid_id[1:])): x.prediction for x in jobs.next_day_prediction(state, days, f"{tmp_path}/model").collect()}

    # day 15 is not complete, so 15 is the last date that can be predicted
    for published, start in (([], 15), ([1, 12], 13), ([14], 15), ([15], None), ([20], 15)):
        want = {(k + 1, g): guess(k, g) for k in range(1, 15) for g in range(5) if start and start <= k + 1 and (k, g) in prices}
        got = told(published)
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want), published


def test_append_job_writes_days_once_and_forgets(spark, tmp_path):
    schema = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("grid_id", T.StringType()), T.StructField("price", T.DoubleType())])
    at = lambda k, h=0: dt.datetime(2024, 1, k, h)

    def deliver(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        told = jobs.append_daily(spark, f"{tmp_path}/in", schema, f"{tmp_path}/out", f"{tmp_path}/offsets", "2 days")
        return told, sorted((r.date.day, r.grid_id, r.price, r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert deliver([(at(1), "G", 1.0), (at(1, 5), "G", 3.0), (at(2), "G", 5.0)]) == ({"rows_dropped": 0, "state_rows": 2}, [])
    told, rows = deliver([(at(1, 9), "G", 5.0), (at(9), "H", 7.0)])
    assert rows == [(1, "G", 3.0, 3), (2, "G", 5.0, 1)] and told == {"rows_dropped": 0, "state_rows": 1}
    told, rows = deliver([(at(2), "G", 1e9), (at(8), "H", 8.0)])
    assert rows == [(1, "G", 3.0, 3), (2, "G", 5.0, 1)] and told == {"rows_dropped": 1, "state_rows": 2}


def test_html_cells_of_nested_and_open_tables(spark):
    page = "<p>x</p><table><tr><th>a<td>b<table><tr><td>in<td>ner<tr><td>2</table>after<tr><td>c &amp; d</td><td></table><table><td>" + "e" * 70_000
    rows = readers.html_cells(spark.createDataFrame([(1, page), (2, None), (3, "no table"), (4, "</td></table><td>")], "id int, html string"), "html")
    got = sorted((r.id, r.table_no, r.row_no, r.cell_no, r.text) for r in rows.collect())
    assert got == [
        (1, 0, 0, 0, "a"), (1, 0, 0, 1, "bafter"), (1, 0, 1, 0, "c & d"), (1, 0, 1, 1, ""), (1, 1, 0, 0, "in"), (1, 1, 0, 1, "ner"), (1, 1, 1, 0, "2"), (1, 2, 0, 0, "e" * 70_000),
    ]


def test_newest_of_matching_folders_and_nested_regions(spark, tmp_path):
    for name in ("a_1", "a_2", "axb"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_text(name)
    assert readers.newest_file(spark, str(tmp_path), "f.csv", "a_*").endswith("a_2/f.csv")
    df = spark.createDataFrame([("r", "d1", 2, 1.5), ("r", "d1", 1, float("nan")), ("r", "d2", 3, 2.0), ("s", "d", 4, 3.0)], "region string, district string, id int, x double")
    assert sorted(map(tuple, sinks.write_regions(df, f"{tmp_path}/regions", ["id", "x"]).collect())) == [("r", 2, 3), ("s", 1, 1)]
    documents = [json.loads(line) for f in (tmp_path / "regions").glob("*.json") for line in f.read_text().splitlines()]
    assert {"region": "r", "districts": [{"district": "d1", "cells": [{"id": 1, "x": None}, {"id": 2, "x": 1.5}]}, {"district": "d2", "cells": [{"id": 3, "x": 2.0}]}]} in documents and len(documents) == 2


def test_json_is_safe(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, 1.5)], "i int, x double")
    sinks.write_json(df, f"{tmp_path}/j")
    assert [r.x for r in spark.read.json(f"{tmp_path}/j").orderBy("i").collect()] == [None, None, 1.5]
    assert df.select(F.count("*")).first()[0] == 3
