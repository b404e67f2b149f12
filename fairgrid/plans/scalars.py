"""Queries of the date, text, number and geographic functions (DT, STR, NUM, GEO, ARR, JSN)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fairgrid.functions import dates, geo, numbers, text

from fairgrid.functions.numbers import half_up

from fairgrid.sources import readers

from .registry import query
from .tables import DOM_SQL, GRID_SQL, OBS_SQL, POLICY_SQL, STATION_SQL, domestic, grid_day, observations, policies, read, stations


@query("""with t as (select o_orderkey, cast(o_orderdate as date) d from orders)
select o_orderkey, d a, d b, d c, d e, cast(null as date) bad from t""")
def dt_01_mixed_dates(spark, sf):
    """Dates written five ways and read back."""
    t = read(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    w = t.select("o_orderkey", F.date_format("d", "yy'년'MM'월'dd'일'").alias("a"), F.date_format("d", "yyyy/M/d").alias("b"), F.date_format("d", "yyyyMMdd").alias("c"), F.date_format("d", "yyyy.MM.dd").alias("e"), F.concat(F.date_format("d", "yyyy"), F.lit("-02-30")).alias("bad"))
    return w.select("o_orderkey", *[dates.parse_date(F.col(c)).alias(c) for c in ("a", "b", "c", "e", "bad")])


@query("""with t as (select distinct cast(date_trunc('month', o_orderdate) as date) m from orders), k as (select m, w from t, (values (1), (2), (3), (4), (5)) v(w))
select m, w, cast(case when w = 5 then last_day(m) else m + (7 * w - 1) end as date) week_end from k""")
def dt_02_week_labels(spark, sf):
    m = read(spark, sf, "orders").select(F.trunc("o_orderdate", "MM").alias("m")).distinct().select("m", F.explode(F.array(*map(F.lit, range(1, 6)))).alias("w"))
    label = F.concat(F.date_format("m", "yy'년'MM'월'"), F.col("w").cast("string"), F.lit("주"))
    return m.select("m", "w", dates.week_label_end(label).alias("week_end"))


@query(f"with {DOM_SQL} select cast(d + cast(6 - dayofweek(d) as int) as date) week_end, count(*) as days, min(d) first_day, max(d) last_day from dom group by 1")
def dt_03_saturday_weeks(spark, sf):
    d = domestic(spark, sf)
    return d.groupBy(dates.saturday_week(F.col("d")).alias("week_end")).agg(F.count("*").alias("days"), F.min("d").alias("first_day"), F.max("d").alias("last_day"))


@query(f"""with {DOM_SQL}, s as (select cast(unnest(generate_series(cast(min(d) as timestamp), cast(max(d) as timestamp), interval 1 day)) as date) d from dom)
select s.d, round(x, 3) x from s left join dom using (d)""")
def dt_04_calendar_spine(spark, sf):
    return dates.spine_of(domestic(spark, sf), "d").join(domestic(spark, sf), "d", "left").select("d", half_up("x", 3).alias("x"))


@query(f"""with {DOM_SQL} select d, round((row_number() over (order by d) - 1) / 365.25, 6) trend, cast(isodow(d) = 2 as double) weekday_1, cast(isodow(d) = 7 as double) weekday_6,
cast(month(d) = 2 as double) month_2, cast(month(d) = 12 as double) month_12 from dom""")
def dt_05_calendar_features(spark, sf):
    return dates.calendar_features(domestic(spark, sf), "d").select("d", half_up("trend", 6).alias("trend"), "weekday_1", "weekday_6", "month_2", "month_12")


@query("select o_orderkey, cast(date '2001-12-31' - cast(o_orderdate as date) as int) age_days, cast(year(o_orderdate) as int) source_year from orders")
def dt_06_age_and_year(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", F.datediff(F.lit("2001-12-31").cast("date"), F.to_date("o_orderdate")).alias("age_days"), F.year("o_orderdate").alias("source_year"))


@query("select o_orderkey, cast(least(ceil(day(o_orderdate) / 7.0), 5) as int) as week from orders")
def dt_07_month_week(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", dates.month_week(F.col("o_orderdate")).alias("week"))


@query("""with r as (select o_custkey, min(cast(o_orderdate as date)) a, max(cast(o_orderdate as date)) b from orders group by 1),
m as (select o_custkey, a, b, cast(unnest(generate_series(date_trunc('month', a), cast(b as timestamp), interval 1 month)) as date) m from r)
select o_custkey, greatest(m, a) "start", least(last_day(m), b) "end" from m""")
def dt_08_month_chunks(spark, sf):
    r = read(spark, sf, "orders").groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b"))
    return r.select("o_custkey", F.explode(dates.month_chunks(F.col("a"), F.col("b"))).alias("c")).select("o_custkey", "c.*")


@query("""select o_custkey, max(cast(o_orderdate as date)) last_day, case when date '2001-08-01' - max(cast(o_orderdate as date)) <= 30 then 'fresh' else 'stale' end state from orders group by 1""")
def dt_09_freshness(spark, sf):
    r = read(spark, sf, "orders").groupBy("o_custkey").agg(F.max(F.to_date("o_orderdate")).alias("last_day"))
    return r.select("o_custkey", "last_day", dates.freshness(F.col("last_day"), F.lit("2001-08-01").cast("date"), 30).alias("state"))


@query(f"with {POLICY_SQL}, {OBS_SQL} select name, count(*) n from policies p join obs on obs.fuel = p.fuel and d between start + 7 and \"end\" + 7 group by 1")
def dt_10_lagged_policies(spark, sf):
    p = policies(spark).select("name", F.col("fuel"), F.date_add("start", 7).alias("a"), F.date_add("end", 7).alias("b"))
    o = observations(spark, sf).groupBy("fuel", "d").count()
    return o.join(F.broadcast(p), "fuel").where("d between a and b").groupBy("name").agg(F.sum("count").alias("n"))


@query("select p_partkey, trim(regexp_replace('  ' || p_name || ' \t x', '\\s+', ' ', 'g')) s from part")
def str_01_squeeze(spark, sf):
    return read(spark, sf, "part").select("p_partkey", text.squeeze(F.concat(F.lit("  "), "p_name", F.lit(" \t x"))).alias("s"))


@query("select p_partkey, 'N1fi2 ' || p_name s from part")
def str_01_unicode_form(spark, sf):
    """NFKC by a vectorised function; Spark has none built in. Full-width, circled, ligature and raised characters become plain ones."""
    return read(spark, sf, "part").select("p_partkey", text.unicode_form("NFKC")(F.concat(F.lit("Ｎ①ﬁ²\u3000"), "p_name")).alias("s"))


_NAMES = "case p_size % 8 when 0 then 'sk ' when 1 then 'GS칼텍스 ' when 2 then '현대' when 3 then 'S-oil ' when 4 then '알뜰' when 5 then 'NH' when 6 then '자가 ' else 'x' end || p_brand"


@query(f"""select p_partkey, case p_size % 8 when 0 then 'SK에너지' when 1 then 'GS칼텍스' when 2 then 'HD현대오일뱅크' when 3 then 'S-OIL' when 4 then '알뜰' when 5 then 'NH-OIL' when 6 then '자가상표' else '기타' end brand from part""")
def str_02_brand_classes(spark, sf):
    return read(spark, sf, "part").select("p_partkey", text.brand_class(F.expr(_NAMES)).alias("brand"))


@query("""select fuel, case l_returnflag when 'A' then 'self' when 'N' then 'full' else 'unknown' end service, case l_quantity % 4 when 0 then 'storage' when 1 then 'factory' when 2 then 'agency' end facility, count(*) n
from (select l_returnflag, l_quantity, case when l_linestatus = 'F' then 'gasoline' else 'diesel' end fuel from lineitem) group by all""")
def str_03_self_service(spark, sf):
    """Self-service by contained label, and kinds of facilities."""
    flag = F.when(F.col("l_returnflag") == "A", F.when(F.col("l_orderkey") % 2 == 0, " Y ").otherwise("한마음 셀프주유소")).when(F.col("l_returnflag") == "N", F.lit("일반 "))
    site = F.when(F.col("l_quantity") % 4 == 0, "남부 저유소").when(F.col("l_quantity") % 4 == 1, "윤활유공장").when(F.col("l_quantity") % 4 == 2, "직영 대리점").otherwise("본사")
    t = read(spark, sf, "lineitem").select(F.when(F.col("l_linestatus") == "F", "gasoline").otherwise("diesel").alias("fuel"), text.self_class(flag).alias("service"), text.facility_class(site).alias("facility"))
    return t.groupBy("fuel", "service", "facility").agg(F.count("*").alias("n"))


@query("select p_partkey, case when p_size % 2 = 0 then p_name || ' (old) - 변경 1|' || p_name || ' - 변경 1|' || p_name else p_name end variants from part")
def str_04_address_variants(spark, sf):
    raw = F.when(F.col("p_size") % 2 == 0, F.concat("p_name", F.lit(" (old) - 변경 1"))).otherwise(F.col("p_name"))
    return read(spark, sf, "part").select("p_partkey", F.array_join(text.address_variants(raw), "|").alias("variants"))


@query("select n_nationkey, case n_nationkey % 3 when 0 then '강원' when 1 then '전북' else n_name end region from nation")
def str_05_region_names(spark, sf):
    long = F.when(F.col("n_nationkey") % 3 == 0, "강원특별자치도").when(F.col("n_nationkey") % 3 == 1, "전라북도").otherwise(F.col("n_name"))
    return read(spark, sf, "nation").select("n_nationkey", text.short_region(long).alias("region"))


@query("select s_suppkey, s_suppkey % 4 = 0 is_id, case when s_suppkey % 4 in (1, 2) then null when s_suppkey % 4 = 0 then 'A' || s_suppkey else s_name end clean from supplier")
def str_06_identifiers(spark, sf):
    k = F.col("s_suppkey") % 4
    raw = F.when(k == 0, F.concat(F.lit("A"), F.col("s_suppkey").cast("string"))).when(k == 1, " nan ").when(k == 2, "").otherwise(F.col("s_name"))
    return read(spark, sf, "supplier").select("s_suppkey", text.is_station_id(raw).alias("is_id"), text.blank_to_null(raw).alias("clean"))


@query(f"with {GRID_SQL} select distinct grid_id from grid")
def str_07_grid_ids(spark, sf):
    return grid_day(spark, sf).select("grid_id").distinct()


@query("select o_orderkey, case when o_orderkey % 5 = 0 then null else round(o_totalprice, 2) end x from orders")
def num_01_tolerant_numbers(spark, sf):
    x = F.when(F.col("o_orderkey") % 10 == 0, "-").when(F.col("o_orderkey") % 5 == 0, " nan").otherwise(F.concat(F.lit('"'), F.format_number("o_totalprice", 2), F.lit('"')))
    return read(spark, sf, "orders").select("o_orderkey", half_up(numbers.parse_number(x), 2).alias("x"))


@query("with t as (select l_orderkey, l_linenumber, l_extendedprice, l_quantity from lineitem) select l_orderkey, l_linenumber, round(l_extendedprice * (1000 + l_quantity) / 158.987294928, 3) krw from t")
def num_02_krw_per_litre(spark, sf):
    return read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", half_up(numbers.krw_per_litre(F.col("l_extendedprice"), 1000 + F.col("l_quantity")), 3).alias("krw"))


@query("select l_orderkey, l_linenumber, round(l_extendedprice / 1.1 - l_tax * 100 - coalesce(case when l_returnflag = 'A' then l_discount end, 0), 3) pretax from lineitem")
def num_03_pretax(spark, sf):
    t = read(spark, sf, "lineitem")
    return t.select("l_orderkey", "l_linenumber", half_up(numbers.pretax(F.col("l_extendedprice"), F.col("l_tax") * 100, F.when(F.col("l_returnflag") == "A", F.col("l_discount"))), 3).alias("pretax"))


@query("select l_orderkey, l_linenumber, round(case when l_discount > 0 and l_discount < 1 then 745.89 * l_discount * 1.1 else 0 end, 3) shift, round(case when l_discount > 0 and l_discount < 1 then 528.75 * l_discount else 0 end, 3) ex_vat from lineitem")
def num_04_policy_shift(spark, sf):
    t, base = read(spark, sf, "lineitem"), numbers.BASE_TAX
    return t.select("l_orderkey", "l_linenumber", half_up(numbers.policy_shift(F.lit(base["gasoline"]), F.col("l_discount")), 3).alias("shift"), half_up(numbers.policy_shift(F.lit(base["diesel"]), F.col("l_discount"), with_vat=False), 3).alias("ex_vat"))


_BAND = "select l_orderkey, l_linenumber, case when l_returnflag = 'A' and l_linestatus = 'F' then null else l_extendedprice / l_quantity end actual, 1500.0 fair, case when l_linenumber = 1 then null else 1400.0 end low, 1600.0 high from lineitem"


@query(f"""with t as ({_BAND}) select l_orderkey, l_linenumber, actual is not null and low is not null valid, coalesce(low is not null and actual between low and high, false) inside,
coalesce(low is not null and actual > high, false) above, coalesce(actual < low, false) below from t""")
def num_06_position(spark, sf):
    read(spark, sf, "lineitem").createOrReplaceTempView("lineitem")
    t = spark.sql(_BAND)
    return t.select("l_orderkey", "l_linenumber", *[v.alias(k) for k, v in numbers.position(F.col("actual"), F.col("low"), F.col("high")).items()])


@query(f"""with t as ({_BAND}) select l_orderkey, l_linenumber, case when actual is null then null when actual > high then 'expensive' when actual < low then 'cheap' when low is not null then 'fair'
when actual > fair then 'expensive' when actual < fair then 'cheap' else 'fair' end judgement from t""")
def num_07_judgement(spark, sf):
    read(spark, sf, "lineitem").createOrReplaceTempView("lineitem")
    t = spark.sql(_BAND)
    return t.select("l_orderkey", "l_linenumber", numbers.judge(F.col("actual"), F.col("fair"), F.col("low"), F.col("high")).alias("judgement"))


@query("select l_orderkey, l_linenumber, round(l_extendedprice * exp(l_discount), 3) by_log, round(l_extendedprice * (1 + l_discount), 3) by_percent from lineitem")
def num_08_level_rebuild(spark, sf):
    t = read(spark, sf, "lineitem")
    return t.select("l_orderkey", "l_linenumber", half_up(numbers.rebuild_level(F.col("l_extendedprice"), F.col("l_discount") * 100), 3).alias("by_log"), half_up(numbers.rebuild_level(F.col("l_extendedprice"), F.col("l_discount") * 100, False), 3).alias("by_percent"))


@query(f"""with {STATION_SQL}, p as (select station_id, 126.5 + station_id * 0.03 lon, 34.5 + station_id * 0.03 lat from station)
select station_id, round(2 * 6371.0088 * asin(sqrt(pow(sin(radians(37.5 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(37.5)) * pow(sin(radians(127.0 - lon) / 2), 2))), 3) km,
lon between 120 and 135 and lat between 30 and 45 valid from p""")
def geo_02_haversine(spark, sf):
    p = stations(spark, sf).select("station_id", (126.5 + F.col("station_id") * 0.03).alias("lon"), (34.5 + F.col("station_id") * 0.03).alias("lat"))
    return p.select("station_id", half_up(geo.haversine_km(F.col("lon"), F.col("lat"), F.lit(127.0), F.lit(37.5)), 3).alias("km"), geo.valid_coordinates(F.col("lon"), F.col("lat")).alias("valid"))


def _metre_grid_sql() -> str:
    """The projection's series written out in SQL."""
    k, e = geo.SCALE * geo._RADIUS, geo._E
    x = "eta" + "".join(f" + {c!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, c in enumerate(geo._ALPHA, 1))
    y = "xi" + "".join(f" + {c!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, c in enumerate(geo._ALPHA, 1))
    a = "xi" + "".join(f" - {c!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, c in enumerate(geo._BETA, 1))
    b = "eta" + "".join(f" - {c!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, c in enumerate(geo._BETA, 1))
    lat = "chi" + "".join(f" + {c!r} * sin({2 * j} * chi)" for j, c in enumerate(geo._DELTA, 1))
    return f"""with p as (select s_suppkey station_id, radians(126.5 + (s_suppkey % 97) * 0.02 - {geo.LON0}) dl, sin(radians(34.5 + (s_suppkey % 89) * 0.03)) s from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
t as (select station_id, dl, sinh(atanh(s) - {e!r} * atanh({e!r} * s)) t from p), q as (select station_id, atan2(t, cos(dl)) xi, asinh(sin(dl) / sqrt(t * t + cos(dl) * cos(dl))) eta from t),
m as (select station_id, cast(floor(({geo.EAST0} + {k!r} * ({x})) / 500) * 500 as int) cell_x, cast(floor(({geo.NORTH0} + {k!r} * ({y} - {geo._XI0!r})) / 500) * 500 as int) cell_y from q),
u as (select *, (cell_y + 250.0 - {geo.NORTH0}) / {k!r} + {geo._XI0!r} xi, (cell_x + 250.0 - {geo.EAST0}) / {k!r} eta from m), v as (select *, {a} a, {b} b from u), w as (select *, asin(sin(a) / cosh(b)) chi from v)
select station_id, cell_x, cell_y, round({geo.LON0} + degrees(atan2(sinh(b), cos(a))), 6) lon, round(degrees({lat}), 6) lat from w"""


@query(_metre_grid_sql())
def geo_01_metre_grid(spark, sf):
    """Degrees to the 500 m cell and back, by native functions."""
    p = stations(spark, sf).select("station_id", (126.5 + (F.col("station_id") % 97) * 0.02).alias("lon"), (34.5 + (F.col("station_id") % 89) * 0.03).alias("lat"))
    east, north = geo.to_metres(F.col("lon"), F.col("lat"))
    cells = p.select("station_id", east.alias("east"), north.alias("north")).withColumns({"cell_x": geo.cell(F.col("east")), "cell_y": geo.cell(F.col("north"))})
    lon, lat = geo.to_degrees(F.col("cell_x") + 250.0, F.col("cell_y") + 250.0)
    return cells.select("station_id", "cell_x", "cell_y", half_up(lon, 6).alias("lon"), half_up(lat, 6).alias("lat"))


@query("""with t as (select o_custkey, list_sort(list_distinct(list(cast(o_orderdate as date)))) as days, list_sort(list_distinct(list(o_orderpriority))) priorities from orders group by 1)
select o_custkey, len(days) n_days, days[1] first_day, array_to_string(priorities, '|') priorities from t""")
def arr_01_sorted_sets(spark, sf):
    t = read(spark, sf, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_set(F.to_date("o_orderdate"))).alias("days"), F.array_sort(F.collect_set("o_orderpriority")).alias("priorities"))
    return t.select("o_custkey", F.size("days").cast("long").alias("n_days"), F.element_at("days", 1).alias("first_day"), F.array_join("priorities", "|").alias("priorities"))


@query("""select r_name region, '{"region":"' || r_name || '","districts":' || count(*) || ',"names":[' || string_agg('"' || n_name || '"', ',' order by n_name) || ']}' doc from nation join region on n_regionkey = r_regionkey group by r_name""")
def jsn_01_nested_documents(spark, sf):
    n, r = read(spark, sf, "nation"), read(spark, sf, "region")
    t = n.join(r, n.n_regionkey == r.r_regionkey).groupBy(F.col("r_name").alias("region")).agg(F.count("*").alias("districts"), F.array_sort(F.collect_list("n_name")).alias("names"))
    return t.select("region", F.to_json(F.struct("region", "districts", "names")).alias("doc"))


@query("select event_id, try_cast(json_extract_string(props, '$.k') as int) k from events")
def jsn_02_nested_read(spark, sf):
    return read(spark, sf, "events").select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


@query(f"with {STATION_SQL} select station_id from station where 118 + station_id * 0.2 between 120 and 135")
def flt_03_valid_coordinates(spark, sf):
    return stations(spark, sf).where(geo.valid_coordinates(118 + F.col("station_id") * 0.2, F.lit(37.0))).select("station_id")


@query("select event_type, round(sqrt(avg((value - m) * (value - m))), 4) rmse, round(avg(abs(value - m)), 4) mae from (select event_type, value, avg(value) over (partition by event_type) m from events) group by 1")
def udf_02_custom_aggregates(spark, sf):
    """UDF-02: RMSE and MAE as composed columns, without Python."""
    from fairgrid.operators.aggregates import error_metrics

    e = read(spark, sf, "events")
    t = e.join(e.groupBy("event_type").agg(F.avg("value").alias("m")), "event_type").groupBy("event_type").agg(*error_metrics("value", "m"))
    return t.select("event_type", half_up("rmse", 4).alias("rmse"), half_up("mae", 4).alias("mae"))


@query(f"with {POLICY_SQL}, r as (select o_custkey, min(cast(o_orderdate as date)) a from orders group by 1) select o_custkey, cast(unnest(generate_series(cast(a as timestamp), a + interval 6 day, interval 1 day)) as date) d from r")
def udf_03_row_generation(spark, sf):
    """UDF-03: a row for each of seven days, by sequence and explode."""
    r = read(spark, sf, "orders").groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("a"))
    return r.select("o_custkey", F.explode(F.sequence("a", F.date_add("a", 6))).alias("d"))


@query("select p_partkey, case p_size % 2 when 0 then 'NH-OIL' else 'SK에너지' end brand, case p_size % 3 when 0 then 'self' when 1 then 'full' else 'unknown' end service, date '2026-06-01' + (p_size % 28)::int as day from part")
def udf_01_mapped_values(spark, sf):
    """UDF-01: brand, service and date of each value by column functions, without Python."""
    t = read(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") % 2 == 0, " nh ").otherwise("에스케이").alias("b"), F.when(F.col("p_size") % 3 == 0, "셀프").when(F.col("p_size") % 3 == 1, "N").alias("s"), F.format_string("26년06월%02d일", F.col("p_size") % 28 + 1).alias("d"))
    return t.select("p_partkey", text.brand_class(F.col("b")).alias("brand"), text.self_class(F.col("s")).alias("service"), dates.parse_date(F.col("d")).alias("day"))


@query("""with c as (select c_custkey, c_name, c_mktsegment from customer)
select c_custkey, 0 table_no, 0 row_no, 0 cell_no, 'No & name' as text from c union all select c_custkey, 0, 0, 1, c_name || ' end' from c
union all select c_custkey, 1, 0, 0, c_mktsegment from c union all select c_custkey, 1, 0, 1, '' from c union all select c_custkey, 0, 1, 0, c_custkey::varchar from c""")
def udf_03_html_cells(spark, sf):
    """UDF-03: the cells of nested tables with cells and rows left open, by a table function in a lateral join."""
    t = read(spark, sf, "customer")
    page = F.concat(F.lit("<table><tr><th>No &amp;\n name<td>"), "c_name", F.lit("<table><td>"), "c_mktsegment", F.lit("<td></table> <b>end</b><TR><td>"), F.col("c_custkey").cast("string"))
    return readers.html_cells(t.select("c_custkey", page.alias("html")), "html").drop("html")
