"""Queries that write, read again and upsert (SRC, SNK) and that run as streams (STM), from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fairgrid.functions.numbers import half_up
from fairgrid.operators import frames
from fairgrid.operators.frames import rounded
from fairgrid.sources import readers, sinks
from fairgrid.streaming import jobs

from .registry import query
from .tables import DOM_SQL, GRID_SQL, INTL_SQL, OBS_SQL, STATION_SQL, domestic, grid_day, international, observations, read, stations


@query(f"with {DOM_SQL} select d as date, round(x, 2) dubai, round(x * 2, 2) brent, cast(n as double) wti from dom")
def src_01_csv_with_header_map(spark, sf):
    """SRC-01, SRC-09: daily values written as the source writes them, in its code page, and read by the header map."""
    out = sinks.work_folder(spark, "csv")
    t = domestic(spark, sf).select(F.date_format("d", "yy'년'MM'월'dd'일'").alias("기간"), F.format_number(half_up("x", 2), 2).alias("Dubai"), F.format_number(half_up(F.col("x") * 2, 2), 2).alias("Brent"), F.col("n").cast("string").alias("WTI"))
    to_bytes = lambda c: readers.recode("euc-kr", "latin-1")(F.col(c)).alias(c.encode("euc-kr").decode("latin-1"))
    t.select(*[to_bytes(c) for c in t.columns]).write.option("header", True).option("encoding", "ISO-8859-1").csv(out)
    return rounded(readers.read_dataset(spark, out, "crude"), 2)


#: Stations of one nested document.
_STATIONS = 500


@query(f"with {OBS_SQL} select d as date, 'A' || station_id station_id, round(max(price), 3) price, 'diesel' fuel from obs where fuel = 'diesel' group by all")
def src_05_wide_station_matrix(spark, sf):
    """SRC-05, RSH-02: matrices with a column for each station, so many to a file, written in one job and melted again in one."""
    o = observations(spark, sf).where("fuel = 'diesel'")
    out = sinks.work_folder(spark, "matrix")
    readers.write_price_matrix(o.select(F.col("d").alias("date"), F.concat(F.lit("A"), F.col("station_id").cast("string")).alias("station_id"), half_up("price", 3).alias("price")), out)
    return readers.read_price_matrix(spark, out, "diesel").select("date", "station_id", "price", "fuel")


@query("select 'A' || user_id station_id, cast(ts as date) effective_date, cast(event_id as varchar) brand from events")
def src_06_station_history(spark, sf):
    """SRC-06: nested documents of attribute histories, so many stations to one, read as a row for each entry."""
    out = sinks.work_folder(spark, "meta")
    e = read(spark, sf, "events")
    n_docs = max(1, -(-e.agg(F.count_distinct("user_id")).first()[0] // _STATIONS))
    e = e.groupBy(F.concat(F.lit("A"), F.col("user_id").cast("string")).alias("k")).agg(F.collect_list(F.array(F.date_format("ts", "yyyy-MM-dd"), F.col("event_id").cast("string"))).alias("brand"))
    e.groupBy(F.pmod(F.xxhash64("k"), F.lit(n_docs)).alias("part")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("k", F.struct("brand"))))).alias("value")).repartition("part").write.partitionBy("part").text(out)
    return readers.read_station_history(spark, out, "brand").select("station_id", "effective_date", F.col("values")[0].alias("brand"))


@query(f"with {STATION_SQL}, c as (select distinct cell_x, cell_y from station) select cell_x, cell_y, date '2020-01-01' snapshot_date, cast(cell_x + cell_y as double) \"value\" from c union all select cell_x, cell_y, date '2021-01-01', cast(cell_x as double) from c where cell_x > 1000")
def src_13_land_price_snapshots(spark, sf):
    c = stations(spark, sf).select("cell_x", "cell_y").distinct()
    return readers.land_price_snapshots(c.select("cell_x", "cell_y", (F.col("cell_x") + F.col("cell_y")).alias("p_20200101"), F.when(F.col("cell_x") > 1000, F.col("cell_x")).alias("p_20210101")))


@query(f"with {GRID_SQL} select year(d)::int \"year\", month(d)::int \"month\", count(*) n, round(sum(price), 3) total from grid group by all")
def snk_02_month_partitions(spark, sf):
    """SNK-01, SNK-02, SRC-08: the panel in month folders; the read prunes to folders and columns."""
    out = sinks.work_folder(spark, "panel")
    sinks.write_by_month(grid_day(spark, sf), out, "d")
    return spark.read.parquet(out).groupBy("year", "month").agg(F.count("*").alias("n"), half_up(F.sum("price"), 3).alias("total"))


@query(f"with {DOM_SQL} select strftime(d, '%Y-%m-%d') as d, case when n > 5 then null else round(x, 3) end x, n from dom")
def snk_04_safe_json(spark, sf):
    """SNK-03, SNK-04: infinite and undefined numbers leave as null."""
    out = sinks.work_folder(spark, "json")
    x = F.when(F.col("n") > 8, F.lit(float("inf"))).when(F.col("n") > 5, F.lit(float("nan"))).otherwise(half_up("x", 3))
    sinks.write_json(domestic(spark, sf).select("d", x.alias("x"), "n"), out)
    return spark.read.schema("d string, x double, n long").json(out)


@query(f"with {STATION_SQL} select region, district, count(*) cells, round(avg(s_acctbal), 2) mean from station group by all")
def snk_05_region_files(spark, sf):
    """One nested document a region, read back to a row for each district."""
    out = sinks.work_folder(spark, "regions")
    sinks.write_regions(stations(spark, sf).select("region", "district", "station_id", "s_acctbal"), out, ["station_id", "s_acctbal"])
    back = spark.read.schema("region string, districts array<struct<district: string, cells: array<struct<station_id: bigint, s_acctbal: double>>>>").json(out)
    cells = back.select("region", F.explode("districts").alias("d")).select("region", "d.district", F.explode("d.cells").alias("c"))
    return cells.groupBy("region", "district").agg(F.count("*").alias("cells"), half_up(F.avg("c.s_acctbal"), 2).alias("mean"))


@query(f"with {DOM_SQL}, {INTL_SQL} select coalesce(intl.d, dom.d) as date, round(coalesce(y, x), 3) v from dom full join intl on intl.d = dom.d")
def snk_06_upsert_by_date(spark, sf):
    old, new = domestic(spark, sf).select(F.col("d").alias("date"), F.col("x").alias("v")), international(spark, sf).select(F.col("d").alias("date"), F.col("y").alias("v"))
    return rounded(sinks.upsert_by_date(old, new))


@query(f"with {GRID_SQL}, o as (select d as date, grid_id station_id, price from grid where fuel = 'diesel'), n as (select d as date, grid_id station_id, case when n = 1 then null else price end price from grid where fuel = 'gasoline') select date, station_id, round(coalesce(n.price, o.price), 3) price from o full join n using (date, station_id)")
def snk_07_upsert_cells(spark, sf):
    g = grid_day(spark, sf).select(F.col("d").alias("date"), F.col("grid_id").alias("station_id"), "fuel", "price", "n")
    new = g.where("fuel = 'gasoline'").select("date", "station_id", F.when(F.col("n") != 1, F.col("price")).alias("price"))
    return rounded(sinks.upsert_cells(g.where("fuel = 'diesel'").select("date", "station_id", "price"), new))


_STATE_SQL = f"{GRID_SQL}, s as (select d as date, grid_id, fuel, price, row_number() over (partition by d, grid_id order by fuel desc) rn from grid)"


@query(f"with {_STATE_SQL} select date, grid_id, round(price, 3) price from s where rn = 1 and date > (select max(date) from s) - 45")
def snk_08_rolling_state(spark, sf):
    g = grid_day(spark, sf).select(F.col("d").alias("date"), "grid_id", "price", F.col("fuel").alias("seq"))
    return rounded(sinks.rolling_state(g).drop("seq"))


@query(f"with {DOM_SQL} select year(d)::int \"year\", round(avg(x), 3) x from dom group by 1")
def snk_09_cached_result(spark, sf):
    """The second call reads what the first one stored under the same conditions and inputs."""
    folder = sinks.work_folder(spark, "cache")
    build = lambda: domestic(spark, sf).groupBy(F.year("d").alias("year")).agg(half_up(F.avg("x"), 3).alias("x"))
    stored = sinks.work_folder(spark, "inputs")
    sinks.write_parquet(domestic(spark, sf), stored)
    sinks.cached(spark, folder, {"by": "year"}, [stored], build)
    return sinks.cached(spark, folder, {"by": "year"}, [stored], lambda: 1 / 0)


def _as_code_page(t):
    """Headers and values as the bytes of the Korean code page, to be written byte for byte."""
    return t.select(*[readers.recode("cp949", "latin-1")(F.col(c).cast("string")).alias(c.encode("cp949").decode("latin-1")) for c in t.columns])


@query(f"with {DOM_SQL} select d as date, round(x, 2) gasoline, case when n > 6 then null else round(x / 2, 2) end diesel from dom")
def src_09_dataset_reader(spark, sf):
    """SRC-09: the retail averages by their header map; a dash is missing, a row without a date goes."""
    out = sinks.work_folder(spark, "retail")
    t = domestic(spark, sf).select(F.date_format("d", "yyyy'년'MM'월'dd'일'").alias("구분"), F.format_number(half_up("x", 2), 2).alias("보통휘발유"), F.when(F.col("n") > 6, "-").otherwise(F.format_number(half_up(F.col("x") / 2, 2), 2)).alias("자동차용경유"))
    t.union(t.limit(1).withColumn("구분", F.lit("합계"))).write.option("header", True).csv(out)
    return rounded(readers.read_dataset(spark, out, "retail_avg"), 2)


@query("select 'A' || s_suppkey station_id, s_name from supplier")
def src_02_best_decoding(spark, sf):
    """SRC-02: of several decodings that with the expected headers and ids."""
    out = sinks.work_folder(spark, "stations")
    t = read(spark, sf, "supplier").select(F.concat(F.lit("A"), F.col("s_suppkey").cast("string")).alias("번호"), F.col("s_name").alias("상호"))
    _as_code_page(t).write.option("header", True).option("encoding", "ISO-8859-1").csv(out)
    return readers.read_csv_any(spark, out, ["번호", "상호"], id_column="번호").toDF("station_id", "s_name")


@query("select count(*) n, round(sum(o_totalprice), 2) total from orders where o_orderkey % 3 <> 1")
def src_03_newest_file(spark, sf):
    """Three snapshots of one data set, one after the other, and a newer one of another: the last of the first counts."""
    out = sinks.work_folder(spark, "snapshots")
    o = read(spark, sf, "orders")
    for name, rows in (("orders_2", o.where("o_orderkey % 3 = 0")), ("orders_3", o.where("o_orderkey % 3 = 1")), ("orders_1", o.where("o_orderkey % 3 <> 1")), ("other_9", o.limit(1))):
        rows.coalesce(1).write.parquet(f"{out}/{name}")
    newest = readers.newest_file(spark, out, "part-*.parquet", "orders_*")
    return spark.read.parquet(newest).agg(F.count("*").alias("n"), half_up(F.sum("o_totalprice"), 2).alias("total"))


@query(f"with {DOM_SQL} select d as date, cast(null as double) customs, round(x, 2) transport, cast(n as double) education, 1.0::double driving, 0.5::double import_levy from dom")
def src_04_html_tax_table(spark, sf):
    """SRC-04: tax changes as an HTML page with a header row and a total column."""
    out = sinks.work_folder(spark, "tax")
    cell = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    row = F.concat(F.lit("<tr>"), cell(F.date_format("d", "yyyy'년'MM'월'dd'일'")), cell(F.lit("-")), cell(F.format_number(half_up("x", 2), 2)), cell(F.col("n").cast("string")), cell(F.lit("<b>1</b>")), cell(F.lit("0.5")), cell(F.lit("total")), F.lit("</tr>"))
    page = domestic(spark, sf).select(F.year("d").alias("y"), row.alias("r")).groupBy("y").agg(F.concat(F.lit("<table><tr><th>변동일자</th></tr>"), F.array_join(F.collect_list("r"), ""), F.lit("</table>")).alias("value"))
    page.repartition("y").write.partitionBy("y").text(out)
    return readers.read_tax(spark, out)


@query(f"""with {STATION_SQL}, k as (select district as name, s.station_id % 3 kind, s.* from station s)
select name, cast(sum(case when kind = 2 then 2 else 1 end) as bigint) polygons, cast(sum(case kind when 0 then 4 when 1 then 8 else 8 end) as bigint) corners, count(*) filter (where kind = 1) holes,
 round(sum(case kind when 0 then 250000.0 when 1 then 240000.0 else 500000.0 end), 1) area from k group by name""")
def src_07_polygons(spark, sf):
    """SRC-07: for each station a square, a square with a hole or two squares as one MultiPolygon, so many stations to a document, read into rings."""
    out = sinks.work_folder(spark, "geo")
    x, y = F.col("cell_x").cast("double"), F.col("cell_y").cast("double")
    square = lambda x, y, side: F.array(F.array(x, y), F.array(x + side, y), F.array(x + side, y + side), F.array(x, y + side))
    plain, holed = F.array(square(x, y, 500)), F.array(square(x, y, 500), square(x + 100, y + 100, 100))
    many = F.array(plain, F.array(square(x + 1000, y, 500)))
    kind = F.col("station_id") % 3
    shape = F.when(kind == 2, F.to_json(many)).when(kind == 1, F.to_json(holed)).otherwise(F.to_json(plain))
    line = F.concat(F.lit('{"properties":'), F.to_json(F.struct(F.col("district").alias("name"))), F.lit(',"geometry":{"type":"'), F.when(kind == 2, "MultiPolygon").otherwise("Polygon"), F.lit('","coordinates":'), shape, F.lit("}}"))
    t = stations(spark, sf)
    n_docs = max(1, -(-t.count() // _STATIONS))
    pages = t.groupBy(F.pmod(F.xxhash64("station_id"), F.lit(n_docs)).alias("part")).agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.concat_ws(",", F.collect_list(line)), F.lit("]}")).alias("value"))
    pages.repartition("part").write.partitionBy("part").text(out)
    p = readers.read_polygons(spark, out)
    size = lambda r: F.abs(F.aggregate(F.transform(r, lambda v, i: v[0] * F.get(r, (i + 1) % F.size(r))[1] - F.get(r, (i + 1) % F.size(r))[0] * v[1]), F.lit(0.0), lambda a, b: a + b)) / 2
    area = 2 * size(F.col("rings")[0]) - F.aggregate(F.transform("rings", size), F.lit(0.0), lambda a, b: a + b)  # the outer ring less its holes
    corners = F.aggregate(F.transform("rings", lambda r: F.size(r)), F.lit(0), lambda a, b: a + b)
    return p.groupBy("name").agg(F.count("*").alias("polygons"), F.sum(corners).alias("corners"), F.sum(F.size("rings") - 1).alias("holes"), half_up(F.sum(area), 1).alias("area"))


@query("select l_suppkey, count(*) n, round(sum(l_quantity), 3) q from (select l_suppkey, l_quantity from lineitem) group by 1")
def src_08_parquet_columns(spark, sf):
    """SRC-08: all columns but some; the scan still reads two."""
    t = readers.read_parquet_without(spark, f"{sf}/lineitem.parquet", "l_tax", "l_discount")
    return t.groupBy("l_suppkey").agg(F.count("*").alias("n"), half_up(F.sum("l_quantity"), 3).alias("q"))


@query(f"with {DOM_SQL}, m as (select date_trunc('month', d) m, max(x) x from dom group by 1) select cast(case w when 5 then last_day(m) else m + (7 * w - 1) * interval 1 day end as date) week_end, round(x, 2) gasoline, round(x + w, 2) diesel from m, (values (1), (5)) v(w)")
def src_10_refinery_weeks(spark, sf):
    """SRC-10: weekly prices under week labels, each week twice; the later row wins."""
    out = sinks.work_folder(spark, "refinery")
    m = domestic(spark, sf).groupBy(F.trunc("d", "MM").alias("m")).agg(F.max("x").alias("x")).select("*", F.explode(F.array(F.lit(1), F.lit(5))).alias("w"), F.explode(F.array(F.lit(0), F.lit(1))).alias("late"))
    label = F.concat(F.date_format("m", "yy'년'MM'월'"), F.col("w").cast("string"), F.lit("주"))
    shown = lambda c: F.when(F.col("late") == 1, F.format_number(half_up(c, 2), 2)).otherwise("-")
    m.orderBy("m", "w", "late").coalesce(1).select(label.alias("구분"), shown(F.col("x")).alias("보통휘발유"), shown(F.col("x") + F.col("w")).alias("자동차용경유")).write.option("header", True).csv(out)
    return readers.read_refinery_weeks(spark, out)


@query("select p_name || p_partkey as name, date '2008-01-01' + cast(p_partkey as int) as start, p_brand fuel, cast(p_size as double) price, round(p_size / 100.0, 4) rate from part where p_partkey % 2 = 0")
def src_11_policy_table(spark, sf):
    out = sinks.work_folder(spark, "policy")
    start = F.date_format(F.date_add(F.lit("2008-01-01").cast("date"), F.col("p_partkey").cast("int")), "yyyy-MM-dd")
    t = read(spark, sf, "part").select(F.concat("p_name", F.col("p_partkey").cast("string")).alias("정책명"), F.when(F.col("p_partkey") % 2 == 0, start).alias("시작일"), F.lit(None).cast("string").alias("종료일"), F.col("p_brand").alias("유종"), F.concat(F.lit("-"), F.col("p_size").cast("string")).alias("가격"), F.lit("0").alias("카테고리"))
    t.write.option("header", True).csv(out)
    return readers.read_policies(spark, out).select("name", "start", "fuel", (-F.col("price")).alias("price"), half_up("rate", 4).alias("rate"))


@query(f"with {STATION_SQL} select s_name as name, district address, 126.0 + station_id / 100.0 lon, 35.0::double lat from station")
def src_12_facilities(spark, sf):
    """SRC-12: facility headers in another spelling, ids by file order."""
    out = sinks.work_folder(spark, "facilities")
    t = stations(spark, sf).select(F.lit("항만").alias("구분"), F.col("s_name").alias("Name"), F.col("district").alias("주소"), (126.0 + F.col("station_id") / 100).cast("string").alias("LON"), F.lit("35.0").alias("위도"))
    t.write.option("header", True).csv(out)
    f = readers.read_facilities(spark, out)
    return f.where(F.col("facility_id").rlike("^F[0-9]{6,}$")).select("name", "address", "lon", "lat")


@query(f"with {DOM_SQL} select d, round(x, 3) x from dom")
def snk_01_parquet(spark, sf):
    out = sinks.work_folder(spark, "parquet")
    sinks.write_parquet(rounded(domestic(spark, sf).select("d", "x")), out)
    return spark.read.parquet(out)


@query(f"with {DOM_SQL} select d, round(x, 3) x from dom")
def snk_03_csv(spark, sf):
    out = sinks.work_folder(spark, "csv")
    sinks.write_csv(rounded(domestic(spark, sf).select("d", "x")), out)
    return spark.read.schema("d date, x double").option("header", True).csv(out)


def _events(spark, sf):
    """The events file as a stream, a price row for each event."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    s = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return s.select(F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("A"), F.col("user_id").cast("string")).alias("station_id"), F.concat(F.lit("G"), (F.col("user_id") % 25).cast("string")).alias("grid_id"), F.col("value").alias("price"), F.col("event_id").alias("seq"))


def _store(spark, stream, mode: str, name: str):
    """The stream's result as a table in the shared folder; a batch overwrites the folder of its own number, so one that runs again leaves no second copy."""
    out = sinks.work_folder(spark, name)
    q = stream.writeStream.outputMode(mode).foreachBatch(lambda b, k: b.write.mode("overwrite").parquet(f"{out}/batch={k}")).option("checkpointLocation", sinks.work_folder(spark, f"{name}-offsets")).trigger(availableNow=True).start()
    q.awaitTermination()
    t = spark.read.parquet(out)
    return t.where(F.col("batch") == t.agg(F.max("batch")).first()[0]).drop("batch") if mode == "complete" else t.drop("batch")


@query("select cast(ts as date) as date, 'G' || user_id % 25 grid_id, round(avg(value), 3) price, count(*) n from events group by all")
def stm_04_daily_grid(spark, sf):
    """Three deliveries of an append-mode job: the first half of the days; the rest with a closing event far behind them; and late rows for a day long
    written, which must change nothing."""
    e = read(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("G"), (F.col("user_id") % 25).cast("string")).alias("grid_id"), F.col("value").alias("price"))
    edge = e.agg(F.expr("timestamp_micros((unix_micros(min(ts)) + unix_micros(max(ts))) div 2)").alias("half"), F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    close = spark.range(1).select((F.lit(edge["last"]) + F.expr("interval 9 days")).alias("ts"), F.lit("closing").alias("grid_id"), F.lit(None).cast("double").alias("price"))
    late = spark.range(3).select(F.lit(edge["first"]).alias("ts"), F.lit("G0").alias("grid_id"), F.lit(1e9).alias("price"))
    folder, out, offsets = (sinks.work_folder(spark, n) for n in ("deliveries", "daily", "daily-offsets"))
    for delivery in (e.where(F.col("ts") < F.lit(edge["half"])), e.where(F.col("ts") >= F.lit(edge["half"])).unionByName(close), late):
        delivery.write.mode("append").parquet(folder)
        told = jobs.append_daily(spark, folder, e.schema, out, offsets)
    if not told["rows_dropped"] or told["state_rows"] > 25:
        raise RuntimeError(f"the watermark let late rows or closed days stay: {told}")
    return rounded(spark.read.parquet(out).drop("batch"))


@query("select distinct user_id % 25 as grid, cast(ts as date) as date from events")
def stm_06_no_redeliveries(spark, sf):
    s = _events(spark, sf).select(F.col("ts"), F.regexp_extract("grid_id", r"(\d+)", 1).cast("long").alias("grid"), F.to_date("ts").alias("date"))
    return _store(spark, jobs.without_redeliveries(s, keys=("grid", "date")).select("grid", "date"), "append", "unique")


_LAST_SQL = "l as (select cast(ts as date) as date, 'G' || user_id % 25 grid_id, arg_max(value, event_id) price from events group by all)"


def _state(spark, sf):
    s = _events(spark, sf).select(F.to_date("ts").alias("date"), "grid_id", "price", "seq")
    out = sinks.work_folder(spark, "state")
    jobs.keep_last_state(s, out, sinks.work_folder(spark, "state-offsets")).awaitTermination()
    return jobs.read_state(spark, out)


@query(f"with {_LAST_SQL} select date, grid_id, round(price, 3) price from l where date > (select max(date) from l) - 45")
def stm_02_rolling_state(spark, sf):
    """STM-01, STM-02, STM-03: the stream kept as a rolling table, last write wins."""
    return rounded(_state(spark, sf).drop("seq"))


@query(f"with {_LAST_SQL} select date, count(*) n from l group by 1")
def stm_01_incremental_ingest(spark, sf):
    """STM-01, STM-03: the same file delivered again adds no date and no key, so its batch changes nothing."""
    s = _events(spark, sf).select(F.to_date("ts").alias("date"), "grid_id", "price", "seq")
    out = sinks.work_folder(spark, "state")
    for delivery in ("first", "second"):
        jobs.keep_last_state(s, out, sinks.work_folder(spark, f"{delivery}-offsets")).awaitTermination()
    return spark.read.parquet(out).groupBy("date").agg(F.count("*").alias("n"))


@query(f"with {_LAST_SQL} select date, grid_id, round(price, 3) price from l")
def stm_03_skip_without_gain(spark, sf):
    """STM-03: a later delivery that only changes values of known keys is skipped where gain is asked for."""
    s = _events(spark, sf).select(F.to_date("ts").alias("date"), "grid_id", "price", "seq")
    out = sinks.work_folder(spark, "state")
    jobs.keep_last_state(s, out, sinks.work_folder(spark, "first-offsets")).awaitTermination()
    later = s.withColumn("price", F.col("price") + 1).withColumn("seq", F.col("seq") + 1_000_000_000)
    jobs.keep_last_state(later, out, sinks.work_folder(spark, "second-offsets"), skip_without_gain=True).awaitTermination()
    return rounded(spark.read.parquet(out).select("date", "grid_id", "price"))


@query(f"""with {_LAST_SQL}, s as (select * from l where date > (select max(date) from l) - 45), c as (select date, count(*) n from s group by 1), m as (select quantile_cont(n, 0.5) med from (select n from c order by date desc limit 14)), u as (select date from c, m where n >= 0.8 * med),
t as (select max(date) + 1 as top from u), p as (select max(date) - 3 as published from s),
f as (select date, grid_id, price, price - avg(price) over (partition by grid_id order by date rows between 6 preceding and current row) gap, case when lead(date) over w = date + 1 then lead(price) over w - price end delta from s window w as (partition by grid_id order by date)),
b as (select regr_intercept(delta, gap) b0, regr_slope(delta, gap) b1 from f)
select date + 1 as date, grid_id, round(price + b0 + b1 * gap, 3) prediction from f, t, p, b where date in (select date from u) and date + 1 between case when published <= top then published + 1 else top end and top""")
def stm_05_next_day(spark, sf):
    """A model learnt from the rolling state and stored predicts every date after the last published one, three days before the state ends."""
    state = _state(spark, sf)
    path = sinks.work_folder(spark, "next-day-model")
    jobs.fit_next_day(state, path)
    published = state.where(F.col("date") <= F.lit(state.agg(F.date_sub(F.max("date"), 3)).first()[0]))
    return rounded(jobs.next_day_prediction(state, published, path))
