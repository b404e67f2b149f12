"""Queries of projection, filters, reshaping, sorting, de-duplication and sets (PRJ, FLT, RSH, SRT, DED, SET)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairgrid.functions import numbers
from fairgrid.operators import aggregates as agg
from fairgrid.operators import frames

from fairgrid.functions.numbers import half_up

from .registry import query
from .tables import DOM_SQL, GRID_SQL, INTL_SQL, OBS_SQL, POLICY_SQL, STATION_SQL, domestic, grid_day, international, observations, policies, read, stations


@query("select o_orderkey order_id, o_totalprice price, o_orderpriority from orders")
def prj_01_header_aliases(spark, sf):
    t = read(spark, sf, "orders").select(F.col("o_orderkey").alias("o_order key"), F.col("o_totalprice").alias("o_totalprice (krw)"), "o_orderpriority")
    return frames.rename(t, {"o_orderkey": "order_id", "o_totalpricekrw": "price"})


@query(f"with {DOM_SQL} select d, round(x, 3) gasoline_x, n gasoline_n from dom")
def prj_02_prefixed_columns(spark, sf):
    return frames.rounded(frames.prefixed(domestic(spark, sf), "gasoline_", ("d",)))


@query("select cast(s_suppkey as int) station_id, cast(null as varchar) brand, round(s_acctbal, 2) balance from (select s_suppkey, s_acctbal from supplier)")
def prj_03_fixed_schema(spark, sf):
    t = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("station_id"), F.col("s_acctbal").alias("balance"), "s_name")
    return frames.rounded(frames.to_schema(t, T.StructType([T.StructField("station_id", T.IntegerType()), T.StructField("brand", T.StringType()), T.StructField("balance", T.DoubleType())])), 2)


@query(f"""with {GRID_SQL}, a as (select d, fuel, sum(price * n) / sum(n) anchor from grid group by all)
select g.d, fuel, grid_id, round(price - anchor, 3) spread, round(1500 + price - anchor, 3) target, case when n > 1 then round(1450 + price - anchor, 3) end target_low from grid g join a using (d, fuel)""")
def prj_04_guarded_targets(spark, sf):
    g = grid_day(spark, sf)
    a = g.groupBy("d", "fuel").agg(agg.anchor("price", "n").alias("anchor"))
    valid = F.col("price").isNotNull() & F.col("anchor").isNotNull()
    spread = F.when(valid, F.col("price") - F.col("anchor"))
    return g.join(a, ["d", "fuel"]).select("d", "fuel", "grid_id", half_up(spread, 3).alias("spread"), half_up(F.when(valid, 1500 + spread), 3).alias("target"), half_up(F.when(valid & (F.col("n") > 1), 1450 + spread), 3).alias("target_low"))


@query(f"""with {DOM_SQL}, t as (select d, x, lag(x) over (order by d) y from dom)
select d, round(y + 10, 3) prediction, round(x - 50 + (y + 10 - x), 3) low, round(x + 50 + (y + 10 - x), 3) high from t""")
def prj_05_delta_to_level(spark, sf):
    from pyspark.sql import Window

    t = domestic(spark, sf).withColumn("y", F.lag("x").over(Window.orderBy("d"))).withColumn("prediction", F.col("y") + 10.0)
    shift = F.col("prediction") - F.col("x")
    return t.select("d", half_up("prediction", 3).alias("prediction"), half_up(F.col("x") - 50 + shift, 3).alias("low"), half_up(F.col("x") + 50 + shift, 3).alias("high"))


@query("select o_orderkey, round_even(o_totalprice, 1) price, o_custkey from (select o_orderkey, round(o_totalprice * 4, 0) / 4 o_totalprice, o_custkey from orders)")
def prj_06_half_even_rounding(spark, sf):
    t = read(spark, sf, "orders").select("o_orderkey", (half_up(F.col("o_totalprice") * 4, 0) / 4).alias("price"), "o_custkey")
    return frames.rounded(t, 1, half_even=True)


@query(f"with {OBS_SQL} select d, station_id, fuel, round(price, 3) price from obs where d between date '1996-01-01' and date '1996-12-31'")
def flt_01_date_range(spark, sf):
    o = observations(spark, sf)
    return o.where(frames.within(F.col("d"), F.lit("1996-01-01").cast("date"), F.lit("1996-12-31").cast("date"))).select("d", "station_id", "fuel", half_up("price", 3).alias("price"))


@query(f"""with {OBS_SQL}, t as (select station_id, fuel, d, max(price) price from obs where d <= date '1999-06-30' group by all)
select station_id, fuel, max(d) d, round(arg_max(price, d), 3) price, (select max(d) from t p where p.station_id = t.station_id and p.fuel = t.fuel and p.d < max(t.d)) previous_day from t group by station_id, fuel""")
def flt_02_as_of_filter(spark, sf):
    t = observations(spark, sf).where("d <= date'1999-06-30'").groupBy("station_id", "fuel", "d").agg(F.max("price").alias("price"))
    top = t.groupBy("station_id", "fuel").agg(F.slice(F.sort_array(F.collect_list("d"), asc=False), 1, 2).alias("days"), F.max_by("price", "d").alias("price"))
    return top.select("station_id", "fuel", F.col("days")[0].alias("d"), half_up("price", 3).alias("price"), F.try_element_at("days", F.lit(2)).alias("previous_day"))


@query(f"""with {DOM_SQL}, {POLICY_SQL}, r as (select distinct start - 14 a, "end" + 30 b from policies where category = 0)
select d, exists (select 1 from r where d between a and b) excluded from dom""")
def flt_04_exclusion_mask(spark, sf):
    """Ranges are exploded to days, so the mask is an equi-join with a distinct day list."""
    days = policies(spark).where("category = 0").select(F.explode(F.sequence(F.date_sub("start", 14), F.date_add("end", 30))).alias("d")).distinct().withColumn("hit", F.lit(True))
    return domestic(spark, sf).join(days, "d", "left").select("d", F.coalesce("hit", F.lit(False)).alias("excluded"))


#: Dated ranges from the given tables: of each customer the days from the first to the last order of a priority; an urgent one has no end yet.
_RANGE_SQL = """ranges as (select o_custkey || ' ' || o_orderpriority as name, cast(min(o_orderdate) as date) as start, case when o_orderpriority <> '1-URGENT' then cast(max(o_orderdate) as date) end as "end" from orders group by o_custkey, o_orderpriority)"""


def _ranges(spark, sf):
    last = F.when(F.col("o_orderpriority") != "1-URGENT", F.to_date(F.max("o_orderdate")))
    by = read(spark, sf, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.to_date(F.min("o_orderdate")).alias("start"), last.alias("end"))
    return by.select(F.concat_ws(" ", F.col("o_custkey").cast("string"), "o_orderpriority").alias("name"), "start", "end")


@query(f"""with {_RANGE_SQL}, w as (select name, start - 7 a, "end" + 7 b from ranges)
select name, cast(a + cast(6 - dayofweek(a) as int) as date) first_week, cast(b + cast(6 - dayofweek(b) as int) as date) last_week from w""")
def flt_05_widen_to_weeks(spark, sf):
    from fairgrid.functions.dates import saturday_week

    return _ranges(spark, sf).select("name", saturday_week(F.date_sub("start", 7)).alias("first_week"), saturday_week(F.date_add("end", 7)).alias("last_week"))


@query(f"with {OBS_SQL} select fuel, count(*) n from obs where d between date '1996-03-10' and date '1996-12-31' or d between date '2000-01-01' and date '2000-06-30' group by 1")
def flt_06_policy_membership(spark, sf):
    ranges = [("1996-03-10", "1996-12-31"), ("2000-01-01", "2000-06-30")]
    test = F.lit(False)
    for a, b in ranges:
        test = test | F.col("d").between(F.lit(a).cast("date"), F.lit(b).cast("date"))
    return observations(spark, sf).where(test).groupBy("fuel").agg(F.count("*").alias("n"))


@query()
def flt_08_hash_sample(spark, sf):
    """A fifth of all cell days by key hash; the rows follow this engine's hash, so only the rate and repeatability are checked."""
    return frames.hash_sample(grid_day(spark, sf), ["grid_id", "d"], 200, 7).select("d", "fuel", "grid_id", half_up("price", 3).alias("price"))


@query()
def flt_09_fixed_sample(spark, sf):
    return frames.fixed_sample(grid_day(spark, sf).select("d", "fuel", "grid_id"), ["grid_id", "d", "fuel"], 500)


@query(f"with {STATION_SQL} select station_id, s_name, district from station where contains(lower(s_name || ' ' || district || ' ' || region), 'nation_1')")
def flt_10_text_search(spark, sf):
    return stations(spark, sf).where(F.lower(F.concat_ws(" ", "s_name", "district", "region")).contains("nation_1")).select("station_id", "s_name", "district")


@query(f"with {GRID_SQL} select d, fuel, grid_id, round(price, 3) price from grid where fuel = 'diesel' and cell_x = 500 and d between date '1998-01-01' and date '1998-12-31'")
def flt_11_download_filter(spark, sf):
    return grid_day(spark, sf).where("fuel = 'diesel' and cell_x = 500 and d between date'1998-01-01' and date'1998-12-31'").select("d", "fuel", "grid_id", half_up("price", 3).alias("price"))


@query("select l_orderkey, l_linenumber, round(l_extendedprice - 50000, 2) price from lineitem where l_extendedprice - 50000 > 0")
def flt_12_price_sanity(spark, sf):
    t = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", numbers.parse_number((F.col("l_extendedprice") - 50000).cast("string")).alias("price"))
    return t.where("price > 0").withColumn("price", half_up("price", 2))


@query(f"with {_RANGE_SQL} select name from ranges where (start is null or start <= date '1996-11-15') and (\"end\" is null or \"end\" >= date '1996-11-15')")
def flt_13_policies_in_force(spark, sf):
    d = F.lit("1996-11-15").cast("date")
    return _ranges(spark, sf).where(frames.within(d, F.col("start"), F.col("end"))).select("name")


@query(f"""with {GRID_SQL}, c as (select d, count(*) n from grid group by 1), m as (select quantile_cont(n, 0.5) median from (select n from c order by d desc limit 14))
select d, n, n >= 0.8 * median usable from c, m""")
def flt_14_completeness_gate(spark, sf):
    return agg.completeness_gate(grid_day(spark, sf).groupBy("d").agg(F.count("*").alias("n")), "d").select("d", "n", "usable")


_KINDS = ("view", "signup", "error", "click", "purchase")
_WIDE = "select cast(ts as date) d, " + ", ".join(f"max(case when event_type = '{k}' then value end) \"{k}\"" for k in _KINDS) + " from events group by 1"


@query(f"with w as ({_WIDE}), u as (" + " union all ".join(f"select d, '{k}' station_id, \"{k}\" price from w" for k in _KINDS) + ") select * from u where price is not null")
def rsh_01_wide_to_long(spark, sf):
    wide = read(spark, sf, "events").groupBy(F.to_date("ts").alias("d")).pivot("event_type", list(_KINDS)).agg(F.max("value"))
    return frames.melt(wide, ["d"], list(_KINDS), "station_id", "price")


@query("select cast(ts as date) d, " + ", ".join(f"arg_max(value, ts) filter (where event_type = '{k}' and value is not null) \"{k}\"" for k in _KINDS) + " from events group by 1")
def rsh_02_long_to_wide(spark, sf):
    t = read(spark, sf, "events").withColumn("d", F.to_date("ts"))
    return frames.pivot_last(t, "d", "event_type", list(_KINDS), "value", F.col("ts"))


@query("select user_id, event_type, count(*) n, max(ts) last_ts, arg_max(value, ts) last_value from events where event_type in ('view', 'click') group by all")
def rsh_03_nested_events(spark, sf):
    """Lists of (time, value) for each user and field, exploded again; the latest entry of each."""
    nested = read(spark, sf, "events").where("event_type in ('view', 'click')").groupBy("user_id", "event_type").agg(F.collect_list(F.struct("ts", "value")).alias("history"))
    rows = nested.select("user_id", "event_type", F.explode("history").alias("h"))
    return rows.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.max("h.ts").alias("last_ts"), F.max_by("h.value", "h.ts").alias("last_value"))


@query(f"""with {GRID_SQL}, t as (select d, fuel, avg(price) actual_price, sum(n) stations from grid group by all)
select d, fuel, 'actual_price' metric, round(actual_price, 3) "value" from t union all select d, fuel, 'stations', round(cast(stations as double), 3) from t""")
def rsh_04_metric_melt(spark, sf):
    t = grid_day(spark, sf).groupBy("d", "fuel").agg(F.avg("price").alias("actual_price"), F.sum("n").cast("double").alias("stations"))
    return frames.rounded(t.select("d", "fuel", F.expr("stack(2, 'actual_price', actual_price, 'stations', stations) as (metric, value)")))


@query(f"""with {OBS_SQL}, {STATION_SQL}, t as (select region, fuel, avg(price) p, count(*) n from obs join station using (station_id) group by all)
select region, round(max(case when fuel = 'gasoline' then p end), 3) gasoline_price, max(case when fuel = 'gasoline' then n end) gasoline_n, round(max(case when fuel = 'diesel' then p end), 3) diesel_price, max(case when fuel = 'diesel' then n end) diesel_n from t group by 1""")
def rsh_05_nested_by_fuel(spark, sf):
    t = observations(spark, sf).join(stations(spark, sf), "station_id").groupBy("region", "fuel").agg(F.avg("price").alias("p"), F.count("*").alias("n"))
    m = t.groupBy("region").agg(F.map_from_entries(F.collect_list(F.struct("fuel", F.struct("p", "n")))).alias("fuels"))
    return m.select("region", *[x for k in ("gasoline", "diesel") for x in (half_up(F.try_element_at("fuels", F.lit(k))["p"], 3).alias(f"{k}_price"), F.try_element_at("fuels", F.lit(k))["n"].alias(f"{k}_n"))])


@query("select o_orderkey, o_orderpriority, o_totalprice from orders order by o_orderpriority, o_totalprice desc nulls last, o_orderkey")
def srt_01_mixed_sort(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy(F.asc_nulls_last("o_orderpriority"), F.desc_nulls_last("o_totalprice"), "o_orderkey")


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100")
def srt_02_top_rows(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("""with t as (select p_brand, p_partkey, p_size, p_retailprice, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) a, row_number() over (partition by p_brand order by p_size, p_partkey) b from part)
select p_brand, p_partkey from t where a <= 3 or b <= 3""")
def srt_03_two_shortlists(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("p_brand")
    t = read(spark, sf, "part").withColumn("a", F.row_number().over(w.orderBy(F.desc("p_retailprice"), "p_partkey"))).withColumn("b", F.row_number().over(w.orderBy("p_size", "p_partkey")))
    return t.where("a <= 3").select("p_brand", "p_partkey").union(t.where("b <= 3").select("p_brand", "p_partkey")).dropDuplicates()


@query("select s_suppkey, s_name, case when s_suppkey % 7 = 0 then null else s_acctbal end price from supplier order by price nulls last, s_name")
def srt_04_price_list(spark, sf):
    return read(spark, sf, "supplier").select("s_suppkey", "s_name", F.when(F.col("s_suppkey") % 7 != 0, F.col("s_acctbal")).alias("price")).orderBy(F.asc_nulls_last("price"), "s_name")


@query(f"with {OBS_SQL}, t as (select *, row_number() over (partition by station_id, fuel, d order by ok desc, ln desc, price desc) rn from obs) select station_id, fuel, d, ok, ln, round(price, 3) price from t where rn = 1")
def ded_01_last_per_key(spark, sf):
    t = frames.last_per_key(observations(spark, sf), ["station_id", "fuel", "d"], [F.col("ok"), F.col("ln"), F.col("price")])
    return t.select("station_id", "fuel", "d", "ok", "ln", half_up("price", 3).alias("price"))


@query("""with t as (select event_id, user_id, cast(ts as date) d, event_type, case when event_type = 'error' then null else value end value, case when event_id % 3 = 0 then null else props end props, ts from events),
r as (select *, row_number() over (partition by user_id, d order by (value is not null)::int + (props is not null)::int desc, ts desc) rn from t) select user_id, d, event_id, value, props from r where rn = 1""")
def ded_02_richest_row(spark, sf):
    t = read(spark, sf, "events").select("event_id", "user_id", F.to_date("ts").alias("d"), F.when(F.col("event_type") != "error", F.col("value")).alias("value"), F.when(F.col("event_id") % 3 != 0, F.col("props")).alias("props"), "ts")
    return frames.richest_per_key(t, ["user_id", "d"], ["value", "props"], F.col("ts")).select("user_id", "d", "event_id", "value", "props")


@query("select user_id, event_type, min(ts) ts, arg_min(event_id, ts) event_id from events group by all")
def ded_03_first_per_key(spark, sf):
    return frames.first_per_key(read(spark, sf, "events"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "ts", "event_id")


@query(f"with {DOM_SQL}, {INTL_SQL} select 'domestic' series, d, round(x, 3) v from dom union all select 'international', d, round(y, 3) from intl")
def set_01_union_all(spark, sf):
    a = domestic(spark, sf).select(F.lit("domestic").alias("series"), "d", half_up("x", 3).alias("v"))
    return a.unionByName(international(spark, sf).select(F.lit("international").alias("series"), "d", half_up("y", 3).alias("v")))


@query(f"with {STATION_SQL}, {GRID_SQL} select cell_x, cell_y from station union select cell_x + 500, cell_y from grid")
def set_02_union_distinct(spark, sf):
    return stations(spark, sf).select("cell_x", "cell_y").union(grid_day(spark, sf).select(F.col("cell_x") + 500, "cell_y")).distinct()


@query(f"with {STATION_SQL} select cell_x, cell_y, 'only land' kind from (select cell_x, cell_y from station except select cell_x + 500, cell_y from station) union all select cell_x, cell_y, 'both' from (select cell_x, cell_y from station intersect select cell_x + 500, cell_y from station)")
def set_03_except_intersect(spark, sf):
    land = stations(spark, sf).select("cell_x", "cell_y").distinct()
    patch = land.select((F.col("cell_x") + 500).alias("cell_x"), "cell_y")
    only = land.join(patch, ["cell_x", "cell_y"], "left_anti").withColumn("kind", F.lit("only land"))
    return only.union(land.intersect(patch).withColumn("kind", F.lit("both")))


@query(f"""with {DOM_SQL}, {INTL_SQL}, u as (select d, y v, 0 p from intl union all select d, x, 1 from dom where dayofweek(d) = 1 union all select d, -1.0, 2 from dom where month(d) = 2),
r as (select *, row_number() over (partition by d order by p desc) rn from u) select d, round(v, 3) v, p from r where rn = 1""")
def set_04_priority_union(spark, sf):
    dom = domestic(spark, sf)
    parts = [international(spark, sf).select("d", F.col("y").alias("v"), F.lit(0).alias("p")), dom.where("dayofweek(d) = 2").select("d", F.col("x").alias("v"), F.lit(1).alias("p")), dom.where("month(d) = 2").select("d", F.lit(-1.0).alias("v"), F.lit(2).alias("p"))]
    return frames.rounded(frames.priority_union(parts, ["d"]))


@query(f"with {DOM_SQL} select d, round(x, 3) x from dom where d > (select max(d) from dom) - interval 3 year")
def set_05_retention(spark, sf):
    d = domestic(spark, sf)
    return d.crossJoin(F.broadcast(d.agg(F.max("d").alias("top")))).where("d > add_months(top, -36)").select("d", half_up("x", 3).alias("x"))


@query(f"with {DOM_SQL}, {INTL_SQL}, m as (select max(d) - 100 top from intl) select d, 'dom' source from dom, m where d <= top union all select d, 'intl' from intl")
def set_06_drop_newer(spark, sf):
    top = international(spark, sf).agg(F.date_sub(F.max("d"), 100).alias("top"))
    both = domestic(spark, sf).select("d", F.lit("dom").alias("source")).union(international(spark, sf).select("d", F.lit("intl")))
    return both.crossJoin(F.broadcast(top)).where("not (source = 'dom' and d > top)").select("d", "source")
