"""Queries of the aggregates and of the data-quality rules (AGG-01 to AGG-35, NUM-05, NUM-09, NUM-10, DQ)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fairgrid.functions import numbers
from fairgrid.functions.dates import saturday_week
from fairgrid.operators import aggregates as agg
from fairgrid.operators import frames, joins, windows

from fairgrid.functions.numbers import half_up

from .registry import query
from .tables import DOM_SQL, GRID_SQL, INTL_SQL, OBS_SQL, POLICY_SQL, STATION_SQL, domestic, grid_day, international, observations, policies, read, stations

#: Per cell day: fair price is the region's mean; the band is 5 % around it.
_FAIR_SQL = f"""{OBS_SQL}, {STATION_SQL}, fairp as (select d, fuel, avg(price) fair from obs group by all),
j as (select obs.*, region, district, fair, fair * 0.95 low, fair * 1.05 high from obs join station using (station_id) join fairp using (d, fuel))"""


def _judged(spark, sf):
    o = observations(spark, sf)
    fair = o.groupBy("d", "fuel").agg(F.avg("price").alias("fair"))
    s = stations(spark, sf).select("station_id", "region", "district")
    return o.join(s, "station_id").join(fair, ["d", "fuel"]).withColumns({"low": F.col("fair") * 0.95, "high": F.col("fair") * 1.05})


@query(f"""with {_FAIR_SQL}, r as (select d, region, fuel, count(*) grid_rows, sum(w) weight, sum(price * w) / sum(w) actual, sum(fair * w) / sum(w) fair, sum(low * w) / sum(w) low, sum(high * w) / sum(w) high from j group by all)
select d, region, fuel, grid_rows, round(weight, 3) weight, round(actual, 3) actual, round(fair, 3) fair, round(actual - fair, 3) gap,
case when actual > high then 'expensive' when actual < low then 'cheap' else 'fair' end judgement from r""")
def region_fair_price(spark, sf):
    """The flagship: each region's day by fuel, its price against the national fair band."""
    r = _judged(spark, sf).groupBy("d", "region", "fuel").agg(F.count("*").alias("grid_rows"), F.sum("w").alias("weight"), *[agg.mean_unmasked(c, "w").alias(n) for c, n in (("price", "actual"), ("fair", "fair"), ("low", "low"), ("high", "high"))])
    gap = F.col("actual") - F.col("fair")
    return r.select("d", "region", "fuel", "grid_rows", half_up("weight", 3).alias("weight"), half_up("actual", 3).alias("actual"), half_up("fair", 3).alias("fair"), half_up(gap, 3).alias("gap"), numbers.judge(F.col("actual"), F.col("fair"), F.col("low"), F.col("high")).alias("judgement"))


@query(f"""with {OBS_SQL} select d, cell_x, cell_y, fuel, count(*) n, round(sum(price), 3) total, count(*) filter (where l_returnflag = 'A') n_self, round(sum(price) filter (where l_returnflag = 'A'), 3) total_self,
count(*) filter (where l_returnflag = 'N') n_full, round(avg(price), 3) mean from obs group by all""")
def agg_01_cell_day(spark, sf):
    """AGG-01, AGG-02: counts, sums and means by cell, day and service."""
    part = lambda k: F.when(F.col("l_returnflag") == k, F.col("price"))
    return observations(spark, sf).groupBy("d", "cell_x", "cell_y", "fuel").agg(F.count("*").alias("n"), half_up(F.sum("price"), 3).alias("total"), F.count(part("A")).alias("n_self"), half_up(F.sum(part("A")), 3).alias("total_self"), F.count(part("N")).alias("n_full"), half_up(F.sum("price") / F.count("price"), 3).alias("mean"))


@query(f"with {OBS_SQL} select d, cell_x, cell_y, round(avg(price), 3) mean, round(avg(price) filter (where l_returnflag = 'A'), 3) mean_self from obs group by all")
def agg_02_merged_means(spark, sf):
    """AGG-02: partial sums by station, merged by cell; a mean is null where nothing was counted."""
    part = lambda c, k: F.when(F.col("l_returnflag") == k, c)
    s = observations(spark, sf).groupBy("d", "station_id", "cell_x", "cell_y").agg(F.sum("price").alias("s"), F.count("price").alias("n"), F.sum(part(F.col("price"), "A")).alias("s_a"), F.count(part(F.col("price"), "A")).alias("n_a"))
    mean = lambda a, b: half_up(F.sum(a) / F.nullif(F.sum(b), F.lit(0)), 3)
    return s.groupBy("d", "cell_x", "cell_y").agg(mean("s", "n").alias("mean"), mean("s_a", "n_a").alias("mean_self"))


@query(f"with {GRID_SQL} select d, fuel, round(sum(price * n) / sum(n), 3) anchor from grid where price > 0 group by all")
def agg_03_national_anchor(spark, sf):
    return grid_day(spark, sf).groupBy("d", "fuel").agg(half_up(agg.anchor("price", "n"), 3).alias("anchor"))


_X = "case when l_linenumber = 2 then null else l_extendedprice end"


@query(f"select l_suppkey, round(sum({_X} * l_discount) / nullif(sum(l_discount), 0), 3) unmasked from lineitem group by 1")
def agg_04_mean_unmasked(spark, sf):
    return read(spark, sf, "lineitem").groupBy("l_suppkey").agg(half_up(agg.mean_unmasked(F.expr(_X), "l_discount"), 3).alias("unmasked"))


@query(f"select l_suppkey, round(coalesce(sum({_X} * l_discount) filter (where l_discount > 0) / nullif(sum(l_discount) filter (where l_discount > 0 and {_X} is not null), 0), avg({_X})), 3) masked from lineitem group by 1")
def agg_05_mean_masked(spark, sf):
    return read(spark, sf, "lineitem").groupBy("l_suppkey").agg(half_up(agg.mean_masked(F.expr(_X), "l_discount"), 3).alias("masked"))


@query(f"with {_FAIR_SQL} select d, fuel, count(*) n, round(sum(w), 3) weight, round(avg(price), 3) mean, round(sum(price * w) / sum(w), 3) weighted_mean, round(sum(abs(price - fair) * w) / sum(w), 3) weighted_mae from j group by all")
def agg_06_daily_summary(spark, sf):
    err = F.abs(F.col("price") - F.col("fair"))
    return _judged(spark, sf).groupBy("d", "fuel").agg(F.count("*").alias("n"), half_up(F.sum("w"), 3).alias("weight"), half_up(F.avg("price"), 3).alias("mean"), half_up(agg.mean_masked("price", "w"), 3).alias("weighted_mean"), half_up(agg.mean_masked(err, "w"), 3).alias("weighted_mae"))


@query(f"with {_FAIR_SQL} select cell_x, cell_y, count(distinct d) as days, min(region) region, round(avg(abs(price - fair)), 3) mae from j group by all order by mae desc")
def agg_07_grid_summary(spark, sf):
    return _judged(spark, sf).groupBy("cell_x", "cell_y").agg(F.count_distinct("d").alias("days"), F.min("region").alias("region"), half_up(F.avg(F.abs(F.col("price") - F.col("fair"))), 3).alias("mae")).orderBy(F.desc("mae"))


@query(f"""with {_FAIR_SQL} select d, fuel, case when region in ('ASIA', 'EUROPE') then region else '미분류' end region, round(sum(price * w) / sum(w), 3) actual, round(avg(price - fair), 3) mean_gap from j group by all""")
def agg_08_region_day(spark, sf):
    known = F.coalesce(F.when(F.col("region").isin("ASIA", "EUROPE"), F.col("region")), F.lit("미분류"))
    return _judged(spark, sf).groupBy("d", "fuel", known.alias("region")).agg(half_up(agg.mean_unmasked("price", "w"), 3).alias("actual"), half_up(F.avg(F.col("price") - F.col("fair")), 3).alias("mean_gap"))


@query(f"""with {_FAIR_SQL} select d, fuel, region, round(sum(price * w) / sum(w), 3) actual, count(*) n from j where region <> 'AFRICA' group by grouping sets ((d, fuel, region), (d, fuel))""")
def agg_09_national_rollup(spark, sf):
    """Regions and the nation by one grouping-sets aggregate; the unclassified region left out."""
    t = _judged(spark, sf).where("region <> 'AFRICA'").groupingSets([["d", "fuel", "region"], ["d", "fuel"]], "d", "fuel", "region")
    t = t.agg(agg.mean_unmasked("price", "w").alias("actual"), F.count("*").alias("n"))
    return frames.rounded(t)


@query(f"with {_FAIR_SQL} select region, district, fuel, round(sum(price * w) / sum(w), 3) actual, round(sum(w), 3) weight, count(distinct cell_x * 100000 + cell_y) grids from j group by all")
def agg_10_district_summary(spark, sf):
    return _judged(spark, sf).groupBy("region", "district", "fuel").agg(half_up(agg.mean_masked("price", "w"), 3).alias("actual"), half_up(F.sum("w"), 3).alias("weight"), F.count_distinct("cell_x", "cell_y").alias("grids"))


@query(f"with {OBS_SQL} select d, fuel, cell_x, cell_y, round(avg(price), 3) price, count(distinct station_id) stations from obs group by all")
def agg_11_station_to_grid(spark, sf):
    return observations(spark, sf).groupBy("d", "fuel", "cell_x", "cell_y").agg(half_up(F.avg("price"), 3).alias("price"), F.count_distinct("station_id").alias("stations"))


@query(f"with {INTL_SQL} select cast(d + cast(6 - dayofweek(d) as int) as date) week_end, round(avg(y), 3) week_mean, round(arg_max(y, d), 3) week_last from intl group by 1")
def agg_12_weekly(spark, sf):
    return frames.rounded(windows.weekly(international(spark, sf), [], "d", "y", saturday_week(F.col("d"))))


@query(f"with {OBS_SQL} select cast(d + cast(6 - dayofweek(d) as int) as date) week_end, max(cast(l_returnflag = 'R' as int)) flag from obs group by 1")
def agg_13_weekly_flag(spark, sf):
    return observations(spark, sf).groupBy(saturday_week(F.col("d")).alias("week_end")).agg(F.max((F.col("l_returnflag") == "R").cast("int")).alias("flag"))


_COUNTS_SQL = f"""{_FAIR_SQL}, {POLICY_SQL}, o as (select d, fuel, price, low, high, low - 30 low_p, high - 30 high_p, exists (select 1 from policies p where p.fuel = j.fuel and d between start and "end") policy from j)"""


def _counted(spark, sf):
    days = policies(spark).select("fuel", F.explode(F.sequence("start", "end")).alias("d")).distinct().withColumn("policy", F.lit(True))
    t = _judged(spark, sf).join(days, ["fuel", "d"], "left").withColumn("policy", F.coalesce("policy", F.lit(False)))
    return t.withColumns({"low_p": F.col("low") - 30, "high_p": F.col("high") - 30})


def _band_counts(low, high, tag):
    p = numbers.position(F.col("price"), F.col(low), F.col(high))
    return [F.count_if(p[k]).alias(f"{k}_{tag}") for k in ("inside", "above", "below")]


_C = lambda lo, hi, t: f"count(*) filter (where price between {lo} and {hi}) inside_{t}, count(*) filter (where price > {hi}) above_{t}, count(*) filter (where price < {lo}) below_{t}"


@query(f"with {_COUNTS_SQL}, c as (select fuel, {_C('low', 'high', 'before')}, {_C('low_p', 'high_p', 'after')} from o group by 1) select *, inside_after - inside_before inside_change from c")
def agg_14_band_counts(spark, sf):
    c = _counted(spark, sf).groupBy("fuel").agg(*_band_counts("low", "high", "before"), *_band_counts("low_p", "high_p", "after"))
    return c.withColumn("inside_change", F.col("inside_after") - F.col("inside_before"))


@query(f"with {_COUNTS_SQL} select fuel, cast(year(d) as int) \"year\", {_C('low', 'high', 'before')} from o group by rollup (fuel, \"year\")")
def agg_15_band_counts_by_year(spark, sf):
    return _counted(spark, sf).rollup("fuel", F.year("d").alias("year")).agg(*_band_counts("low", "high", "before"))


@query(f"with {_COUNTS_SQL} select 'all days' scope, fuel, {_C('low_p', 'high_p', 'after')} from o group by fuel union all select 'policy days', fuel, {_C('low_p', 'high_p', 'after')} from o where policy group by fuel")
def agg_16_band_counts_by_scope(spark, sf):
    scoped = _counted(spark, sf).withColumn("scope", F.explode(F.when(F.col("policy"), F.array(F.lit("all days"), F.lit("policy days"))).otherwise(F.array(F.lit("all days")))))
    return scoped.groupBy("scope", "fuel").agg(*_band_counts("low_p", "high_p", "after"))


@query(f"""with {OBS_SQL}, {POLICY_SQL} select name, min(d) first_day, max(d) last_day, count(distinct d) as days, round(avg(745.89 * rate * 1.1), 3) mean_effect from obs join policies p on p.fuel = obs.fuel and d between start and "end" where rate > 0 group by 1""")
def agg_17_policy_effect(spark, sf):
    days = policies(spark).where("rate > 0").select("name", "fuel", "rate", F.explode(F.sequence("start", "end")).alias("d"))
    t = observations(spark, sf).select("fuel", "d").distinct().join(days, ["fuel", "d"])
    return t.groupBy("name").agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"), F.count_distinct("d").alias("days"), half_up(F.avg(numbers.policy_shift(F.lit(numbers.BASE_TAX["gasoline"]), F.col("rate"))), 3).alias("mean_effect"))


@query(f"""with {DOM_SQL}, {POLICY_SQL}, m as (select min(d) a, max(d) b from dom) select name, cast(greatest(least("end", b) - greatest(start, a) + 1, 0) as int) overlap_days, case when "end" < a or start > b then 'outside' when rate > 0 then 'applied' else 'no effect' end status from policies, m""")
def agg_18_policy_overlap(spark, sf):
    m = domestic(spark, sf).agg(F.min("d").alias("a"), F.max("d").alias("b"))
    days = F.greatest(F.datediff(F.least("end", "b"), F.greatest("start", "a")) + 1, F.lit(0))
    return policies(spark).crossJoin(F.broadcast(m)).select("name", days.alias("overlap_days"), F.when((F.col("end") < F.col("a")) | (F.col("start") > F.col("b")), "outside").when(F.col("rate") > 0, "applied").otherwise("no effect").alias("status"))


_METRICS = "count(*) n, round(avg(abs(fair - price)), 3) mae, round(sqrt(avg((fair - price) ** 2)), 3) rmse, round(avg(fair - price), 3) bias, round(100 * avg(abs((fair - price) / price)), 3) mape"


@query(f"with {_FAIR_SQL} select cast(year(d) as int) \"year\", {_METRICS} from j group by 1")
def agg_19_yearly_errors(spark, sf):
    m = _judged(spark, sf).groupBy(F.year("d").alias("year")).agg(*agg.error_metrics("price", "fair"))
    return m.select("year", F.col("rows").alias("n"), *[half_up(c, 3).alias(c) for c in ("mae", "rmse", "bias", "mape")])


@query("select p_brand, count(*) tried, count(*) filter (where p_size > 10) ok, min(p_retailprice) lo, round(quantile_cont(p_retailprice, 0.5), 3) mid, max(p_retailprice) hi from part group by 1")
def agg_20_candidate_summary(spark, sf):
    t = read(spark, sf, "part")
    mid = agg.exact_quantiles(t, ["p_brand"], "p_retailprice", {"mid": 0.5})
    ends = t.groupBy("p_brand").agg(F.count("*").alias("tried"), F.count_if(F.col("p_size") > 10).alias("ok"), F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi"))
    return ends.join(mid, "p_brand", "left").withColumn("mid", half_up("mid", 3))


_PROFILE = " union all ".join(f"select '{c}' \"column\", count({c}) n, round(avg({c}), 3) mean, round(stddev_samp({c}), 3) std, round(min({c}), 3) \"min\", round(max({c}), 3) \"max\", round(quantile_cont({c}, 0.1), 3) p10, round(quantile_cont({c}, 0.25), 3) p25, round(quantile_cont({c}, 0.5), 3) p50, round(quantile_cont({c}, 0.75), 3) p75, round(quantile_cont({c}, 0.9), 3) p90 from lineitem" for c in ("l_quantity", "l_extendedprice"))


@query(_PROFILE)
def agg_21_profile(spark, sf):
    return frames.rounded(agg.profile(read(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"]))


@query(f"with {_FAIR_SQL} select fuel, {_METRICS}, round(1 - sum((fair - price) ** 2) / (sum(price * price) - sum(price) * sum(price) / count(*)), 3) r2, round(sum(abs(fair - price) * w) / sum(w), 3) weighted_mae, round(sqrt(sum((fair - price) ** 2 * w) / sum(w)), 3) weighted_rmse from j group by 1")
def agg_22_regression_metrics(spark, sf):
    m = _judged(spark, sf).groupBy("fuel").agg(*agg.error_metrics("price", "fair", "w"))
    return frames.rounded(m.withColumnRenamed("rows", "n"))


@query(f"with {DOM_SQL}, e as (select d, x - lag(x) over (order by d) r from dom), f as (select r, lag(r) over (order by d) s from e) select count(r) n, round(avg(abs(r)), 3) mae, round(quantile_cont(abs(r), 0.5), 3) median_ae, round(avg(r), 3) bias, round(corr(r, s), 4) autocorrelation from f")
def agg_23_clean_metrics(spark, sf):
    from pyspark.sql import Window

    w = Window.orderBy("d")
    e = domestic(spark, sf).withColumn("r", F.col("x") - F.lag("x").over(w)).withColumn("s", F.lag("r").over(w))
    return e.agg(F.count("r").alias("n"), half_up(F.avg(F.abs("r")), 3).alias("mae"), half_up(F.percentile(F.abs("r"), F.lit(0.5)), 3).alias("median_ae"), half_up(F.avg("r"), 3).alias("bias"), half_up(F.corr("r", "s"), 4).alias("autocorrelation"))


@query(f"with {_FAIR_SQL} select fuel, round(avg((high - low) + case when price < low then 2 / 0.3 * (low - price) when price > high then 2 / 0.3 * (price - high) else 0 end), 3) score, round(avg(cast(price between low and high as int)), 4) coverage from j group by 1")
def agg_24_interval_score(spark, sf):
    t = _judged(spark, sf)
    return t.groupBy("fuel").agg(half_up(agg.interval_score("price", "low", "high", 0.7), 3).alias("score"), half_up(F.avg(F.col("price").between(F.col("low"), F.col("high")).cast("int")), 4).alias("coverage"))


@query(f"with {OBS_SQL} select count(*) n, count(distinct cell_x * 100000 + cell_y) grids, min(d) first_day, max(d) last_day, count(*) filter (where fuel = 'diesel') diesel_rows, round(sum(price * w) / sum(w), 3) weighted_mean from obs")
def agg_25_dataset_summary(spark, sf):
    return observations(spark, sf).agg(F.count("*").alias("n"), F.count_distinct("cell_x", "cell_y").alias("grids"), F.min("d").alias("first_day"), F.max("d").alias("last_day"), F.count_if(F.col("fuel") == "diesel").alias("diesel_rows"), half_up(agg.mean_masked("price", "w"), 3).alias("weighted_mean"))


@query("select user_id, count(distinct value) coordinates, count(*) n, min(ts) first_ts from events where event_type = 'error' group by 1 having count(distinct value) > 1")
def agg_26_coordinate_conflicts(spark, sf):
    return read(spark, sf, "events").where("event_type = 'error'").groupBy("user_id").agg(F.count_distinct("value").alias("coordinates"), F.count("*").alias("n"), F.min("ts").alias("first_ts")).where("coordinates > 1")


@query(f"with {STATION_SQL} select cell_x, cell_y, count(*) filter (where station_id % 3 = 0) ports, count(*) filter (where station_id % 3 <> 0) depots from station group by all")
def agg_27_facility_counts(spark, sf):
    port = F.col("station_id") % 3 == 0
    return stations(spark, sf).groupBy("cell_x", "cell_y").agg(F.count_if(port).alias("ports"), F.count_if(~port).alias("depots"))


@query(f"with {STATION_SQL} select distinct cell_x, cell_y from station")
def agg_28_distinct_cells(spark, sf):
    return stations(spark, sf).select("cell_x", "cell_y").distinct()


@query(f"with {_FAIR_SQL}, t as (select region, fuel, d, round_even(avg(price), 1) price, count(*) n from j group by all) select region, fuel, max(d) d, arg_max(price, d) price, arg_max(n, d) latest_rows, sum(n)::bigint n, min(d) first_day from t group by all")
def agg_29_region_snapshot(spark, sf):
    t = _judged(spark, sf).groupBy("region", "fuel", "d").agg(F.bround(F.avg("price"), 1).alias("price"), F.count("*").alias("n"))
    return t.groupBy("region", "fuel").agg(F.max_by("price", "d").alias("price"), F.max_by("n", "d").alias("latest_rows"), F.sum("n").alias("n"), F.min("d").alias("first_day"), F.max("d").alias("d"))


@query(f"with {_FAIR_SQL} select region, count(distinct cell_x * 100000 + cell_y) grids, round(sum(w), 3) weight, round(sum(fair * w) / sum(w), 3) land_price, round(100 * avg(cast(cell_x > 3000 as int)), 3) island_percent from j group by 1")
def agg_30_region_status(spark, sf):
    return _judged(spark, sf).groupBy("region").agg(F.count_distinct("cell_x", "cell_y").alias("grids"), half_up(F.sum("w"), 3).alias("weight"), half_up(agg.mean_masked("fair", "w"), 3).alias("land_price"), half_up(100 * F.avg((F.col("cell_x") > 3000).cast("int")), 3).alias("island_percent"))


@query(f"""with {DOM_SQL}, {OBS_SQL} select 'orders' dataset, count(*) n, min(d) first_day, max(d) last_day, case when count(*) > 0 then 'connected' else 'waiting' end state from dom
union all select 'prices', count(*), min(d), max(d), case when count(*) > 0 then 'connected' else 'waiting' end from obs union all select 'future prices', count(*), min(d), max(d), case when count(*) > 0 then 'connected' else 'waiting' end from obs where d > date '2100-01-01'""")
def agg_31_dataset_catalogue(spark, sf):
    o = observations(spark, sf).select("d")
    parts = {"orders": domestic(spark, sf).select("d"), "prices": o, "future prices": o.where("d > date'2100-01-01'")}
    row = lambda k, t: t.agg(F.count("*").alias("n"), F.min("d").alias("first_day"), F.max("d").alias("last_day")).select(F.lit(k).alias("dataset"), "*", F.when(F.col("n") > 0, "connected").otherwise("waiting").alias("state"))
    return frames.reduce(lambda a, b: a.unionByName(b), [row(k, t) for k, t in parts.items()])


@query(f"with {_FAIR_SQL} select fuel, round(coalesce(quantile_cont(fair - low, 0.5), 10), 3) lower, round(coalesce(quantile_cont(high - fair, 0.5), 20), 3) upper from j group by 1")
def agg_32_band_offset(spark, sf):
    t = _judged(spark, sf).select("fuel", (F.col("fair") - F.col("low")).alias("below"), (F.col("high") - F.col("fair")).alias("above"))
    fuels = t.select("fuel").distinct()
    for name, c, other in (("lower", "below", 10.0), ("upper", "above", 20.0)):
        fuels = fuels.join(agg.exact_quantiles(t, ["fuel"], c, {name: 0.5}), "fuel", "left").withColumn(name, half_up(F.coalesce(name, F.lit(other)), 3))
    return fuels


@query("""with v as (select distinct p_retailprice v from part), s as (select v - lag(v) over (order by v) step from v), r as (select step, row_number() over (order by step) rn, count(*) over () n from s where step is not null)
select round(step, 3) step from r where rn = n // 2 + 1""")
def agg_33_median_step(spark, sf):
    steps = agg.ordered_steps(read(spark, sf, "part"), "p_retailprice")
    return agg.values_at_ranks(steps, [], "step", {"step": lambda n: F.floor(n / 2)}).select(half_up("step", 3).alias("step"))


@query(f"with {GRID_SQL}, a as (select d, fuel, sum(price * w) / sum(w) m from grid group by all) select grid.d, fuel, grid_id, round(price - m, 3) spread from grid join a using (d, fuel)")
def agg_34_spread_recentring(spark, sf):
    t = agg.recentred(grid_day(spark, sf).withColumn("spread", F.col("price")), "spread", "w", ["d", "fuel"])
    return t.select("d", "fuel", "grid_id", half_up("spread", 3).alias("spread"))


@query("select 'l_quantity' feature, round(avg(l_quantity), 4) mean, round(stddev_pop(l_quantity), 4) std from lineitem union all select 'l_tax', round(avg(l_tax), 4), round(stddev_pop(l_tax), 4) from lineitem union all select 'constant', 1.0, 1.0")
def agg_35_standard_scales(spark, sf):
    t = read(spark, sf, "lineitem").select("l_quantity", "l_tax", F.lit(1.0).alias("constant"))
    return frames.rounded(agg.standard_scales(t, ["l_quantity", "l_tax", "constant"]), 4)


_SHIFT = "case when tax_rate > 0 and tax_rate < 1 then 745.89 * tax_rate * 1.1 else 0 end"
_DAILY_POLICY_SQL = f"""{DOM_SQL}, {POLICY_SQL}, o as (select d, max(case when category = 0 then rate end) tax_rate, max(case when category = 1 then rate end) cap_rate from
 (select dom.d, category, rate, row_number() over (partition by dom.d, category order by start desc, "end" desc, name desc) rn from dom join policies p on p.fuel = 'gasoline' and dom.d between start and "end") where rn = 1 group by d),
 t as (select dom.d, x, tax_rate, cap_rate, {_SHIFT} shift from dom left join o using (d))"""


def _daily_policy(spark, sf):
    t = joins.overlay(domestic(spark, sf).select("d", "x"), "d", policies(spark).where("fuel = 'gasoline'"), {0: "tax", 1: "cap"})
    return t.withColumn("shift", numbers.policy_shift(F.lit(numbers.BASE_TAX["gasoline"]), F.col("tax_rate")))


@query(f"with {_DAILY_POLICY_SQL} select d, round(x - shift, 3) fair_policy, round(x * 0.9 - shift, 3) low_policy, round(x * 1.1 - shift, 3) high_policy, round(0 - shift, 3) effect from t")
def num_05_policy_prices(spark, sf):
    t = _daily_policy(spark, sf)
    return t.select("d", *[half_up(F.col("x") * k - F.col("shift"), 3).alias(n) for n, k in (("fair_policy", 1.0), ("low_policy", 0.9), ("high_policy", 1.1))], half_up(0 - F.col("shift"), 3).alias("effect"))


@query(f"with {_DAILY_POLICY_SQL} select d, round(745.89 - shift, 3) effective_tax, round(x / 1.1 - (745.89 - shift), 3) after_tax, coalesce(x > 150000 * (1 - cap_rate), false) breaches_cap from t")
def num_09_effective_tax(spark, sf):
    t = _daily_policy(spark, sf).withColumn("tax", numbers.BASE_TAX["gasoline"] - F.col("shift"))
    return t.select("d", half_up("tax", 3).alias("effective_tax"), half_up(numbers.pretax(F.col("x"), F.col("tax")), 3).alias("after_tax"), F.coalesce(F.col("x") > 150000 * (1 - F.col("cap_rate")), F.lit(False)).alias("breaches_cap"))


@query("""with m as (select event_type, quantile_cont(value, 0.5) median, stddev_samp(value) std from events group by 1), a as (select event_type, median, std, quantile_cont(abs(value - median), 0.5) mad from events join m using (event_type) group by all)
select event_type, round(median, 4) median, round(case when mad > 0 then 1.4826 * mad when std > 0 then std else 1 end, 4) scale from a""")
def num_10_mad_scale(spark, sf):
    return frames.rounded(agg.mad_scale(read(spark, sf, "events"), ["event_type"], "value"), 4)


@query(f"with {DOM_SQL}, {INTL_SQL} select 'domestic' dataset, count(*) n, min(d) first_day, max(d) last_day, count(*) >= 1000 ready from dom union all select 'international', count(*), min(d), max(d), count(*) >= 1000 from intl")
def dq_01_input_readiness(spark, sf):
    row = lambda k, t: t.agg(F.count("*").alias("n"), F.min("d").alias("first_day"), F.max("d").alias("last_day")).select(F.lit(k).alias("dataset"), "*", (F.col("n") >= 1000).alias("ready"))
    return row("domestic", domestic(spark, sf).select("d")).union(row("international", international(spark, sf).select("d")))


@query("select 'value' \"column\", count(*) n, count(*) filter (where event_id % 50 = 0) unparsable, min(case when event_id % 50 <> 0 then value end) lo, max(case when event_id % 50 <> 0 then value end) hi from events")
def dq_02_shape_validators(spark, sf):
    raw = F.when(F.col("event_id") % 50 == 0, "n/a").otherwise(F.col("value").cast("string"))
    t = read(spark, sf, "events").select(raw.alias("raw"), numbers.parse_number(raw).alias("x"))
    return t.agg(F.count("*").alias("n"), F.count_if(F.col("raw").isNotNull() & F.col("x").isNull()).alias("unparsable"), F.min("x").alias("lo"), F.max("x").alias("hi")).select(F.lit("value").alias("column"), "*")


@query(f"with {_FAIR_SQL} select count(*) n, count(price) n_price, round(max(abs(price - fair)), 3) worst, count(*) filter (where low > high) crossed from j")
def dq_03_prediction_check(spark, sf):
    t = _judged(spark, sf)
    return t.agg(F.count("*").alias("n"), F.count("price").alias("n_price"), half_up(F.max(F.abs(F.col("price") - F.col("fair"))), 3).alias("worst"), F.count_if(F.col("low") > F.col("high")).alias("crossed"))


@query(f"with {GRID_SQL}, p as (select t.d, f.d fd from grid t join grid f on t.fuel = f.fuel and t.grid_id = f.grid_id and f.d = t.d - 1) select count(*) n, count(*) filter (where d - fd <> 1) wrong_horizon, count(*) filter (where year(d) > 2001) test_rows from p")
def dq_04_frame_assertions(spark, sf):
    g = grid_day(spark, sf).select("d", "fuel", "grid_id")
    p = g.join(g.select(F.date_add("d", 1).alias("d"), "fuel", "grid_id", F.col("d").alias("fd")), ["d", "fuel", "grid_id"])
    return p.agg(F.count("*").alias("n"), F.count_if(F.datediff("d", "fd") != 1).alias("wrong_horizon"), F.count_if(F.year("d") > 2001).alias("test_rows"))


@query(f"with {_DAILY_POLICY_SQL} select d, tax_rate, round(shift, 3) shift from t where d in (select start from policies) or month(d) = 7 and day(d) = 1")
def dq_05_policy_audit(spark, sf):
    starts = policies(spark).select(F.col("start").alias("d"), F.lit(True).alias("audit")).distinct()
    t = _daily_policy(spark, sf).join(F.broadcast(starts), "d", "left").where("audit or month(d) = 7 and day(d) = 1")
    return t.select("d", "tax_rate", half_up("shift", 3).alias("shift"))


@query(f"with {_FAIR_SQL} select region, count(distinct fuel) fuels, min(d) first_day, max(d) last_day, count(distinct station_id) stations, count(distinct fuel) = 2 ok from j group by 1")
def dq_06_region_output(spark, sf):
    t = _judged(spark, sf).groupBy("region").agg(F.count_distinct("fuel").alias("fuels"), F.min("d").alias("first_day"), F.max("d").alias("last_day"), F.count_distinct("station_id").alias("stations"))
    return t.withColumn("ok", F.col("fuels") == 2)
