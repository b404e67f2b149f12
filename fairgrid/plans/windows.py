"""Queries of the window operators (WIN-01 to WIN-21)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fairgrid.functions import dates
from fairgrid.operators import aggregates as agg
from fairgrid.operators import frames, windows
from fairgrid.operators.stored import cut

from fairgrid.functions.numbers import half_up

from .registry import ORACLE_SQL, query
from .tables import DOM_SQL, GRID_SQL, INTL_SQL, OBS_SQL, dealt, domestic, grid_day, international, observations, read

_SPINE = "s as (select cast(unnest(generate_series(cast(min(d) as timestamp), cast(max(d) as timestamp), interval 1 day)) as date) d from dom)"
_STATION_DAY = f"{OBS_SQL}, sd as (select station_id, d, avg(price) x, max(cast(d between date '1996-03-10' and date '1996-12-31' as int)) = 1 policy from obs group by all)"


def _station_day(spark, sf):
    """A station's days with their mean price; observations are dealt by station once, and days and windows are made where they are."""
    t = dealt(observations(spark, sf).select("station_id", "d", "price"), ["station_id"]).groupBy("station_id", "d").agg(F.avg("price").alias("x"))
    return t.withColumn("policy", F.col("d").between(F.lit("1996-03-10").cast("date"), F.lit("1996-12-31").cast("date")))


@query(f"with {DOM_SQL}, {_SPINE}, t as (select s.d, case when isodow(s.d) < 6 then x end x from s left join dom using (d)) select d, round(last_value(x ignore nulls) over (order by d rows unbounded preceding), 3) x from t")
def win_01_forward_fill(spark, sf):
    t = dates.spine_of(domestic(spark, sf), "d").join(domestic(spark, sf), "d", "left").withColumn("x", F.when(F.weekday("d") < 5, F.col("x")))
    return frames.rounded(frames.forward_fill(t.select("d", "x"), ["x"], "d"))


@query(f"with {_STATION_DAY} select station_id, d, round(lag(x, 1) over w, 3) x_lag1, round(lag(x, 2) over w, 3) x_lag2, round(lag(x, 3) over w, 3) x_lag3 from sd window w as (partition by station_id order by d)")
def win_02_lags(spark, sf):
    return frames.rounded(windows.lags(_station_day(spark, sf), "x", range(1, 4), ["station_id"], "d").drop("x", "policy"))


_QUALITY_SQL = f"""{_STATION_DAY}, q as (select station_id, d, count(x) over f history_rows, coalesce(sum(cast(policy as int)) over f, 0)::bigint policy_days, cast(d - lag(d, 29) over (partition by station_id order by d) as int) span_days from sd window f as (partition by station_id order by d rows between 29 preceding and 1 preceding))"""


@query(f"with {_QUALITY_SQL} select station_id, d, history_rows, policy_days, span_days from q")
def win_03_lookback(spark, sf):
    """WIN-03, WIN-04, WIN-05: counts, policy days and calendar span of the 29-row look-back, over one window."""
    return windows.lookback_quality(_station_day(spark, sf), ["station_id"], "d", "x", "policy").select("station_id", "d", "history_rows", "policy_days", "span_days")


@query(f"with {_QUALITY_SQL} select station_id, d, policy_days from q where policy_days > 0")
def win_04_policy_days(spark, sf):
    return windows.lookback_quality(_station_day(spark, sf), ["station_id"], "d", "x", "policy").where("policy_days > 0").select("station_id", "d", "policy_days")


@query(f"with {_QUALITY_SQL} select station_id, d, span_days, span_days = 29 whole from q where span_days is not null")
def win_05_calendar_span(spark, sf):
    """Days that the 29 rows before a row span, and whether none is missing between."""
    q = windows.lookback_quality(_station_day(spark, sf), ["station_id"], "d", "x", "policy")
    return q.where("span_days is not null").select("station_id", "d", "span_days", (F.col("span_days") == 29).alias("whole"))


@query(f"""with {DOM_SQL}, t as (select 'national' k, d, x, d between date '1996-03-10' and date '1996-12-31' policy from dom), q as (select d, count(x) over f n, sum(cast(policy as int)) over f p, d - lag(d, 29) over (order by d) span from t window f as (order by d rows between 29 preceding and 1 preceding)) select d from q where n = 29 and p = 0 and span = 29""")
def flt_07_sequence_quality(spark, sf):
    t = domestic(spark, sf).withColumn("k", F.lit("national")).withColumn("policy", F.col("d").between(F.lit("1996-03-10").cast("date"), F.lit("1996-12-31").cast("date")))
    return windows.lookback_quality(t, ["k"], "d", "x", "policy").where("usable").select("d")


_STEPS = 28
_LAGS_SQL = ", ".join(f"round(lag(x, {k}) over w, 3) lag{k}" + (f", round(lag(x, {k}) over w - lag(x, {k + 1}) over w, 3) delta{k}" if k < _STEPS else "") for k in range(1, _STEPS + 1))


@query(f"with {_STATION_DAY}, t as (select station_id, d, {_LAGS_SQL} from sd window w as (partition by station_id order by d)) select * from t where lag{_STEPS} is not null")
def win_06_lag_differences(spark, sf):
    """Levels and differences are rounded once a row and then looked up, all over one window."""
    w = Window.partitionBy("station_id").orderBy("d")
    t = _station_day(spark, sf).select("station_id", "d", half_up("x", 3).alias("r"), half_up(F.col("x") - F.lag("x").over(w), 3).alias("s"))
    levels = [F.lag("r", k).over(w).alias(f"lag{k}") for k in range(1, _STEPS + 1)]
    return t.select("station_id", "d", *levels, *[F.lag("s", k).over(w).alias(f"delta{k}") for k in range(1, _STEPS)]).where(f"lag{_STEPS} is not null")


@query(f"with {_STATION_DAY}, t as (select station_id, d, count(*) over w n, round(avg(x) over w, 3) mean, policy from sd window w as (partition by station_id order by d rows between 28 preceding and 1 preceding)) select station_id, d, mean from t where n = 28")
def rsh_06_sequence_tensor(spark, sf):
    """28 steps of two channels, oldest first; checked by its mean."""
    t = _station_day(spark, sf).withColumn("p", F.col("policy").cast("double"))
    s = windows.lag_sequence(t, ["x", "p"], 28, ["station_id"], "d").where("sequence is not null")
    return s.select("station_id", "d", half_up(F.aggregate("sequence", F.lit(0.0), lambda a, v: a + v[0]) / 28, 3).alias("mean"))


@query(f"with {_STATION_DAY}, t as (select station_id, d, d - lag(d, 28) over (partition by station_id order by d) span, count(x) over (partition by station_id order by d rows between 28 preceding and 1 preceding) n from sd) select station_id, d + 1 target_date, cast(span as int) span from t where n = 28")
def win_07_operational_variant(spark, sf):
    t = windows.lookback_quality(_station_day(spark, sf), ["station_id"], "d", "x", "policy", rows=28)
    return t.where("history_rows = 28").select("station_id", F.date_add("d", 1).alias("target_date"), F.col("span_days").alias("span"))


@query(f"""with {INTL_SQL}, t as (select d, case when day(d) = 3 then null else y end y, row_number() over (order by d) rn from intl), l as (select a.d, sum(b.y * case a.rn - b.rn when 0 then 0.5 when 1 then 0.3 else 0.2 end) v from t a join t b on a.rn - b.rn between 0 and 2 group by 1) select d, round(v, 3) v from l""")
def win_08_weighted_lags(spark, sf):
    t = international(spark, sf).withColumn("y", F.when(F.dayofmonth("d") != 3, F.col("y"))).withColumn("series", F.lit("national"))
    return windows.weighted_lags(t, "y", [0.5, 0.3, 0.2], ["series"], "d", "v").select("d", half_up("v", 3).alias("v"))


@query(f"""with {_STATION_DAY}, t as (select station_id, d, x - 1000 x from sd) select station_id, d, round(greatest(x, 0), 3) x_up, round(least(x, 0), 3) x_down, round(x - lag(x) over w, 3) x_diff1, round(x - lag(x, 7) over w, 3) x_diff7,
round(case when count(x) over r7 >= 4 then stddev_samp(x) over r7 end, 3) x_std7, round(case when count(x) over r30 >= 15 then avg(x) over r30 end, 3) x_mean30 from t
window w as (partition by station_id order by d), r7 as (partition by station_id order by d rows between 6 preceding and current row), r30 as (partition by station_id order by d rows between 29 preceding and current row)""")
def win_09_pressure(spark, sf):
    t = _station_day(spark, sf).select("station_id", "d", (F.col("x") - 1000).alias("x"))
    return frames.rounded(windows.pressure(t, "x", ["station_id"], "d").select("station_id", "d", "x_up", "x_down", "x_diff1", "x_diff7", "x_std7", "x_mean30"))


@query(f"""with {INTL_SQL}, k as (select cast(d + cast(6 - dayofweek(d) as int) as date) w, avg(y) y from intl group by 1) select w, round(case when count(*) over a >= 3 then stddev_samp(y) over a end, 3) vol4, round(case when count(*) over b >= 5 then stddev_samp(y) over b end, 3) vol8 from k
window a as (order by w rows between 3 preceding and current row), b as (order by w rows between 7 preceding and current row)""")
def win_10_weekly_volatility(spark, sf):
    k = windows.weekly(international(spark, sf), [], "d", "y", dates.saturday_week(F.col("d")))
    roll = lambda n, least: F.when(F.count("week_mean").over(Window.orderBy("week_end").rowsBetween(-(n - 1), 0)) >= least, F.stddev_samp("week_mean").over(Window.orderBy("week_end").rowsBetween(-(n - 1), 0)))
    return k.select(F.col("week_end").alias("w"), half_up(roll(4, 3), 3).alias("vol4"), half_up(roll(8, 5), 3).alias("vol8"))


@query(f"""with {DOM_SQL}, {_SPINE}, t as (select s.d, last_value(x ignore nulls) over (order by s.d rows unbounded preceding) x from s left join dom using (d)), e as (select d, case when d between date '1996-03-10' and date '1996-12-31' then null else x end x from t)
select d, round(100 * (ln(x) - ln(lag(x) over (order by d))), 4) change from e""")
def win_11_log_change(spark, sf):
    t = dates.spine_of(domestic(spark, sf), "d").join(domestic(spark, sf).select("d", "x"), "d", "left").withColumn("series", F.lit("national"))
    t = frames.forward_fill(t, ["x"], "d", ("series",))
    out = windows.percent_change(t, "x", ["series"], "d", F.col("d").between(F.lit("1996-03-10").cast("date"), F.lit("1996-12-31").cast("date")))
    return out.select("d", half_up("change", 4).alias("change"))


@query("with t as (select p_brand, p_partkey, p_retailprice, row_number() over (partition by p_brand order by p_retailprice desc nulls last, p_partkey) rn from part) select p_brand, p_partkey, rn from t where rn <= 20")
def win_12_top_per_group(spark, sf):
    w = Window.partitionBy("p_brand").orderBy(F.desc_nulls_last("p_retailprice"), "p_partkey")
    return read(spark, sf, "part").withColumn("rn", F.row_number().over(w)).where("rn <= 20").select("p_brand", "p_partkey", F.col("rn").cast("long").alias("rn"))


@query("select user_id, event_type, max(ts) ts, arg_max(value, ts) value from events group by all")
def win_13_latest_per_key(spark, sf):
    return frames.latest_per_key(read(spark, sf, "events").select("user_id", "event_type", "ts", "value"), ["user_id", "event_type"], "ts")


@query("""with t as (select o_custkey, cast(o_orderdate as date) d, arg_max(o_orderpriority, o_orderkey) p from orders group by all), k as (select *, lag(p) over (partition by o_custkey order by d) q, row_number() over (partition by o_custkey order by d) rn from t),
c as (select o_custkey, d, p from k where rn = 1 or p is distinct from q) select o_custkey, d, p, lead(d) over (partition by o_custkey order by d) valid_to from c""")
def win_14_change_history(spark, sf):
    t = read(spark, sf, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("d")).agg(F.max_by("o_orderpriority", "o_orderkey").alias("p"))
    return frames.change_history(t, ["o_custkey"], "d", "p")


@query(ORACLE_SQL["win_14_change_history"])
def win_14_appended_history(spark, sf):
    """The same history from three deliveries out of order, each merged into what is stored."""
    t = cut(read(spark, sf, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("d")).agg(F.max_by("o_orderpriority", "o_orderkey").alias("p")))
    part = F.pmod(F.xxhash64("d"), F.lit(3))
    history = t.limit(0).select("o_custkey", "d", "p", F.col("d").alias("valid_to"), F.array("d").alias("seen"))
    for k in (2, 0, 1):
        history = cut(frames.append_changes(history, t.where(part == k), ["o_custkey"], "d", "p"))
    return history.drop("seen")


@query(f"with {GRID_SQL}, c as (select d, count(*) n from grid group by 1), r as (select d, sum(n) over (order by d) cum, sum(n) over () total from c) select min(d) train_end, min(d) + 8 validation_start from r where cum >= floor(0.7 * total)")
def win_15_time_split(spark, sf):
    return windows.time_split(grid_day(spark, sf).groupBy("d").agg(F.count("*").alias("n")), "d")


@query(f"""with {_STATION_DAY}, t as (select station_id, d, case when x > 1600 then 'over' when x < 1400 then 'under' else 'normal' end tone from sd), m as (select *, case when tone is distinct from lag(tone) over (partition by station_id order by d) then 1 else 0 end s from t),
r as (select *, sum(s) over (partition by station_id order by d) g from m) select station_id, tone, min(d) "start", max(d) "end", count(*) "rows" from r group by station_id, tone, g""")
def win_16_islands(spark, sf):
    tone = F.when(F.col("x") > 1600, "over").when(F.col("x") < 1400, "under").otherwise("normal")
    return frames.islands(_station_day(spark, sf), ["station_id"], "d", tone)


@query(f"with {_STATION_DAY} select station_id, d, round(x - lag(x) over (partition by station_id order by d), 3) delta from sd")
def win_17_daily_delta(spark, sf):
    w = Window.partitionBy("station_id").orderBy("d")
    return _station_day(spark, sf).select("station_id", "d", half_up(F.col("x") - F.lag("x").over(w), 3).alias("delta"))


_BAND_SQL = f"""{_STATION_DAY}, t as (select station_id, d, x - 1500 r, day(d) <> 5 ok from sd), n as (select *, coalesce(sum(cast(ok as int)) over (partition by station_id order by d rows between unbounded preceding and 1 preceding), 0) seen, row_number() over (partition by station_id order by d) rn from t),
f as (select *, min(case when seen >= 120 then rn end) over (partition by station_id) f0 from n), k as (select *, case when rn >= f0 then (rn - f0) // 7 end slot from f),
b as (select a.station_id, a.slot, quantile_cont(p.r, 0.15) q_low, quantile_cont(p.r, 0.85) q_high from k a join k p on p.station_id = a.station_id and p.ok and p.seen < a.seen and p.seen >= a.seen - 1200 where a.slot is not null and (a.rn - a.f0) % 7 = 0 group by all)"""


@query(f"with {_BAND_SQL} select k.station_id, d, round(q_low, 3) q_low, round(q_high, 3) q_high from k left join b using (station_id, slot)")
def win_18_residual_band(spark, sf):
    t = _station_day(spark, sf).select("station_id", "d", (F.col("x") - 1500).alias("r"))
    out = windows.residual_band(t, ["station_id"], "d", "r", F.dayofmonth("d") != 5, 0.7)
    return frames.rounded(out.select("station_id", "d", "q_low", "q_high"))


@query(f"""with {_STATION_DAY}, c(coverage) as (values (0.55::double), (0.6::double), (0.65::double), (0.7::double), (0.75::double), (0.8::double)), e as (select station_id, coverage, avg(cast(x between 1500 - 700 * coverage and 1500 + 700 * coverage as int)) hit, avg(1400 * coverage + case when x < 1500 - 700 * coverage then 2 / (1 - coverage) * (1500 - 700 * coverage - x) when x > 1500 + 700 * coverage then 2 / (1 - coverage) * (x - 1500 - 700 * coverage) else 0 end) score from sd, c group by all),
r as (select *, row_number() over (partition by station_id order by hit < 0.6, score, coverage) rn from e) select station_id, coverage, round(hit, 4) hit, round(score, 3) score from r where rn = 1""")
def win_19_band_choice(spark, sf):
    """Of several coverages that which covers enough, then scores best."""
    half = 700 * F.col("coverage")
    t = _station_day(spark, sf).withColumn("coverage", F.explode(F.array(*map(F.lit, (0.55, 0.6, 0.65, 0.7, 0.75, 0.8))))).withColumns({"low": 1500 - half, "high": 1500 + half})
    e = t.groupBy("station_id", "coverage").agg(F.avg(F.col("x").between(F.col("low"), F.col("high")).cast("int")).alias("hit"), agg.interval_score("x", "low", "high", F.col("coverage")).alias("score"))
    best = e.withColumn("rn", F.row_number().over(Window.partitionBy("station_id").orderBy(F.col("hit") < 0.6, "score", "coverage"))).where("rn = 1")
    return best.select("station_id", "coverage", half_up("hit", 4).alias("hit"), half_up("score", 3).alias("score"))


@query(f"with {INTL_SQL}, t as (select d, y, row_number() over (order by d) rn from intl where day(d) <= 7 and isodow(d) = 6) select cast(date '2008-05-10' + cast(7 * (rn - 1) as int) as date) week_end, round(y, 3) y from t")
def win_21_week_renumbering(spark, sf):
    t = international(spark, sf).where("day(d) <= 7 and weekday(d) = 5")
    rn = F.row_number().over(Window.orderBy("d"))
    return t.select(F.date_add(F.lit("2008-05-10").cast("date"), 7 * (rn - 1)).alias("week_end"), half_up("y", 3).alias("y"))
