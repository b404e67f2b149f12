"""Queries of the modelling operators (ML-01 to ML-14, WIN-20)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from fairgrid.functions.dates import saturday_week
from fairgrid.functions.numbers import BASE_TAX, half_up, judge, policy_shift
from fairgrid.functions.text import grid_id
from fairgrid.operators import aggregates as agg
from fairgrid.operators import delta, frames, joins, lagmodels, layers, models, windows
from fairgrid.operators.stored import cut, shared_dir
from fairgrid.sources import sinks

from .registry import query
from .tables import DOM_SQL, OBS_SQL, dealt, domestic, grid_day, observations, policies, read, stations


def _series(spark, sf):
    """Per fuel: the mean price of a day and the national order value of that day."""
    o = observations(spark, sf).groupBy("fuel", "d").agg(F.avg("price").alias("y"))
    return o.join(domestic(spark, sf).select("d", (F.col("x") / 1000).alias("x")), "d")


@query(f"""with {OBS_SQL}, {DOM_SQL}, o as (select fuel, d, avg(price) y from obs group by all), t as (select fuel, y, x / 1000 x from o join dom using (d))
select fuel, count(*) n, round(regr_intercept(y, x), 4) intercept, round(regr_slope(y, x), 4) slope, round(regr_r2(y, x), 6) r2 from t group by 1""")
def ml_01_regression(spark, sf):
    r = models.regressions(models.gram(_series(spark, sf), ["fuel"], ["x"], "y"), ["fuel"], 2)
    return r.select("fuel", "n", half_up(F.col("beta")[0], 4).alias("intercept"), half_up(F.col("beta")[1], 4).alias("slope"), half_up("r2", 6).alias("r2"))


def _changes(spark, sf):
    """Per fuel: daily changes (100 times the log) of the price and of the national order value, with the price itself."""
    t = windows.percent_change(_series(spark, sf), "y", ["fuel"], "d", name="dom")
    return windows.percent_change(t, "x", ["fuel"], "d", name="intl").select("fuel", "d", "dom", "intl", F.col("y").alias("level"))


@query()
def ml_01_dynamic_regression(spark, sf):
    """Daily changes on their own last two and the benchmark's last three, with weekday and month dummies: a row for each term."""
    design, xs = models.lag_design(_changes(spark, sf), ["fuel"], "d", "dom", "intl", 2, 3, dummies=True)
    r = models.regressions(models.gram(design, ["fuel"], xs, "dom"), ["fuel"], len(xs) + 1)
    names = F.array(*map(F.lit, ["const", *xs]))
    terms = r.select("fuel", "n", "r2", F.explode(F.arrays_zip(names.alias("term"), F.col("beta").alias("value"))).alias("t"))
    return terms.select("fuel", "n", half_up("r2", 6).alias("r2"), "t.term", half_up("t.value", 6).alias("beta"))


def _orders(spark, sf, max_p=60, max_q=60, train=1095):
    """All orders up to 60 own and 60 foreign lags of the change series, with weekday and month dummies; kept for as long as the tables stay the same."""
    search = lambda: lagmodels.order_search(_changes(spark, sf), ["fuel"], "d", "dom", "intl", "level", max_p, max_q, train)
    conditions = {"what": "order search", "max_p": max_p, "max_q": max_q, "train": train}
    return sinks.cached(spark, f"{shared_dir(spark)}/lag-orders", conditions, [f"{sf}/lineitem.parquet", f"{sf}/orders.parquet"], search)


@query()
def ml_02_order_search(spark, sf):
    """The finalists among 3,660 orders with their one-step forecasts' errors on changes and levels and their tests on the whole series, ranked."""
    return frames.rounded(_orders(spark, sf).drop("beta", "block_f", "full_f", "box_q", "hac_error"), 4)


@query()
def ml_02_screening_orders(spark, sf):
    """The smaller search of the screening stage: up to 8 own and 12 foreign lags."""
    return frames.rounded(_orders(spark, sf, 8, 12).select("fuel", "rank", "p", "q", "tried", "rule", "bic", "oos_rmse_chg", "oos_rmse_level", "full_stable", "box_p"), 4)


def _chosen(spark, sf):
    return _orders(spark, sf).where("rank = 1")


@query()
def ml_03_block_test(spark, sf):
    """The chosen order's foreign lags: F under the Newey-West covariance, F of the model without them against the whole one, and the first one's error."""
    t = _chosen(spark, sf)
    return t.select(
        "fuel", "p", "q", half_up("block_f", 4).alias("hac_f"), half_up("full_block_p", 6).alias("hac_p"), half_up("full_f", 4).alias("restricted_f"), half_up("full_p", 6).alias("restricted_p"), half_up("hac_error", 6).alias("hac_error")
    )


@query()
def ml_04_ljung_box(spark, sf):
    """Ljung-Box test of the chosen order's residuals, with the number of lags that its own lags and rows call for."""
    return _chosen(spark, sf).select("fuel", "p", F.col("q").alias("foreign"), "full_n", "box_lag", half_up("box_q", 4).alias("q"), half_up("box_p", 6).alias("p_value"))


@query()
def ml_05_stability(spark, sf):
    return _chosen(spark, sf).select("fuel", "p", F.col("full_stable").alias("stable"))


@query()
def ml_06_impulse_response(spark, sf):
    out = models.responses(_chosen(spark, sf), ["fuel"], 90).drop("irf", "weights")
    return frames.rounded(out, 4)


@query()
def ml_07_response_weights(spark, sf):
    t = models.responses(_chosen(spark, sf), ["fuel"], 90).select("fuel", F.posexplode("weights").alias("lag", "weight"))
    total = F.sum("weight").over(Window.partitionBy("fuel").orderBy("lag"))
    return t.select("fuel", "lag", half_up("weight", 6).alias("weight"), half_up(total, 6).alias("cumulative"))


@query()
def ml_08_stationarity(spark, sf):
    return frames.rounded(models.stationarity(_series(spark, sf), ["fuel"], "d", "y"), 4)


def _fair_frame(spark, sf):
    t = _series(spark, sf).withColumn("eligible", ~F.col("d").between(F.lit("1996-03-10").cast("date"), F.lit("1996-12-31").cast("date")))
    w = Window.partitionBy("fuel").orderBy("d")
    return t.withColumns({"x1": F.lag("x", 1).over(w), "x7": F.avg("x").over(w.rowsBetween(-7, -1)), "y1": F.lag("y", 1).over(w)})


@query()
def ml_09_rolling_huber(spark, sf):
    """Fair price of a day by the robust model of the last 900 clean days, fitted anew every 7 rows."""
    return frames.rounded(models.rolling_huber(_fair_frame(spark, sf), ["fuel"], "d", "y", ["x1", "x7"], "eligible"))


#: Weeks that the weekly search of lag orders learns from first.
_WEEKS = 104


def _refinery(spark, sf):
    """Per fuel and Saturday week: the mean price net of discounts, in the role of the refineries' supply price."""
    t = read(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("d"), F.when(F.col("l_linestatus") == "F", "gasoline").otherwise("diesel").alias("fuel"), (F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity")).alias("net"))
    return t.groupBy("fuel", saturday_week(F.col("d")).alias("week_end")).agg(F.avg("net").alias("refinery"))


def _weekly_weights(spark, sf, daily):
    """The response of the refinery price's weekly changes to the benchmark's, searched up to 8 own and 12 foreign lags."""
    weeks = daily.groupBy("fuel", saturday_week(F.col("d")).alias("week_end")).agg(F.avg("intl").alias("x")).join(_refinery(spark, sf), ["fuel", "week_end"])
    t = windows.percent_change(windows.percent_change(weeks, "refinery", ["fuel"], "week_end", name="dom"), "x", ["fuel"], "week_end", name="foreign")
    chosen = lagmodels.order_search(t, ["fuel"], "week_end", "dom", "foreign", "refinery", 8, 12, _WEEKS, dummies=False).where("rank = 1")
    return models.responses(chosen, ["fuel"], 12)


def _layers(spark, sf):
    excluded = F.col("d").between(F.lit("1996-03-10").cast("date"), F.lit("1996-12-31").cast("date"))
    daily = _series(spark, sf).select("fuel", "d", F.col("y").alias("retail"), F.col("x").alias("intl"), excluded.alias("excluded"))
    weights = models.responses(_chosen(spark, sf), ["fuel"], 30)
    return layers.layered_prices(daily, _refinery(spark, sf), ["fuel"], weights, _weekly_weights(spark, sf, daily))


@query()
def ml_10_model_choice(spark, sf):
    """Errors of the weekly refinery model, the direct and the two-layer retail model on clean rows, and which of the latter is chosen."""
    return frames.rounded(_layers(spark, sf).metrics)


@query()
def ml_10_layered_price(spark, sf):
    """Each day's fair price by the direct model, the refinery layer before it, the two layers together and the chosen model."""
    return frames.rounded(_layers(spark, sf).daily)


_FAIR_FRAME_SQL = f"""{OBS_SQL}, {DOM_SQL}, t as (select fuel, d, avg(price) y from obs group by all), s as (select fuel, d, y, x / 1000 x from t join dom using (d)),
f as (select fuel, d, y, lag(x) over (partition by fuel order by d) a, avg(x) over (partition by fuel order by d rows between 7 preceding and 1 preceding) b from s), g as (select *, a is not null ok from f),
r as (select fuel, d, a, b, ok, count(*) filter (where ok) over p n, sum(a) filter (where ok) over p sa, sum(b) filter (where ok) over p sb, sum(y) filter (where ok) over p sy, sum(a * a) filter (where ok) over p saa, sum(a * b) filter (where ok) over p sab,
 sum(b * b) filter (where ok) over p sbb, sum(a * y) filter (where ok) over p say, sum(b * y) filter (where ok) over p sby from g window p as (partition by fuel order by d rows between unbounded preceding and 1 preceding)),
c as (select *, saa - sa * sa / n aa, sab - sa * sb / n ab, sbb - sb * sb / n bb, say - sa * sy / n ay, sby - sb * sy / n by_ from r)"""


@query(f"with {_FAIR_FRAME_SQL} select fuel, d, case when ok and n >= 240 then round(sy / n + ((bb * ay - ab * by_) * (a - sa / n) + (aa * by_ - ab * ay) * (b - sb / n)) / (aa * bb - ab * ab), 1) end forecast from c")
def win_20_expanding_forecasts(spark, sf):
    return frames.rounded(models.expanding_forecasts(_fair_frame(spark, sf), ["fuel"], "d", "y", ["x1", "x7"], 240), 1)


def _model_frame(spark, sf):
    """Next-day change of a station's mean price with its last five levels; weight, and which rows validate."""
    t = dealt(observations(spark, sf).select("station_id", "d", "price", "w"), ["station_id"]).groupBy("station_id", "d").agg(F.avg("price").alias("y"), F.sum("w").alias("weight"))
    w = Window.partitionBy("station_id").orderBy("d")
    t = windows.lags(t, "y", range(1, 6), ["station_id"], "d").withColumn("delta", F.col("y") - F.col("y_lag1")).where("y_lag5 is not null")
    return t.withColumn("validation", F.col("d") >= F.lit("2000-01-01").cast("date"))


def _sequence_pieces(spark, sf):
    """Each fuel's and cell's series of price, national price and weight, in pieces; static features: place, stations, their mean balance.

    Observations are dealt by fuel and cell once, and days, series and pieces are made where they are; the national series has a row a day.
    """
    keys = ["fuel", "cell_x", "cell_y"]
    t = dealt(observations(spark, sf).select(*keys, "d", "price", "w"), keys).groupBy(*keys, "d").agg(F.avg("price").alias("y"), F.sum("w").alias("weight"))
    t = t.join(F.broadcast(t.groupBy("fuel", "d").agg(agg.anchor("y", "weight").alias("national"))), ["fuel", "d"])
    p = delta.series_pieces(t, keys, "d", ["y", "national", "weight"], [])
    sites = stations(spark, sf).groupBy("cell_x", "cell_y").agg(F.count("*").cast("double").alias("sites"), F.avg("s_acctbal").alias("balance"))
    sites = sites.withColumn("fuel", F.explode(F.array(*map(F.lit, BASE_TAX))))  # so that the pieces stay where they are
    p = p.join(sites, keys, "left").fillna(0.0, ["sites", "balance"])
    static = F.array(F.col("cell_x") / 1000, F.col("cell_y") / 1000, F.col("sites"), F.col("balance") / 1000)
    cell = grid_id(500, (F.col("cell_x") / 500).cast("int"), (F.col("cell_y") / 500).cast("int"))
    return p.select("fuel", cell.alias("grid_id"), static.alias("static"), "days", "months")


_SEQUENCE_KEYS = ["fuel", "grid_id"]


def _sequence_parts(batch, wanted):
    """Next-day change of a cell's mean price of a fuel with 28 days before it in three channels (own price, national price, weight), four latest
    features (distance from the national price, weight, days since, the month's mean) and four static ones.
    Levels count from yesterday's price. Rows from 2000 on stop the fit, those from July 2000 on are held out."""
    return delta.piece_parts(batch, wanted, date(2000, 1, 1), date(2000, 7, 1))


def _sequence_scores(pieces, months, model):
    return delta.piece_scores(pieces, _SEQUENCE_KEYS, months, model.stages[-1])


def _delta_models(spark, sf):
    """(fuel, model, rows, mae, rmse, weighted_mae, chosen, path, frame): the stored models of each fuel and the stored series, kept while the tables stay the same."""

    def build():
        frame, rows = sinks.work_folder(spark, "delta-series"), []
        _sequence_pieces(spark, sf).write.option("compression", "zstd").partitionBy("fuel").parquet(frame)
        for fuel in BASE_TAX:
            path = sinks.work_folder(spark, f"delta-model-{fuel}")
            pieces = spark.read.parquet(frame).where(F.col("fuel") == fuel).select("static", "days")
            rows += [(fuel, *told, path, frame) for told in delta.fit_delta_models(pieces, path, _sequence_parts)]
        return spark.createDataFrame(rows, "fuel string, model string, rows long, mae double, rmse double, weighted_mae double, chosen boolean, path string, frame string")

    tables = [f"{sf}/{t}.parquet" for t in ("lineitem", "supplier", "nation", "region")]
    return sinks.cached(spark, f"{shared_dir(spark)}/delta-models", {"what": "delta models", "frame": "series", "learners": "own"}, tables, build)


@query()
def ml_11_delta_model(spark, sf):
    """Errors on the holdout of each fuel's robust linear and boosted model, and which is chosen and stored."""
    return frames.rounded(_delta_models(spark, sf).drop("path", "frame"))


@query()
def ml_12_scoring(spark, sf):
    """Every cell's and day's prediction by its fuel's stored model, a month at a time; the first run stops half way, the second goes on from there."""
    chosen, out = _delta_models(spark, sf).where("chosen").collect(), sinks.work_folder(spark, "delta-scores")
    parts = []
    for r in chosen:  # a row a fuel
        to, keep = f"{out}/{r.fuel}", ["fuel", "grid_id", "d"]
        pieces = spark.read.parquet(r.frame).where(F.col("fuel") == r.fuel)
        half = pieces.withColumn("months", F.filter("months", lambda m: m < "1998-06"))
        delta.score_months(half, r.path, to, keep, scores_of=_sequence_scores)
        delta.score_months(pieces, r.path, to, keep, scores_of=_sequence_scores)
        parts.append(spark.read.parquet(to).drop("month"))
    return frames.rounded(parts[0].unionByName(parts[1]))


def national_fair(spark, sf):
    """(fuel, d, actual, prediction, shift, fair, low, high) of the nation: the rolling robust model, the band of its past residuals, then the day's policies.

    Days of a tax cut teach neither the model nor the band.
    """
    t = _fair_frame(spark, sf)
    days = {f: t.where(F.col("fuel") == f).select("d").distinct() for f in BASE_TAX}
    shifts = [
        joins.overlay(days[f], "d", policies(spark).where(F.col("fuel") == f), {0: "tax", 1: "cap"}).select(F.lit(f).alias("fuel"), "d", policy_shift(F.lit(tax), F.col("tax_rate")).alias("shift"))
        for f, tax in BASE_TAX.items()
    ]
    shift = frames.reduce(lambda a, b: a.unionByName(b), shifts)
    model = models.rolling_huber(t.join(shift, ["fuel", "d"]).withColumn("eligible", F.col("shift") == 0), ["fuel"], "d", "y", ["x1", "x7"], "eligible")
    p = t.select("fuel", "d", "y").join(model, ["fuel", "d"]).join(shift, ["fuel", "d"]).withColumn("residual", F.col("y") - F.col("prediction"))
    band = windows.residual_band(p, ["fuel"], "d", "residual", F.col("shift") == 0, 0.7)
    return band.select(
        "fuel", "d", F.col("y").alias("actual"), "prediction", "shift", (F.col("prediction") - F.col("shift")).alias("fair"),
        (F.col("prediction") + F.col("q_low") - F.col("shift")).alias("low"), (F.col("prediction") + F.col("q_high") - F.col("shift")).alias("high"),
    )


def grid_target(spark, sf):
    """(d, fuel, cell, price, n, w, spread, target, target_low, target_high): each cell's distance from the national anchor on top of the national fair price and band."""
    g = grid_day(spark, sf)
    anchor = g.groupBy("d", "fuel").agg(agg.anchor("price", "n").alias("anchor"))
    spread = F.col("price") - F.col("anchor")
    t = g.join(anchor, ["d", "fuel"]).join(national_fair(spark, sf).select("d", "fuel", "fair", "low", "high"), ["d", "fuel"])
    return t.withColumns({"spread": spread, "target": F.col("fair") + spread, "target_low": F.col("low") + spread, "target_high": F.col("high") + spread})


@query()
def fitted_region_price(spark, sf):
    """The whole model path in one query: features, rolling fit, band, policies, grid targets, then each region's day by fuel with its judgement."""
    t = grid_target(spark, sf).join(stations(spark, sf).select("cell_x", "cell_y", "region").distinct(), ["cell_x", "cell_y"]).where("target is not null")
    r = t.groupBy("d", "region", "fuel").agg(F.count("*").alias("grid_rows"), F.sum("w").alias("weight"), *[agg.mean_unmasked(c, "w").alias(n) for c, n in (("price", "actual"), ("target", "fair"), ("target_low", "low"), ("target_high", "high"))])
    r = r.withColumn("judgement", judge(F.col("actual"), F.col("fair"), F.col("low"), F.col("high"))).withColumn("gap", F.col("actual") - F.col("fair"))
    return frames.rounded(r)


_FRAME_SQL = f"""{OBS_SQL}, sd as (select station_id, d, avg(price) y, sum(w) weight from obs group by all), fr as (select *, lag(y, 1) over w y1, lag(y, 5) over w y5 from sd window w as (partition by station_id order by d)), f as (select *, y - y1 delta, d >= date '2000-01-01' validation from fr where y5 is not null)"""


@query(f"""with {_FRAME_SQL}, m as (select sum(delta * greatest(weight, 1)) / sum(greatest(weight, 1)) mean_delta from f where not validation)
select count(*) n, round(avg(abs(y - y1)), 3) yesterday_mae, round(sum(abs(y - y1) * weight) / sum(weight), 3) yesterday_weighted, round(sum(abs(y - y1 - mean_delta) * weight) / sum(weight), 3) drift_weighted from f, m where validation""")
def ml_13_baselines(spark, sf):
    t = _model_frame(spark, sf)
    w = F.greatest("weight", F.lit(1.0))
    mean = t.where("not validation").agg((F.sum(F.col("delta") * w) / F.sum(w)).alias("mean_delta"))
    v = t.where("validation").crossJoin(F.broadcast(mean))
    err = F.abs(F.col("y") - F.col("y_lag1"))
    return frames.rounded(v.agg(F.count("*").alias("n"), F.avg(err).alias("yesterday_mae"), agg.mean_masked(err, "weight").alias("yesterday_weighted"), agg.mean_masked(F.abs(F.col("delta") - F.col("mean_delta")), "weight").alias("drift_weighted")))


#: Rows of a training frame, chosen by key hash, for a caller that wants fewer; without it the frame is whole at any size.
_MAX_FINAL_ROWS: int | None = None


@query()
def ml_14_training_frame(spark, sf):
    """All training and validation rows and a hash sample of the gap between them."""
    t = _model_frame(spark, sf)
    gap = F.col("d").between(F.lit("1999-12-25").cast("date"), F.lit("1999-12-31").cast("date"))
    final = t.where(~gap | frames.in_hash_sample(["station_id", "d"], 200)).select("station_id", "d", half_up("delta", 3).alias("delta"))
    if _MAX_FINAL_ROWS is None:
        return final
    final = cut(final)
    return frames.fixed_sample(final, ["station_id", "d"], _MAX_FINAL_ROWS) if final.count() > _MAX_FINAL_ROWS else final
