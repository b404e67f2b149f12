"""Layered fair prices (ML-10): a weekly refinery model carried to days, a spread model on top, and the choice against the direct model."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairgrid.functions.dates import calendar_features, saturday_week
from fairgrid.operators.joins import as_of_join
from fairgrid.operators.models import rolling_huber
from fairgrid.operators.stored import cut
from fairgrid.operators.windows import pressure

#: History, least history and rows between fits of the daily and the weekly models; by how much two layers may be worse than the direct model.
DAILY = {"cap": 900, "least": 240, "refit": 7}
WEEKLY = {"cap": 260, "least": 80, "refit": 4}
ALLOWANCE = 1.15


def response_features(df: DataFrame, x: str, keys: list[str], order: str, weights: DataFrame, horizon: int, prefix: str) -> DataFrame:
    """WIN-08, WIN-09: ``x`` and its rises and falls summed over past rows with each series' response weights: prefix, prefix_rise, prefix_fall.

    ``weights`` (keys, weights): weights[h] is for h rows before, up to ``horizon``; a series without weights takes today's value alone. Missing
    values are skipped; a sum is null if all are missing.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    none = F.array(F.lit(1.0), *[F.lit(0.0)] * horizon)
    met = df.join(F.broadcast(weights.select(*keys, F.col("weights").alias("__w"))), keys, "left").withColumn("__w", F.coalesce("__w", none))
    step = F.col(x) - F.lag(x).over(w)
    met = met.withColumns({"__rise": F.when(step.isNotNull(), F.greatest(step, F.lit(0.0))), "__fall": F.when(step.isNotNull(), F.greatest(-step, F.lit(0.0)))})

    def dot(c: str) -> Column:
        terms = F.zip_with(F.array(*[F.lag(c, h).over(w) for h in range(horizon + 1)]), F.slice("__w", 1, horizon + 1), lambda v, k: v * k)
        return F.when(F.exists(terms, lambda v: v.isNotNull()), F.aggregate(terms, F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0))))

    return met.withColumns({prefix: dot(x), f"{prefix}_rise": dot("__rise"), f"{prefix}_fall": dot("__fall")}).drop("__w", "__rise", "__fall")


def weekly_frame(daily: DataFrame, refinery: DataFrame, keys: list[str], weights: DataFrame, horizon: int) -> tuple[DataFrame, list[str]]:
    """The refinery model's rows, one a week: week_end, refinery, excluded and regressors; and the names of these.

    ``daily`` (keys, d, intl, excluded), ``refinery`` (keys, week_end, refinery). A week takes the mean of its days and is excluded if one of them is.
    """
    weeks = daily.groupBy(*keys, saturday_week(F.col("d")).alias("week_end")).agg(F.avg("intl").alias("intl_w"), F.max("excluded").alias("excluded"))
    t = weeks.join(refinery, [*keys, "week_end"]).where("refinery is not null and intl_w is not null")
    t = response_features(t, "intl_w", keys, "week_end", weights, horizon, "irf")
    w = Window.partitionBy(*keys).orderBy("week_end")
    t = t.withColumn("step", F.col("intl_w") - F.lag("intl_w").over(w))
    spread = lambda n, least: F.when(F.count("step").over(w.rowsBetween(1 - n, 0)) >= least, F.stddev_samp("step").over(w.rowsBetween(1 - n, 0)))
    t = t.withColumns({"rise": F.greatest("step", F.lit(0.0)), "fall": F.greatest(-F.col("step"), F.lit(0.0)), "vol4": spread(4, 2), "vol8": spread(8, 3)})
    t = calendar_features(t, "week_end", tuple(keys))
    return t, ["irf", "irf_rise", "irf_fall", "step", "rise", "fall", "vol4", "vol8", "trend", *(f"month_{k}" for k in range(2, 13))]


def daily_frame(daily: DataFrame, keys: list[str], weights: DataFrame, horizon: int) -> tuple[DataFrame, list[str], list[str]]:
    """The daily models' rows: ``daily`` (keys, d, retail, intl, excluded) and regressors; the names of the direct model's, which are
    all response-weighted, and of the spread model's."""
    t = response_features(daily, "intl", keys, "d", weights, horizon, "irf")
    t = pressure(pressure(t, "irf", keys, "d"), "intl", keys, "d")
    t = calendar_features(t, "d", tuple(keys))
    fixed = ["trend", *(f"weekday_{k}" for k in range(1, 7)), *(f"month_{k}" for k in range(2, 13))]
    direct = ["irf", "irf_rise", "irf_fall", *(f"irf_{c}" for c in ("diff1", "diff7", "std7", "std14", "mean7", "mean30"))]
    spread = ["irf_rise", "irf_fall", *(f"intl_{c}" for c in ("diff1", "diff7", "std7", "std14"))]
    return t, direct + fixed, spread + fixed


@dataclass
class Layers:
    """``weekly`` (keys, week_end, refinery, fair_refinery, excluded), ``daily`` (keys, d, retail, excluded, direct, fair_refinery, two_layer, final), ``metrics`` (keys, model, clean_n, mae, median_ae, bias, chosen)."""

    weekly: DataFrame
    daily: DataFrame
    metrics: DataFrame


def layered_prices(daily: DataFrame, refinery: DataFrame, keys: list[str], daily_weights: DataFrame, weekly_weights: DataFrame, horizon: int = 30, weekly_horizon: int = 12, day: dict = DAILY, week: dict = WEEKLY, allowance: float = ALLOWANCE) -> Layers:
    """ML-10: three rolling robust fits. The refinery price by week; the retail price by day straight from the benchmark; and
    by day the retail price's distance from the refinery model's.

    A day takes the refinery model's value of the last week that ended before it, so nothing of its own week is looked ahead to. Excluded
    days and weeks teach nothing and are not scored. Two layers are chosen if their mean absolute error is at most ``allowance`` times
    the direct model's, or if only they have one.
    """
    weeks, weekly_xs = weekly_frame(daily, refinery, keys, weekly_weights, weekly_horizon)
    weeks = cut(weeks)
    told = rolling_huber(weeks.withColumn("eligible", ~F.col("excluded")), keys, "week_end", "refinery", weekly_xs, "eligible", **week)
    weekly = cut(weeks.select(*keys, "week_end", "refinery", "excluded").join(told.withColumnRenamed("prediction", "fair_refinery"), [*keys, "week_end"]))

    days, direct_xs, spread_xs = daily_frame(daily, keys, daily_weights, horizon)
    known = weekly.where("fair_refinery is not null").withColumn("from", F.date_add("week_end", 1))
    days = cut(as_of_join(days, known, keys, "d", "from", ["fair_refinery"]).withColumns({"eligible": ~F.col("excluded"), "spread": F.col("retail") - F.col("fair_refinery")}))
    direct = rolling_huber(days, keys, "d", "retail", direct_xs, "eligible", **day).withColumnRenamed("prediction", "direct")
    spread = rolling_huber(days, keys, "d", "spread", ["fair_refinery", *spread_xs], "eligible", **day).withColumnRenamed("prediction", "spread_fit")
    both = cut(days.select(*keys, "d", "retail", "excluded", "fair_refinery").join(direct, [*keys, "d"]).join(spread, [*keys, "d"]).withColumn("two_layer", F.col("fair_refinery") + F.col("spread_fit")))

    def errors(t: DataFrame, actual: str, fit: str, model: str) -> DataFrame:
        clean = t.where(~F.col("excluded")).withColumn("e", F.col(actual) - F.col(fit))
        return clean.groupBy(*keys).agg(F.lit(model).alias("model"), F.count("e").alias("clean_n"), F.avg(F.abs("e")).alias("mae"), F.percentile(F.abs("e"), F.lit(0.5)).alias("median_ae"), F.avg("e").alias("bias"))

    parts = [errors(weekly, "refinery", "fair_refinery", "refinery_weekly"), errors(both, "retail", "direct", "direct"), errors(both, "retail", "two_layer", "two_layer")]
    metrics = cut(reduce(lambda a, b: a.unionByName(b), parts))
    mae = lambda model: F.max(F.when(F.col("model") == model, F.col("mae")))
    choice = metrics.groupBy(*keys).agg(mae("direct").alias("__direct"), mae("two_layer").alias("__two"))
    two = F.col("__two").isNotNull() & (F.col("__direct").isNull() | (F.col("__two") <= allowance * F.col("__direct")))
    choice = choice.select(*keys, F.when(two, "two_layer").when(F.col("__direct").isNotNull(), "direct").alias("choice"))
    final = both.join(F.broadcast(choice), keys).withColumn("final", F.when(F.col("choice") == "two_layer", F.col("two_layer")).otherwise(F.col("direct")))
    scored = metrics.join(F.broadcast(choice), keys).withColumn("chosen", F.coalesce(F.col("model") == F.col("choice"), F.lit(False)))
    return Layers(weekly, final.select(*keys, "d", "retail", "excluded", "direct", "fair_refinery", "two_layer", "final"), scored.drop("choice"))
