"""Aggregates: both weighted means, error and band metrics, summaries (AGG-*)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairgrid.operators.stored import cut


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def mean_unmasked(x: str | Column, w: str | Column) -> Column:
    """AGG-04: Σxw / Σw; a missing x stays in the denominator."""
    return F.sum(_c(x) * _c(w)) / F.nullif(F.sum(_c(w)), F.lit(0.0))


def mean_masked(x: str | Column, w: str | Column) -> Column:
    """AGG-05: only rows with x and a positive w; without any, the plain mean."""
    ok = _c(x).isNotNull() & (_c(w) > 0)
    return F.coalesce(F.sum(F.when(ok, _c(x) * _c(w))) / F.nullif(F.sum(F.when(ok, _c(w))), F.lit(0.0)), F.avg(_c(x)))


def anchor(price: str | Column, count: str | Column) -> Column:
    """AGG-03: the count-weighted national mean over rows with a price and a positive count."""
    ok = (_c(price) > 0) & (_c(count) > 0)
    return F.sum(F.when(ok, _c(price) * _c(count))) / F.nullif(F.sum(F.when(ok, _c(count))), F.lit(0.0))


def error_metrics(actual: str | Column, predicted: str | Column, weight: str | Column | None = None) -> list[Column]:
    """AGG-19, AGG-22: rows, MAE, RMSE, bias, MAPE, R² and, with weights, weighted MAE and RMSE, in one pass."""
    y, e = _c(actual), _c(predicted) - _c(actual)
    out = [
        F.count(e).alias("rows"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"), (100 * F.avg(F.abs(e / F.nullif(y, F.lit(0.0))))).alias("mape"),
        (1 - F.sum(e * e) / F.nullif(F.sum(y * y) - F.sum(y) * F.sum(y) / F.count(y), F.lit(0.0))).alias("r2"),
    ]
    if weight is not None:
        w = _c(weight)
        out += [mean_masked(F.abs(e), w).alias("weighted_mae"), F.sqrt(mean_masked(e * e, w)).alias("weighted_rmse")]
    return out


def interval_score(actual: str | Column, low: str | Column, high: str | Column, coverage: float | Column) -> Column:
    """AGG-24: mean width plus 2/α times what lies outside, α being one less the coverage."""
    y, a, b = _c(actual), _c(low), _c(high)
    alpha = 1 - (F.lit(coverage) if isinstance(coverage, float) else coverage)
    return F.avg((b - a) + F.when(y < a, 2 / alpha * (a - y)).when(y > b, 2 / alpha * (y - b)).otherwise(0.0))


def _in_order(df: DataFrame, k: Column, x: Column) -> DataFrame:
    """(k, v, n, part): distinct values with their counts, in order over range partitions."""
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.select(k.alias("k"), x.alias("v")).where("v is not null").groupBy("k", "v").agg(F.count("*").alias("n"))
    return cut(counts.repartitionByRange(n_parts, "k", "v").withColumn("part", F.spark_partition_id()))


def values_at_ranks(df: DataFrame, keys: list[str], x: str | Column, ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """The keys, ``total`` and for each name the value at a rank (from 0) of the group's values in order, nulls left out.

    ``ranks`` gives a rank from the number of values. Values are counted first, then dealt over range partitions; the
    partitions' totals give each its first rank, and a running sum inside a partition the rest. So a group of any size is spread
    over tasks; only a row for each group and partition is gathered.
    """
    rows = _in_order(df, F.struct(*keys) if keys else F.struct(F.lit(0).alias("all")), _c(x))
    totals = rows.groupBy("k", "part").agg(F.sum("n").alias("m"))
    earlier = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("k", "part", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("off"), F.sum("m").over(Window.partitionBy("k")).alias("total"))
    inside = Window.partitionBy("part", "k").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("run", F.sum("n").over(inside)).join(offsets, ["k", "part"])
    hit = {name: rank(F.col("total")).between(F.col("off") + F.col("run") - F.col("n"), F.col("off") + F.col("run") - 1) for name, rank in ranks.items()}
    some = reduce(lambda a, b: a | b, hit.values())
    out = placed.where(some).groupBy("k").agg(F.first("total").alias("total"), *[F.max(F.when(h, F.col("v"))).alias(name) for name, h in hit.items()])
    return out.select(*[F.col(f"k.{c}").alias(c) for c in keys], "total", *ranks)


def exact_quantiles(df: DataFrame, keys: list[str], x: str | Column, shares: dict[str, float]) -> DataFrame:
    """The keys and exact quantiles by name, between two values by linear interpolation; groups without values give no row."""
    place = lambda q: lambda total: (total - 1) * F.lit(q)
    ranks = {f"{name}__{end}": (lambda total, q=q, cut_=cut_: cut_(place(q)(total))) for name, q in shares.items() for end, cut_ in (("lo", F.floor), ("hi", F.ceil))}
    at = values_at_ranks(df, keys, x, ranks)
    value = lambda name, q: F.col(f"{name}__lo") + (F.col(f"{name}__hi") - F.col(f"{name}__lo")) * (place(q)(F.col("total")) - F.floor(place(q)(F.col("total"))))
    return at.select(*keys, *[value(name, q).alias(name) for name, q in shares.items()])


def ordered_steps(df: DataFrame, x: str) -> DataFrame:
    """(step): the differences between neighbours of the sorted distinct values; a partition's first value looks to the greatest before it."""
    rows = _in_order(df, F.lit(0), F.col(x))
    before = F.max("top").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    edges = rows.groupBy("part").agg(F.max("v").alias("top")).select("part", before.alias("edge"))
    step = F.col("v") - F.coalesce(F.lag("v").over(Window.partitionBy("part").orderBy("v")), F.col("edge"))
    return rows.join(edges, "part").select(step.alias("step")).where("step is not null")


def profile(df: DataFrame, columns: list[str], percents=(0.10, 0.25, 0.50, 0.75, 0.90)) -> DataFrame:
    """AGG-21: count, mean, deviation, extremes and exact percentiles, a row for each column."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])).alias("s")).select("s.*")
    stats = long.groupBy("column").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
    return stats.join(exact_quantiles(long, ["column"], "v", {f"p{round(100 * q)}": q for q in percents}), "column", "left")


def mad_scale(df: DataFrame, keys: list[str], x: str) -> DataFrame:
    """NUM-10: 1.4826 times the median absolute deviation; the standard deviation where that is 0, and 1 where both are."""
    spread = df.groupBy(*keys).agg(F.stddev_samp(x).alias("std"))
    mid = spread.join(exact_quantiles(df, keys, x, {"median": 0.5}), keys, "left")
    away = exact_quantiles(df.join(mid, keys), keys, F.abs(F.col(x) - F.col("median")), {"mad": 0.5})
    scale = F.when(F.col("mad") > 0, 1.4826 * F.col("mad")).when(F.col("std") > 0, F.col("std")).otherwise(1.0)
    return mid.join(away, keys, "left").select(*keys, "median", scale.alias("scale"))


def completeness_gate(counts: DataFrame, date: str, ratio: float = 0.8, last: int = 14) -> DataFrame:
    """FLT-14: dates with at least ``ratio`` of the median row count of the last dates; ``counts`` is a row for each date."""
    recent = counts.orderBy(F.col(date).desc()).limit(last).agg(F.percentile("n", F.lit(0.5)).alias("median"))
    return counts.crossJoin(F.broadcast(recent)).withColumn("usable", F.col("n") >= ratio * F.col("median"))


def recentred(df: DataFrame, x: str, w: str, day: list[str]) -> DataFrame:
    """AGG-34: the day's weighted mean taken off."""
    p = Window.partitionBy(*day)
    return df.withColumn(x, F.col(x) - F.coalesce(F.sum(F.col(x) * F.col(w)).over(p) / F.nullif(F.sum(w).over(p), F.lit(0.0)), F.lit(0.0)))


def standard_scales(df: DataFrame, columns: list[str]) -> DataFrame:
    """AGG-35: mean and population deviation of each column; deviations up to 1e-6 become 1."""
    rows = [F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.when(F.stddev_pop(c) > 1e-6, F.stddev_pop(c)).otherwise(1.0).alias("std")) for c in columns]
    return df.agg(F.array(*rows).alias("s")).select(F.explode("s").alias("s")).select("s.*")
