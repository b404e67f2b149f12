"""Window operators: lags, pressure, look-back quality, changes, residual bands (WIN-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HISTORY = 29


def lags(df: DataFrame, column: str, ks: range, keys: list[str], order: str, prefix: str | None = None) -> DataFrame:
    """WIN-02: row-based lags, all over one window."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumns({f"{prefix or column}_lag{k}": F.lag(column, k).over(w) for k in ks})


def lookback_quality(df: DataFrame, keys: list[str], order: str, value: str, policy: str, rows: int = HISTORY) -> DataFrame:
    """WIN-03/04/05, FLT-07: rows and policy days in the look-back frame, its calendar span, and whether the history is whole."""
    w = Window.partitionBy(*keys).orderBy(order)
    frame = w.rowsBetween(-rows, -1)
    out = df.withColumns({"history_rows": F.count(value).over(frame), "policy_days": F.coalesce(F.sum(F.when(F.col(policy), 1).otherwise(0)).over(frame), F.lit(0)), "span_days": F.datediff(F.col(order), F.lag(order, rows).over(w))})
    return out.withColumn("usable", F.coalesce((F.col("history_rows") == rows) & (F.col("span_days") == rows) & (F.col("policy_days") == 0), F.lit(False)))


def lag_sequence(df: DataFrame, columns: list[str], steps: int, keys: list[str], order: str) -> DataFrame:
    """WIN-06, RSH-06: an array of ``steps`` rows before this one, oldest first, each an array of the columns; null where short."""
    w = Window.partitionBy(*keys).orderBy(order)
    told = df.withColumn("__s", F.array(*columns))
    past = [F.lag("__s", k).over(w).alias(f"__s{k}") for k in range(steps, 0, -1)]
    out = told.select(*df.columns, *past)
    return out.select(*df.columns, F.when(F.col(f"__s{steps}").isNotNull(), F.array(*[f"__s{k}" for k in range(steps, 0, -1)])).alias("sequence"))


def weighted_lags(df: DataFrame, x: str, weights: list[float], keys: list[str], order: str, name: str) -> DataFrame:
    """WIN-08: Σ weight_h · x(t−h), missing x skipped; null if all are missing. ``weights[h]`` is for lag h."""
    w = Window.partitionBy(*keys).orderBy(order)
    past = F.array(*[F.lag(x, h).over(w) for h in range(len(weights))])
    terms = F.zip_with(past, F.array(*map(F.lit, weights)), lambda v, k: v * k)
    total = F.aggregate(terms, F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0)))
    return df.withColumn(name, F.when(F.exists(terms, lambda v: v.isNotNull()), total))


def pressure(df: DataFrame, x: str, keys: list[str], order: str) -> DataFrame:
    """WIN-09, WIN-10: up and down parts, differences, rolling deviations and means with the least counts they need."""
    w = Window.partitionBy(*keys).orderBy(order)
    roll = lambda n, k, f: F.when(F.count(x).over(w.rowsBetween(-(n - 1), 0)) >= k, f(x).over(w.rowsBetween(-(n - 1), 0)))
    c = F.col(x)
    return df.withColumns({
        f"{x}_up": F.when(c.isNotNull(), F.greatest(c, F.lit(0.0))), f"{x}_down": F.when(c.isNotNull(), F.least(c, F.lit(0.0))), f"{x}_diff1": c - F.lag(x, 1).over(w), f"{x}_diff7": c - F.lag(x, 7).over(w),
        f"{x}_std7": roll(7, 4, F.stddev_samp), f"{x}_std14": roll(14, 7, F.stddev_samp), f"{x}_mean7": roll(7, 4, F.avg), f"{x}_mean30": roll(30, 15, F.avg),
    })


def percent_change(df: DataFrame, level: str, keys: list[str], order: str, excluded: Column | None = None, log: bool = True, name: str = "change") -> DataFrame:
    """WIN-11: 100 times the log or relative change on calendar rows; null across missing and excluded levels. Levels must be above 0."""
    w = Window.partitionBy(*keys).orderBy(order)
    level_ = F.col(level) if excluded is None else F.when(~excluded, F.col(level))
    kept = df.withColumn("__l", F.when(level_ > 0, level_).when(level_.isNotNull(), F.raise_error(F.lit("levels must be above 0")).cast("double")))
    before = F.lag("__l").over(w)
    return kept.withColumn(name, 100 * (F.log("__l") - F.log(before)) if log else 100 * (F.col("__l") / before - 1)).drop("__l")


def time_split(counts: DataFrame, date: str, share: float = 0.7, gap: int = 7) -> DataFrame:
    """WIN-15: (train_end, validation_start): the first date by which ``share`` of all rows have passed, and ``gap`` days on."""
    running = counts.withColumn("cum", F.sum("n").over(Window.orderBy(date).rowsBetween(Window.unboundedPreceding, 0))).withColumn("total", F.sum("n").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return running.where(F.col("cum") >= F.floor(share * F.col("total"))).agg(F.min(date).alias("train_end")).withColumn("validation_start", F.date_add("train_end", gap + 1))


def weekly(df: DataFrame, keys: list[str], date: str, x: str, saturday: Column) -> DataFrame:
    """AGG-12: weekly mean and last value, by weeks that end on Saturday."""
    return df.groupBy(*keys, saturday.alias("week_end")).agg(F.avg(x).alias("week_mean"), F.max_by(F.when(F.col(x).isNotNull(), F.col(x)), F.when(F.col(x).isNotNull(), F.col(date))).alias("week_last"))


def residual_band(df: DataFrame, keys: list[str], order: str, residual: str, eligible: Column, coverage: float, cap: int = 1200, least: int = 120, refresh: int = 7) -> DataFrame:
    """WIN-18: low and high quantiles of the last ``cap`` eligible residuals strictly before a row, renewed every ``refresh`` rows and held between.

    Rows meet once, on their keys; a task holds one series at a time and, at each refresh row, sorts the last ``cap`` residuals.
    Rows with fewer than ``least`` residuals before them have no band.
    """
    low, high = (1 - coverage) / 2, 1 - (1 - coverage) / 2
    columns = df.columns
    told = df.withColumn("__ok", F.coalesce(eligible & F.col(residual).isNotNull(), F.lit(False)))

    def bands(table):
        import numpy as np
        import pyarrow as pa

        table = table.sort_by(order)
        ok, r = table.column("__ok").to_numpy(), table.column(residual).cast(pa.float64()).to_numpy()
        pool, seen = r[ok], np.cumsum(ok) - ok
        out = np.full((2, len(r)), np.nan)
        first = int(np.argmax(seen >= least)) if seen[-1] >= least else len(r)
        for i in range(first, len(r), refresh):
            past = np.sort(pool[max(0, seen[i] - cap) : seen[i]])
            for k, share in enumerate((low, high)):
                place = (len(past) - 1) * share
                a, b = int(np.floor(place)), int(np.ceil(place))
                out[k, i : i + refresh] = past[a] if a == b else (b - place) * past[a] + (place - a) * past[b]
        none = np.arange(len(r)) < first
        made = table.select(columns)
        for name, q in zip(("q_low", "q_high"), out, strict=True):
            made = made.append_column(name, pa.array(q, mask=none))
        return made

    schema = df.withColumns({c: F.lit(None).cast("double") for c in ("q_low", "q_high")}).schema
    return told.groupBy(*keys).applyInArrow(bands, schema)
