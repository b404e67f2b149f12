"""Regression, tests and impulse responses of lagged series, many series at once (ML-*, WIN-20)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairgrid.operators.stored import cut


# ---- cross products in Spark, solutions on a row for each series -------------------------------------------------


def gram(df: DataFrame, keys: list[str], xs: list[str], y: str, where: Column | None = None) -> DataFrame:
    """ML-01: XᵀX (flat), Xᵀy, yᵀy and n of each series in one aggregate; a constant comes first. Rows with a missing value are left out."""
    whole = F.col(y).isNotNull()
    for x in xs:
        whole = whole & F.col(x).isNotNull()
    rows = df.where(whole if where is None else whole & where)
    cols = [F.lit(1.0), *map(F.col, xs)]
    upper = [F.sum(cols[i] * cols[j]) for i in range(len(cols)) for j in range(i, len(cols))]
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.array(*upper).alias("xx"), F.array(*[F.sum(c * F.col(y)) for c in cols]).alias("xy"), F.sum(F.col(y) * F.col(y)).alias("yy"))


def _square(flat, k: int) -> np.ndarray:
    out = np.zeros((k, k))
    out[np.triu_indices(k)] = flat
    return out + np.triu(out, 1).T


def solve(xx: np.ndarray, xy: np.ndarray, yy: float, n: float) -> dict:
    """Least squares from cross products, with R², AIC and BIC."""
    beta = np.linalg.lstsq(xx, xy, rcond=None)[0]
    rss = max(float(yy - 2 * beta @ xy + beta @ xx @ beta), 1e-12)
    tss = max(float(yy - xy[0] ** 2 / n), 1e-12)
    k = len(xy)
    return {"beta": beta.tolist(), "rss": rss, "r2": 1 - rss / tss, "aic": n * math.log(rss / n) + 2 * k, "bic": n * math.log(rss / n) + k * math.log(n)}


def regressions(grams: DataFrame, keys: list[str], size: int) -> DataFrame:
    """ML-01: coefficients and fit of each series of ``gram`` with ``size`` regressors (constant included)."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in grams.schema if f.name in keys) + ", n long, beta array<double>, rss double, r2 double, aic double, bic double"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [{**{k: r[k] for k in keys}, "n": r["n"], **solve(_square(r["xx"], size), np.asarray(r["xy"]), r["yy"], r["n"])} for r in f.to_dict("records")]
            yield pd.DataFrame(rows, columns=[*keys, "n", "beta", "rss", "r2", "aic", "bic"])

    return grams.mapInPandas(run, schema)


def lag_design(df: DataFrame, keys: list[str], order: str, y: str, x: str, p: int, q: int, causal: bool = True, dummies: bool = False) -> tuple[DataFrame, list[str]]:
    """WIN-02 for a lag model: y lags 1..p, then x lags from 1 (or 0 if not causal) to q, over one window; with ``dummies`` first six weekdays and eleven months."""
    w = Window.partitionBy(*keys).orderBy(order)
    day = {f"wd{k}": (F.weekday(order) == k).cast("double") for k in range(1, 7)} | {f"mo{k}": (F.month(order) == k).cast("double") for k in range(2, 13)} if dummies else {}
    own = {f"y{i}": F.lag(y, i).over(w) for i in range(1, p + 1)}
    other = {f"x{j}": F.lag(x, j).over(w) for j in range(1 if causal else 0, q + 1)}
    return df.withColumns(day | own | other).withColumn("__rn", F.row_number().over(w)), [*day, *own, *other]


def wide_gram(df: DataFrame, keys: list[str], xs: list[str], y: str) -> DataFrame:
    """(keys, n, zz): the flat cross products of constant, ``xs`` and ``y``, for designs of many columns.

    Each task adds up what it reads as one matrix product; the matrices are then added position by position. Rows with a missing value are left out.
    """
    size = len(xs) + 2
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in keys)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for f in frames:
            for key, rows in f.groupby(keys, dropna=False):
                z = np.column_stack([np.ones(len(rows)), rows[[*xs, y]].to_numpy(float)])
                z = z[np.isfinite(z).all(1)]
                n, m = sums.get(key, (0, np.zeros((size, size))))
                sums[key] = n + len(z), m + z.T @ z
        yield pd.DataFrame([[*key, n, m.ravel().tolist()] for key, (n, m) in sums.items()], columns=[*keys, "n", "zz"])

    parts = df.select(*keys, *[F.col(c).cast("double") for c in [*xs, y]]).mapInPandas(run, f"{fields}, n long, zz array<double>")
    cells = parts.select(*keys, "n", F.posexplode("zz").alias("pos", "v")).groupBy(*keys, "pos").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    return cells.groupBy(*keys).agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda c: c["v"]).alias("zz"))


#: Level of the tests.
LEVEL = 0.05


def lagged_products(df: DataFrame, keys: list[str], order: str, lags: dict[str, int]) -> DataFrame:
    """The keys, n and for each column c of ``lags`` the sums c__0 … c__k of its products with itself k rows before."""
    w = Window.partitionBy(*keys).orderBy(order)
    products = {f"{c}__{k}": F.col(c) * (F.lag(c, k).over(w) if k else F.col(c)) for c, most in lags.items() for k in range(most + 1)}
    return df.withColumns(products).groupBy(*keys).agg(F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in products])


def bartlett_sum(c: str, lags: int) -> Column:
    """ML-08: Newey and West's long-run sum of products."""
    return F.col(f"{c}__0") + sum((2 * (1 - k / (lags + 1)) * F.col(f"{c}__{k}") for k in range(1, lags + 1)), F.lit(0.0))


def responses(chosen: DataFrame, keys: list[str], horizon: int = 30) -> DataFrame:
    """ML-06, ML-07: keys, peak_lag, half_mass_lag, mean_lag, recommended_shift, cumulative, irf and weights of each row of ``chosen`` (p, q, beta)."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name in keys)
    names = ["peak_lag", "half_mass_lag", "mean_lag", "recommended_shift", "cumulative", "irf", "weights"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.to_dict("records"):
                beta = np.asarray(r["beta"])
                irf = impulse_response(beta[1 : 1 + r["p"]], beta[1 + r["p"] :], horizon)
                out.append([*(r[k] for k in keys), *response_summary(irf).values(), irf.tolist(), response_weights(irf).tolist()])
            yield pd.DataFrame(out, columns=[*keys, *names])

    return chosen.select(*keys, "p", "beta").mapInPandas(run, f"{fields}, peak_lag int, half_mass_lag int, mean_lag double, recommended_shift int, cumulative double, irf array<double>, weights array<double>")


def stationarity(df: DataFrame, keys: list[str], order: str, x: str, max_lags: int = 10) -> DataFrame:
    """ML-08: keys, adf, adf_lags, adf_p, kpss, kpss_p, stationary_like, from cross products, running sums and lagged products of each series.

    The Dickey-Fuller regression has a constant; lags of the difference are chosen by AIC on a common sample.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    step = df.select(*keys, order, F.col(x).alias("__v")).withColumns({"__step": F.col("__v") - F.lag("__v").over(w), "__level": F.lag("__v").over(w)})
    design = step.withColumns({f"__step{k}": F.lag("__step", k).over(w) for k in range(1, max_lags + 1)})
    xs = ["__level", *(f"__step{k}" for k in range(1, max_lags + 1))]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in keys)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.to_dict("records"):
                m, n, best = _square_of(r["zz"]), r["n"], None
                xx, xy, yy = m[:-1, :-1], m[:-1, -1], m[-1, -1]
                for k in range(max_lags + 1):
                    inverse = np.linalg.pinv(xx[: k + 2, : k + 2])
                    b = inverse @ xy[: k + 2]
                    rss = max(float(yy - 2 * b @ xy[: k + 2] + b @ xx[: k + 2, : k + 2] @ b), 1e-300)
                    error = math.sqrt(max(rss / max(1, n - k - 2) * inverse[1, 1], 1e-300))
                    best = min(best or (np.inf,), (n * math.log(rss / n) + 2 * (k + 2), float(b[1]) / error, k))
                out.append([*(r[k] for k in keys), best[1], best[2], adf_tail(best[1])])
            yield pd.DataFrame(out, columns=[*keys, "adf", "adf_lags", "adf_p"])

    unit = wide_gram(design.where(f"__step{max_lags} is not null"), keys, xs, "__step").mapInPandas(run, f"{fields}, adf double, adf_lags int, adf_p double")
    centred = df.select(*keys, order, (F.col(x) - F.avg(x).over(Window.partitionBy(*keys))).alias("e"))
    running = centred.withColumn("s", F.sum("e").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    sums = lagged_products(running, keys, order, {"e": max_lags, "s": 0})
    level = sums.select(*keys, (F.col("s__0") / (F.col("n") * F.greatest(bartlett_sum("e", max_lags), F.lit(1e-300)))).alias("kpss"))
    told = unit.join(level, keys).withColumn("kpss_p", kpss_tail(F.col("kpss")))
    return told.withColumn("stationary_like", (F.col("adf_p") < LEVEL) & (F.col("kpss_p") > LEVEL))


def _square_of(flat) -> np.ndarray:
    size = math.isqrt(len(flat))
    return np.asarray(flat).reshape(size, size)


# ---- numbers of one model ----------------------------------------------------------------------------------------


def is_stable(phi) -> bool:
    """ML-05: whether all roots of 1 − φ1·z − … − φp·zᵖ lie outside the unit circle."""
    phi = np.asarray(phi, float)
    if not len(phi) or not np.abs(phi).max():
        return True
    return bool(np.all(np.abs(np.roots(np.concatenate([-phi[::-1], [1.0]]))) > 1 + 1e-9))


def impulse_response(phi, beta, horizon: int, first_lag: int = 1) -> np.ndarray:
    """ML-06: irf_h = Σ φ_i · irf_{h−i} + β_h for h = 0 … horizon; ``beta[0]`` is for ``first_lag``."""
    out = np.zeros(horizon + 1)
    for h in range(horizon + 1):
        out[h] = sum(f * out[h - i] for i, f in enumerate(phi, 1) if h >= i) + (beta[h - first_lag] if 0 <= h - first_lag < len(beta) else 0.0)
    return out


def response_summary(irf: np.ndarray) -> dict:
    """ML-06: peak, half-mass (lag 0 counted) and mean lag, and the shift they recommend."""
    mass = np.abs(irf)
    total = mass.sum()
    mean = float((np.arange(len(irf)) * mass).sum() / total) if total else 0.0
    half = int(np.searchsorted(np.cumsum(mass), total / 2)) if total else 0
    return {"peak_lag": int(mass.argmax()), "half_mass_lag": half, "mean_lag": mean, "recommended_shift": max(0, round(mean)), "cumulative": float(irf.sum())}


def response_weights(irf: np.ndarray, least: int = 1) -> np.ndarray:
    """ML-07: positive parts from the least lag on, absolute ones where none is positive, summing to 1."""
    w = np.where(np.arange(len(irf)) >= least, np.maximum(irf, 0), 0.0)
    if not w.sum():
        w = np.where(np.arange(len(irf)) >= least, np.abs(irf), 0.0)
    return w / w.sum() if w.sum() else w


def upper_gamma(a: float, x: float) -> float:
    """The regularised upper incomplete gamma function, by series or continued fraction."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        for k in range(1, 500):
            term *= x / (a + k)
            total += term
        return max(0.0, 1 - front * total)
    c = d = 1 / (x + 1 - a)
    c, out, b = 1e300, d, x + 1 - a
    for k in range(1, 500):
        an, b = -k * (k - a), b + 2
        d, c = 1 / (an * d + b), b + an / c
        out *= d * c
    return front * out


def incomplete_beta(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
    out = d
    for m in range(1, 300):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 / (1 + top * d), 1 + top / c
            out *= d * c
    return front * out


def chi2_tail(q: float, df: float) -> float:
    return upper_gamma(df / 2, q / 2)


def f_tail(f: float, d1: float, d2: float) -> float:
    return incomplete_beta(d2 / 2, d1 / 2, d2 / (d2 + d1 * f)) if f > 0 else 1.0


#: MacKinnon's (1994) response surface of the Dickey-Fuller test with a constant: the normal quantile of the p-value as a polynomial
#: of the statistic, below and above the break, and the ends beyond which p is 0 or 1.
ADF_LOW, ADF_HIGH, ADF_BREAK, ADF_ENDS = (2.1659, 1.4412, 0.038269), (1.7339, 0.93202, -0.12745, -0.010368), -1.61, (-18.83, 2.74)
#: Critical values of the KPSS test for a level (1992) and their p-values.
KPSS_TABLE = ((0.347, 0.10), (0.463, 0.05), (0.574, 0.025), (0.739, 0.01))


def adf_tail(t: float) -> float:
    """ML-08: the p-value of a Dickey-Fuller statistic."""
    if not ADF_ENDS[0] <= t <= ADF_ENDS[1]:
        return float(t > 0)
    z = sum(c * t**i for i, c in enumerate(ADF_LOW if t <= ADF_BREAK else ADF_HIGH))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def kpss_tail(stat: Column) -> Column:
    """ML-08: the p-value of a KPSS statistic between the table's values, which bound it."""
    out = F.when(stat <= KPSS_TABLE[0][0], KPSS_TABLE[0][1])
    for (a, p), (b, q) in zip(KPSS_TABLE, KPSS_TABLE[1:], strict=False):
        out = out.when(stat <= b, p + (stat - a) * ((q - p) / (b - a)))
    return out.otherwise(KPSS_TABLE[-1][1])


def huber(x: np.ndarray, y: np.ndarray, epsilon: float = 1.35, alpha: float = 1e-4, rounds: int = 50) -> np.ndarray:
    """ML-09: robust coefficients (constant first) by reweighting, on population z-scores, scale from the residuals' MAD."""
    mean, std = x.mean(0), x.std(0)
    std[std <= 1e-9] = 1
    z = np.column_stack([np.ones(len(x)), (x - mean) / std])
    ridge = alpha * np.eye(z.shape[1])
    ridge[0, 0] = 0
    beta, weight = np.zeros(z.shape[1]), np.ones(len(y))
    for _ in range(rounds):
        new = np.linalg.solve((z * weight[:, None]).T @ z + ridge + 1e-12 * np.eye(len(beta)), (z * weight[:, None]).T @ y)
        e = y - z @ new
        scale = 1.4826 * np.median(np.abs(e - np.median(e))) or float(e.std()) or 1.0
        weight = np.minimum(1, epsilon * scale / np.maximum(np.abs(e), 1e-12))
        if np.abs(new - beta).max() < 1e-8:
            beta = new
            break
        beta = new
    slope = beta[1:] / std
    return np.concatenate([[beta[0] - slope @ mean], slope])


# ---- models over time --------------------------------------------------------------------------------------------


def refit_rows(usable: list[int], step: int) -> list[int]:
    """Trap 10: the usable rows at which a model is fitted anew: the first, then each that is ``step`` rows or more after the last."""
    out: list[int] = []
    for i in usable:
        if not out or i - out[-1] >= step:
            out.append(i)
    return out


def _numbered(df: DataFrame, keys: list[str], order: str, learn: Column) -> DataFrame:
    """``df`` with __learn, __rn (rows from 0) and __seen (rows learnt from before), written once."""
    w = Window.partitionBy(*keys).orderBy(order)
    seen = F.coalesce(F.sum(F.col("__learn").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return cut(df.withColumn("__learn", learn).withColumn("__rn", F.row_number().over(w) - 1).withColumn("__seen", seen))


def _all_there(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns])


def rolling_huber(df: DataFrame, keys: list[str], order: str, y: str, xs: list[str], eligible: str, cap: int = 900, least: int = 240, refit: int = 7) -> DataFrame:
    """ML-09: each row's prediction by the last model, which is fitted on up to ``cap`` eligible complete rows before its refit row.

    Columns: keys, the order column, prediction. Rows before ``least`` rows of history, and rows with a missing regressor, get null.
    Each refit is a range of row numbers, met by an equi-join on blocks of ``cap`` numbers, and a small fit of its own; a series is never in one task but for its row numbers.
    """
    t = df.select(*keys, order, F.col(y).alias("__y"), *xs, eligible).withColumn("__whole", _all_there(xs))
    t = _numbered(t, keys, order, F.col("__whole") & _all_there(["__y"]) & F.coalesce(eligible, F.lit(False)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in t.schema if f.name in keys)

    def chain(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(at=[refit_rows(list(at), refit) for at in f["at"]])

    usable = t.where(F.col("__whole") & (F.col("__seen") >= least)).groupBy(*keys).agg(F.array_sort(F.collect_list("__rn")).alias("at"))
    turns = usable.mapInPandas(chain, f"{fields}, at array<int>").select(*keys, F.explode("at").alias("__rn"))
    turns = cut(t.join(turns, [*keys, "__rn"]).select(*keys, "__rn", "__seen"))
    first = F.floor(F.greatest(F.col("__seen") - cap, F.lit(0)) / cap)
    wanted = turns.select(*keys, F.col("__rn").alias("__turn"), F.col("__seen").alias("__end"), F.explode(F.array_distinct(F.array(first, F.floor((F.col("__seen") - 1) / cap)))).alias("__block"))
    pool = t.where("__learn").select(*keys, F.floor(F.col("__seen") / cap).alias("__block"), F.col("__seen").alias("__no"), "__y", *xs)
    met = wanted.join(pool, [*keys, "__block"]).where((F.col("__no") < F.col("__end")) & (F.col("__no") >= F.col("__end") - cap))

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("__no")
        return pd.DataFrame([[*key, huber(rows[xs].to_numpy(float), rows["__y"].to_numpy(float)).tolist()]], columns=[*keys, "__turn", "__beta"])

    fits = met.select(*keys, "__turn", "__no", "__y", *xs).groupBy(*keys, "__turn").applyInPandas(fit, f"{fields}, __turn int, __beta array<double>")
    w = Window.partitionBy(*keys).orderBy(order)
    placed = t.join(turns.select(*keys, "__rn", F.col("__rn").alias("__turn")), [*keys, "__rn"], "left").withColumn("__turn", F.last("__turn", ignorenulls=True).over(w))
    value = reduce(lambda a, b: a + b, [F.col("__beta")[0], *[F.col("__beta")[i] * F.col(c) for i, c in enumerate(xs, 1)]])
    return placed.join(fits, [*keys, "__turn"], "left").select(*keys, order, F.when(F.col("__whole"), value).alias("prediction"))


def expanding_forecasts(df: DataFrame, keys: list[str], order: str, y: str, xs: list[str], train: int) -> DataFrame:
    """WIN-20: one-step forecasts by least squares on all rows before, from row ``train`` on: running sums of cross products, and a small solve for each row."""
    t = _numbered(df.select(*keys, order, F.col(y).alias("__y"), *xs), keys, order, _all_there([*xs]) & _all_there(["__y"]))
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    z, k = [F.lit(1.0), *[F.col(c).cast("double") for c in xs]], len(xs) + 1
    run_sum = lambda c: F.coalesce(F.sum(F.when(F.col("__learn"), c)).over(before), F.lit(0.0))
    sums = t.withColumns({"__xx": F.array(*[run_sum(z[i] * z[j]) for i in range(k) for j in range(k)]), "__xy": F.array(*[run_sum(c * F.col("__y")) for c in z]), "__z": F.array(*z)})
    kept = sums.select(*keys, order, (F.col("__learn") & (F.col("__seen") >= train)).alias("__go"), "__xx", "__xy", "__z")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in [*keys, order])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made = [float(r[2] @ np.linalg.lstsq(np.asarray(r[0]).reshape(k, k), np.asarray(r[1]), rcond=None)[0]) if go else None for go, *r in zip(f["__go"], f["__xx"], f["__xy"], f["__z"], strict=True)]
            yield f[[*keys, order]].assign(forecast=made)

    return kept.select(*keys, order, "__go", "__xx", "__xy", "__z").mapInPandas(run, f"{fields}, forecast double")
