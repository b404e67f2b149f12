"""Lag orders of change series: search, rolling-origin forecasts, full-sample tests and the choice among finalists (ML-02 to ML-05, WIN-20)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairgrid.functions.numbers import rebuild_level
from fairgrid.operators.models import chi2_tail, f_tail, is_stable, lag_design
from fairgrid.operators.stored import cut

#: Candidates of each shortlist, lags of the Newey-West weights, least lag of the Ljung-Box test, levels of the tests.
SHORTLIST, HAC_LAGS, BOX_LAGS, BOX_LEVEL, BLOCK_LEVEL = 12, 7, 14, 0.05, 0.10
#: Rows of a series that one task takes in rolling forecasts and full-sample sums.
STRETCH = 256


def box_lag(n: int, p: int, least: int = BOX_LAGS) -> int:
    """ML-04: autocorrelations that the Ljung-Box test of a model with ``p`` own lags sums, from ``n`` residuals."""
    return min(max(least, p + 5), max(5, n // 5))


def box_test(products: np.ndarray, n: int, p: int) -> tuple[int, float, float]:
    """ML-04: lag, Q and its tail from the residuals' products with themselves 0, 1, ... rows before."""
    lag = box_lag(n, p)
    k = np.arange(1, lag + 1)
    q = n * (n + 2) * float((np.square(products[1 : lag + 1] / max(products[0], 1e-300)) / (n - k)).sum())
    return lag, q, chi2_tail(q, lag - p) if lag > p else math.nan


def inverse_of(xx: np.ndarray) -> np.ndarray:
    """The inverse of cross products, scaled to a unit diagonal; the pseudo-inverse where columns depend on each other."""
    scale = 1 / np.sqrt(np.maximum(np.diag(xx), 1e-300))
    scaled = xx * np.outer(scale, scale)
    try:
        out = np.linalg.inv(scaled)
        if np.abs(scaled).sum(0).max() * np.abs(out).sum(0).max() < 1e11:
            return out * np.outer(scale, scale)
    except np.linalg.LinAlgError:
        pass
    return np.linalg.pinv(xx, hermitian=True)


def bartlett(products: list[np.ndarray]) -> np.ndarray:
    """The long-run sum of lagged products Γ0, Γ1, ...: Γ0 + Σ w_l (Γl + Γlᵀ) with falling weights."""
    out = products[0].copy()
    for k, g in enumerate(products[1:], 1):
        out += (1 - k / len(products)) * (g + g.T)
    return out


def block_test(beta: np.ndarray, cov: np.ndarray, free: int) -> tuple[float, float]:
    """ML-03: F of all coefficients of a block being 0 under the covariance ``cov``, and its tail."""
    f = max(0.0, float(beta @ inverse_of(cov) @ beta) / len(beta))
    return f, f_tail(f, len(beta), free)


def change_design(df: DataFrame, keys: list[str], order: str, y: str, x: str, level: str, max_p: int, max_q: int, dummies: bool = True) -> tuple[DataFrame, int]:
    """(keys, order, y, level, before, v) of the change series ``y`` and ``x``, and the number of columns ahead of the lags.

    ``v`` holds a constant, calendar dummies, own lags 1 to ``max_p`` and foreign lags 1 to ``max_q``, some null; ``before`` is the level of the row before.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    design, xs = lag_design(df.withColumn("__before", F.lag(level).over(w)), keys, order, y, x, max_p, max_q, dummies=dummies)
    v = F.array(F.lit(1.0), *[F.col(c).cast("double") for c in xs])
    return design.select(*keys, order, F.col(y).alias("y"), F.col(level).alias("level"), F.col("__before").alias("before"), v.alias("v")), len(xs) + 1 - max_p - max_q


def _part(base: int, max_p: int, p: Column, q: Column) -> Column:
    """The columns of ``v`` that an order (p, q) uses."""
    return F.concat(F.slice("v", F.lit(1), F.lit(base) + p), F.slice("v", F.lit(base + max_p + 1), q))


def _whole(v: str) -> Column:
    return F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c))


def _fields(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in names)


def search_grid(design: DataFrame, keys: list[str], base: int, max_p: int, max_q: int, train: int) -> DataFrame:
    """ML-02, first stage: every order (p, q) on the first ``train`` rows of the sample that the largest order leaves.

    keys, p, q, n, aic, bic, stable, block_p (foreign lags under Newey-West errors), lb_lag, lb_p. A task has the bounded sample of one series
    and one p, and fits all q.
    """
    w = Window.partitionBy(*keys).orderBy("__at")
    sample = design.where(F.col("y").isNotNull() & _whole("v")).withColumn("__no", F.row_number().over(w)).where(F.col("__no") <= train)
    p = F.col("p")
    each = sample.select(*keys, "__no", "y", "v", F.explode(F.sequence(F.lit(0), F.lit(max_p))).alias("p")).select(*keys, "p", "__no", "y", _part(base, max_p, p, F.lit(max_q)).alias("v"))

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("__no")
        z, y, p = np.vstack(rows["v"]), rows["y"].to_numpy(float), int(key[-1])
        xx, xy, n, out = z.T @ z, z.T @ y, len(y), []
        for q in range(1, max_q + 1):
            k = base + p + q
            inverse = inverse_of(xx[:k, :k])
            b = inverse @ xy[:k]
            e = y - z[:, :k] @ b
            rss = max(float(e @ e), 1e-300)
            scores = (z[:, :k] @ inverse[:, base + p :]) * e[:, None]
            _, tail = block_test(b[base + p :], bartlett([scores[h:].T @ scores[: n - h] for h in range(HAC_LAGS + 1)]), n - k) if n > k else (0, math.nan)
            lag, _, clean = box_test(np.array([e[h:] @ e[: n - h] for h in range(box_lag(n, p) + 1)]), n, p)
            out.append([*key, q, n, n * math.log(rss / n) + 2 * k, n * math.log(rss / n) + k * math.log(n), is_stable(b[base : base + p]), tail, lag, clean])
        return pd.DataFrame(out, columns=[*keys, "p", "q", "n", "aic", "bic", "stable", "block_p", "lb_lag", "lb_p"])

    return each.groupBy(*keys, "p").applyInPandas(fit, f"{_fields(each, keys)}, p int, q int, n long, aic double, bic double, stable boolean, block_p double, lb_lag int, lb_p double")


def shortlisted(grid: DataFrame, keys: list[str]) -> DataFrame:
    """ML-02, second stage: of the best tier that a series has, the SHORTLIST best by BIC and the SHORTLIST cleanest by Ljung-Box; ``rule`` names the tier.

    Tiers: stable, clean and with a telling block of foreign lags (1); stable with such a block (2); stable (3); any (4).
    """
    clean, block = F.coalesce(F.col("lb_p") >= BOX_LEVEL, F.lit(False)), F.coalesce(F.col("block_p") <= BLOCK_LEVEL, F.lit(False))
    rule = F.when(F.col("stable") & clean & block, 1).when(F.col("stable") & block, 2).when(F.col("stable"), 3).otherwise(4)
    ruled = grid.withColumns({"rule": rule, "tried": F.count("*").over(Window.partitionBy(*keys))})
    best = ruled.withColumn("__best", F.min("rule").over(Window.partitionBy(*keys)))
    # tiers are nested: what passes a stricter one passes the looser ones
    inside = best.where(F.col("rule") <= F.col("__best"))
    by_bic = Window.partitionBy(*keys).orderBy("bic", "q", "p")
    by_box = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("lb_p"), "bic", "q", "p")
    return inside.withColumns({"__a": F.row_number().over(by_bic), "__b": F.row_number().over(by_box)}).where((F.col("__a") <= SHORTLIST) | (F.col("__b") <= SHORTLIST)).drop("__a", "__b", "__best")


def order_rows(design: DataFrame, orders: DataFrame, keys: list[str], base: int, max_p: int) -> DataFrame:
    """(keys, p, q, no, at, y, level, before, z): the rows that each order of ``orders`` can use by itself, numbered from 0. Orders are a few for each series."""
    met = design.join(F.broadcast(orders.select(*keys, "p", "q")), keys)
    own = met.withColumn("z", _part(base, max_p, F.col("p"), F.col("q"))).where(F.col("y").isNotNull() & _whole("z"))
    no = F.row_number().over(Window.partitionBy(*keys, "p", "q").orderBy("__at")) - 1
    return own.select(*keys, "p", "q", no.alias("no"), F.col("__at").alias("at"), "y", "level", "before", "z")


def _block_sums(rows: DataFrame, of: list[str]) -> DataFrame:
    """(of, stretch, n, zz): cross products of z and y in each stretch of rows."""

    def add(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        m = np.column_stack([np.vstack(part["z"]), part["y"].to_numpy(float)])
        return pd.DataFrame([[*key, len(m), (m.T @ m).ravel().tolist()]], columns=[*of, "stretch", "n", "zz"])

    each = rows.select(*of, (F.col("no") / STRETCH).cast("int").alias("stretch"), "y", "z")
    return each.groupBy(*of, "stretch").applyInPandas(add, f"{_fields(rows, of)}, stretch int, n long, zz array<double>")


def _square(flat) -> np.ndarray:
    return np.asarray(flat, float).reshape(math.isqrt(len(flat)), -1)


def rolling_origin(rows: DataFrame, of: list[str], train: int, sums: DataFrame | None = None) -> DataFrame:
    """WIN-20: (of, no, forecast) of every row from ``train`` on, by least squares on all rows before it.

    ``rows`` has the keys ``of``, no (from 0), y and z (regressors, constant included). Sums of cross products up to each stretch of
    STRETCH rows come first; inside a stretch, a task of its own, each row updates the inverse by a rank-one step, so a forecast costs the square of the design's
    width. Stretches whose products cannot be inverted safely are solved row by row.
    """
    sums = _block_sums(rows, of) if sums is None else sums

    def before(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("stretch")
        total, out = np.zeros_like(_square(parts["zz"].iloc[0])), []
        for s, zz in zip(parts["stretch"], parts["zz"], strict=True):
            out.append([*key, s, total.ravel().tolist()])
            total = total + _square(zz)
        return pd.DataFrame(out, columns=[*of, "stretch", "zz"])

    start = sums.groupBy(*of).applyInPandas(before, f"{_fields(sums, of)}, stretch int, zz array<double>").where(F.col("stretch") >= train // STRETCH)
    late = rows.select(*of, (F.col("no") / STRETCH).cast("int").alias("stretch"), "no", "y", "z").where(F.col("stretch") >= train // STRETCH)

    def forecast(key: tuple, part: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        part, m = part.sort_values("no"), _square(start["zz"].iloc[0])
        xx, xy, out = m[:-1, :-1].copy(), m[:-1, -1].copy(), []
        inverse = None
        for no, y, z in zip(part["no"], part["y"], part["z"], strict=True):
            z = np.asarray(z, float)
            if no >= train:
                if inverse is None:
                    scale = 1 / np.sqrt(np.maximum(np.diag(xx), 1e-300))
                    scaled = xx * np.outer(scale, scale)
                    inverse = np.linalg.inv(scaled) * np.outer(scale, scale) if np.linalg.cond(scaled) < 1e10 else False
                b = inverse @ xy if inverse is not False else np.linalg.pinv(xx, rcond=1e-12, hermitian=True) @ xy
                out.append([*key[:-1], no, float(z @ b)])
            if inverse is not None and inverse is not False:
                u = inverse @ z
                inverse = inverse - np.outer(u, u) / (1 + z @ u)
            xx += np.outer(z, z)
            xy += z * y
        return pd.DataFrame(out, columns=[*of, "no", "forecast"])

    return late.groupBy(*of, "stretch").cogroup(start.groupBy(*of, "stretch")).applyInPandas(forecast, f"{_fields(rows, of)}, no int, forecast double")


def forecast_errors(forecasts: DataFrame, of: list[str]) -> DataFrame:
    """WIN-20, NUM-08: errors of one-step forecasts of changes (100 times the log) and of the levels rebuilt from them; ``forecasts`` has y, level, before and forecast."""
    rebuilt = rebuild_level(F.col("before"), F.col("forecast"))
    e, d = F.col("y") - F.col("forecast"), F.col("level") - rebuilt
    return forecasts.groupBy(*of).agg(
        F.count("*").alias("n_forecasts"), F.sqrt(F.avg(e * e)).alias("oos_rmse_chg"), F.avg(F.abs(e)).alias("oos_mae_chg"), F.sqrt(F.avg(d * d)).alias("oos_rmse_level"),
        F.avg(F.abs(d)).alias("oos_mae_level"), (100 * F.avg(F.abs(F.try_divide(d, F.col("level"))))).alias("oos_mape_level"),
    )


def full_tests(rows: DataFrame, of: list[str], base: int, sums: DataFrame) -> DataFrame:
    """ML-03, ML-04, ML-05: each order on its whole sample, from sums that stretches of rows add up.

    of, full_n, r2, stable, block_f and block_p (all foreign lags are 0, Newey-West covariance), full_f and full_p (the model
    without foreign lags against the whole one), box_lag, box_q, box_p, hac_error (of the first foreign lag), beta (constant, own lags, foreign lags).
    The matrix-valued products of scores with those of earlier rows are added in each stretch, with the rows before it that its lags reach.
    """

    def total(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([[*key, int(parts["n"].sum()), sum(map(_square, parts["zz"])).ravel().tolist()]], columns=[*of, "n", "zz"])

    whole = cut(sums.groupBy(*of).applyInPandas(total, f"{_fields(sums, of)}, n long, zz array<double>"))
    reach = F.greatest(F.lit(max(HAC_LAGS, BOX_LAGS)), F.col("p") + 5)
    own = (F.col("no") / STRETCH).cast("int")
    seen_by = F.when(STRETCH - F.col("no") % STRETCH <= reach, F.array(own, own + 1)).otherwise(F.array(own))
    spread = rows.select(*of, "no", "y", "z", F.explode(seen_by).alias("stretch"))
    known = whole.select(*of, "zz", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / STRETCH).cast("int"))).alias("stretch"))

    def products(key: tuple, part: pd.DataFrame, whole: pd.DataFrame) -> pd.DataFrame:
        if not len(whole):
            return pd.DataFrame([], columns=[*of, "stretch", "boxes", "gammas"])
        part, p = part.sort_values("no"), int(key[of.index("p")])
        m, z = _square(whole["zz"].iloc[0]), np.vstack(part["z"])
        inverse = inverse_of(m[:-1, :-1])
        e = part["y"].to_numpy(float) - z @ (inverse @ m[:-1, -1])
        s = (z @ inverse[:, base + p :]) * e[:, None]
        first = int((part["no"] < key[-1] * STRETCH).sum())  # rows of the stretch before

        def with_earlier(a: np.ndarray, h: int) -> np.ndarray:
            at = np.arange(max(first, h), len(a))
            return a[at].T @ a[at - h]

        boxes = [float(with_earlier(e, h)) for h in range(max(HAC_LAGS, BOX_LAGS, p + 5) + 1)]
        gammas = np.concatenate([with_earlier(s, h).ravel() for h in range(HAC_LAGS + 1)])
        return pd.DataFrame([[*key, boxes, gammas.tolist()]], columns=[*of, "stretch", "boxes", "gammas"])

    schema = f"{_fields(rows, of)}, stretch int, boxes array<double>, gammas array<double>"
    parts = spread.groupBy(*of, "stretch").cogroup(known.groupBy(*of, "stretch")).applyInPandas(products, schema)

    def test(key: tuple, parts: pd.DataFrame, whole: pd.DataFrame) -> pd.DataFrame:
        m, n, p = _square(whole["zz"].iloc[0]), int(whole["n"].iloc[0]), int(key[of.index("p")])
        xx, xy, yy = m[:-1, :-1], m[:-1, -1], m[-1, -1]
        k, q = len(xy), len(xy) - base - p
        b = inverse_of(xx) @ xy
        rss = max(float(yy - 2 * b @ xy + b @ xx @ b), 1e-300)
        own = inverse_of(xx[: k - q, : k - q]) @ xy[: k - q]
        rss_own = float(yy - 2 * own @ xy[: k - q] + own @ xx[: k - q, : k - q] @ own)
        cov = bartlett(list(np.sum(np.vstack(parts["gammas"]), axis=0).reshape(HAC_LAGS + 1, q, q)))
        block = block_test(b[k - q :], cov, n - k)
        f = max(0.0, (rss_own - rss) / q / (rss / (n - k)))
        box = box_test(np.sum(np.vstack(parts["boxes"]), axis=0), n, p)
        r2 = 1 - rss / max(float(yy - xy[0] ** 2 / n), 1e-300)
        beta = [float(b[0]), *map(float, b[base:])]
        return pd.DataFrame([[*key, n, r2, is_stable(b[base : base + p]), *block, f, f_tail(f, q, n - k), *box, math.sqrt(max(cov[0, 0], 0)), beta]], columns=[*of, *names])

    names = ["full_n", "r2", "full_stable", "block_f", "full_block_p", "full_f", "full_p", "box_lag", "box_q", "box_p", "hac_error", "beta"]
    schema = "full_n long, r2 double, full_stable boolean, block_f double, full_block_p double, full_f double, full_p double, box_lag int, box_q double, box_p double, hac_error double, beta array<double>"
    return parts.groupBy(*of).cogroup(whole.groupBy(*of)).applyInPandas(test, f"{_fields(rows, of)}, {schema}")


def order_search(df: DataFrame, keys: list[str], order: str, y: str, x: str, level: str, max_p: int, max_q: int, train: int, dummies: bool = True) -> DataFrame:
    """ML-02: the finalists among all orders (p, q) of the change series ``y`` on ``x``, ranked; rank 1 is the choice.

    All orders are tried on the first ``train`` rows; the finalists (``shortlisted``) make one-step forecasts of every later row from
    all rows before it and are fitted on the whole series. Rank: stable and clean on the whole series first, then stable, then the rest; inside these by
    the forecasts' error on changes, then BIC, q and p.
    """
    design, base = change_design(df, keys, order, y, x, level, max_p, max_q, dummies)
    design = cut(design.withColumnRenamed(order, "__at"))
    finalists = cut(shortlisted(search_grid(design, keys, base, max_p, max_q, train), keys))
    of = [*keys, "p", "q"]
    rows = cut(order_rows(design, finalists, keys, base, max_p))
    sums = cut(_block_sums(rows, of))
    forecasts = rolling_origin(rows, of, train, sums).join(rows.select(*of, "no", "y", "level", "before"), [*of, "no"])
    scored = finalists.join(forecast_errors(forecasts, of), of, "left").join(full_tests(rows, of, base, sums), of)
    clean = F.coalesce(F.col("box_p") >= BOX_LEVEL, F.lit(False))
    scored = scored.withColumn("choice", F.when(F.col("oos_rmse_chg").isNull(), 4).when(F.col("full_stable") & clean, 1).when(F.col("full_stable"), 2).otherwise(3))
    tie = F.when(F.col("choice") == 3, -F.coalesce("box_p", F.lit(-1.0)))
    best = Window.partitionBy(*keys).orderBy("choice", F.asc_nulls_last("oos_rmse_chg"), tie, "bic", "q", "p")
    return scored.withColumn("rank", F.row_number().over(best))
