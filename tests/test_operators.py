"""Frames, joins, windows and models against brute force."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fairgrid.operators import aggregates as agg
from fairgrid.operators import delta, frames, joins, lagmodels, layers, models, windows

DAY0 = dt.date(2024, 1, 1)
FEW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def day(k):
    return DAY0 + dt.timedelta(days=k)


def test_last_per_key_and_richest(spark):
    df = spark.createDataFrame([("a", 1, "x", 0), ("a", 1, None, 1), ("a", 2, "z", 2), ("b", None, None, 3)], "k string, n int, v string, at int")
    assert {r.k: r["at"] for r in frames.last_per_key(df, ["k"], [F.col("n"), F.col("at")]).collect()} == {"a": 2, "b": 3}
    assert {r.k: r["at"] for r in frames.richest_per_key(df, ["k"], ["n", "v"], F.col("at")).collect()} == {"a": 2, "b": 3}


def test_schema_and_rename(spark):
    df = spark.createDataFrame([(1.5, "x")], "`price (krw)` double, other string")
    assert frames.rename(df, {"pricekrw": "price"}).columns == ["price", "other"]


@FEW
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 8)), max_size=12), st.lists(st.tuples(st.integers(0, 2), st.integers(0, 8)), min_size=1, max_size=12, unique=True))
def test_as_of_equals_brute_force(spark, facts, events):
    f = spark.createDataFrame([(i, k, day(d)) for i, (k, d) in enumerate(facts)], "i int, k int, d date")
    e = spark.createDataFrame([(k, day(d), 10 * k + d) for k, d in events], "k int, d date, v int")
    got = {r.i: (r.v, r.since) for r in joins.as_of_join(f, e, ["k"], "d", "d", ["v"], keep_date="since").collect()}
    for i, (k, d) in enumerate(facts):
        past = [x for kk, x in events if kk == k and x <= d]
        assert got[i] == ((10 * k + max(past), day(max(past))) if past else (None, None))


def test_overlay_equals_overwriting(spark):
    rows = [("A", 0, 10, 0.1, 0), ("B", 5, 12, 0.2, 0), ("C", 7, 7, 0.3, 1), ("D", 5, 8, 0.4, 0)]
    p = spark.createDataFrame([(n, day(a), day(b), "g", r, c) for n, a, b, r, c in rows], "name string, start date, end date, fuel string, rate double, category int")
    days = spark.createDataFrame([(day(k),) for k in range(15)], "d date")
    got = {r.d: (r.tax_name, r.cap_name) for r in joins.overlay(days, "d", p, {0: "tax", 1: "cap"}).collect()}
    for k in range(15):
        held = {0: None, 1: None}
        for n, _, _, _, c in sorted((r for r in rows if r[1] <= k <= r[2]), key=lambda r: (r[1], r[2], r[0])):
            held[c] = n
        assert got[day(k)] == (held[0], held[1])


def test_distance_pairs_equal_all_pairs(spark):
    r = random.Random(1)
    pts = [(i, float(r.randrange(0, 20) * 50), float(r.randrange(0, 20) * 50)) for i in range(60)]
    a = spark.createDataFrame(pts, "id int, x double, y double")
    b = spark.createDataFrame(pts, "id2 int, x2 double, y2 double")
    got = {(p.id, p.id2) for p in joins.distance_pairs(a, b, 150.0).collect()}
    assert got == {(i, j) for i, x, y in pts for j, u, v in pts if (x - u) ** 2 + (y - v) ** 2 <= 150.0**2}
    assert joins.distance_pairs(a, b, 150.0).count() == len(got)


def test_polygon_with_hole(spark):
    square = [("s", 0, [[[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0]], [[4.0, 4.0], [4.0, 6.0], [6.0, 6.0], [6.0, 4.0]]])]
    poly = spark.createDataFrame(square, "name string, ordinal int, rings array<array<array<double>>>")
    pts = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 20.0, 5.0), (4, 9.9, 0.1)], "id int, x double, y double")
    assert {r.id: r.name for r in joins.point_in_polygon(pts, joins.polygon_edges(poly), 3.0).collect()} == {1: "s", 2: None, 3: None, 4: "s"}


def test_islands_and_neighbours(spark):
    cells = [(x * 500, y * 500) for x in range(3) for y in range(3)] + [(1500, 1500), (5000, 5000)]
    out = {(r.cell_x, r.cell_y): r.mainland for r in joins.neighbour_components(spark.createDataFrame(cells, "cell_x int, cell_y int"), 500).collect()}
    assert sum(out.values()) == 10 and not out[(5000, 5000)]
    runs = spark.createDataFrame([("k", i, f) for i, f in enumerate([True, True, None, False, False, True])], "k string, d int, f boolean")
    got = sorted((r.start, r.end, r.tone) for r in frames.islands(runs, ["k"], "d", F.col("f")).collect())
    assert got == [(0, 1, True), (3, 4, False), (5, 5, True)]


def test_mainland_query_covers_all_station_cells(spark, tmp_path):
    from fairgrid.plans import registry

    ids = [*range(1, 30), *range(60, 64), 95]
    spark.createDataFrame([(i, str(i), 0, 1.0) for i in ids], "s_suppkey long, s_name string, s_nationkey long, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(0, "n", 0)], "n_nationkey long, n_name string, n_regionkey long").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(0, "r")], "r_regionkey long, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    left, parts = {(i % 10, i // 10) for i in ids}, []
    while left:
        todo, part = [left.pop()], set()
        while todo:
            x, y = todo.pop()
            part.add((x * 500, y * 500))
            near = {(x + i, y + j) for i in (-1, 0, 1) for j in (-1, 0, 1)} & left
            left -= near
            todo += near
        parts.append(frozenset(part))
    rows = registry.QUERIES["geo_04_mainland_cells"](spark, str(tmp_path)).collect()
    got = {c: frozenset((r.cell_x, r.cell_y) for r in rows if r.component == c) for c in {r.component for r in rows}}
    assert set(got.values()) == set(parts) and len(rows) == len(ids)
    assert {(r.cell_x, r.cell_y) for r in rows if r.mainland} == max(parts, key=len)


def _stages(spark):
    """Records that each known stage has written to shuffles."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty()
    store, no = sc.statusStore(), spark._jvm.java.util.ArrayList()
    found = store.stageList(no, False, False, getattr(store, "stageList$default$4")(), no)
    return {found.apply(i).stageId(): found.apply(i).shuffleWriteRecords() for i in range(found.size())}


def test_training_frame_keeps_all_rows_below_the_cap(spark, tmp_path, monkeypatch):
    from fairgrid.plans import models as plans

    row = ("date_add(date'1992-01-01', cast(id div 10 as int)) l_shipdate", "id % 10 l_suppkey", "100D + id % 7 l_extendedprice", "2D l_quantity", "'F' l_linestatus", "id l_partkey", "'N' l_returnflag", "id l_orderkey", "1 l_linenumber")
    spark.range(21_000).selectExpr(*row).write.parquet(f"{tmp_path}/lineitem.parquet")
    out = plans.ml_14_training_frame(spark, str(tmp_path))
    assert out.count() == out.select("station_id", "d").distinct().count() == 21_000 - 10 * 5
    monkeypatch.setattr(plans, "_MAX_FINAL_ROWS", 700)
    assert plans.ml_14_training_frame(spark, str(tmp_path)).count() == 700


def test_a_frame_beyond_the_cap_is_made_once_and_cut_by_hash(spark, tmp_path, monkeypatch):
    from fairgrid.plans import models as plans

    row = ("date_add(date'1992-01-01', cast(id div 10 as int)) l_shipdate", "id % 10 l_suppkey", "100D + id % 7 l_extendedprice", "2D l_quantity", "'F' l_linestatus", "id l_partkey", "'N' l_returnflag", "id l_orderkey", "1 l_linenumber")
    spark.range(40_000).selectExpr(*row).write.parquet(f"{tmp_path}/lineitem.parquet")
    whole = plans.ml_14_training_frame(spark, str(tmp_path)).withColumn("h", F.xxhash64("station_id", "d", F.lit(0))).collect()
    # all days but the first five of a station, and of the seven in the gap those of the sample
    gap = dt.date(1999, 12, 25), dt.date(1999, 12, 31)
    assert sum(not gap[0] <= r.d <= gap[1] for r in whole) == 40_000 - 10 * 5 - 10 * 7
    monkeypatch.setattr(plans, "_MAX_FINAL_ROWS", 900)
    before = _stages(spark)
    got = plans.ml_14_training_frame(spark, str(tmp_path)).collect()
    assert sum(n for k, n in _stages(spark).items() if k not in before) < 3 * 40_000
    want = sorted(sorted(whole, key=lambda r: r.h)[:900], key=lambda r: (r.station_id, r.d))
    assert [tuple(r) for r in got] == [(r.station_id, r.d, r.delta) for r in want]


def test_a_training_frame_is_whole_at_any_size(spark, tmp_path):
    from fairgrid.plans import models as plans

    row = ("date_add(date'1992-01-01', cast(id div 4000 as int)) l_shipdate", "id % 4000 l_suppkey", "100D + id % 7 l_extendedprice", "2D l_quantity", "'F' l_linestatus", "id l_partkey", "'N' l_returnflag", "id l_orderkey", "1 l_linenumber")
    spark.range(8_400_000).selectExpr(*row).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert plans.ml_14_training_frame(spark, str(tmp_path)).count() == 8_400_000 - 4_000 * 5


@pytest.mark.parametrize("n", [0, 1, 499, 500, 5_000])
def test_fixed_sample_takes_whole_hashes(spark, n):
    df = spark.range(1_000).selectExpr("id div 3 k", "id v").withColumn("h", F.xxhash64("k", F.lit(0)))
    rows = sorted(df.collect(), key=lambda r: r.h)
    most = rows[min(n, 1_000) - 1].h if n else None
    got = frames.fixed_sample(df.drop("h"), ["k"], n).collect()
    assert sorted(r.v for r in got) == sorted(r.v for r in rows if n and r.h <= most) and [r.k for r in got] == sorted(r.k for r in got)
    assert frames.fixed_sample(df.where("false"), ["k"], n).count() == 0


def test_change_history(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(["x", "x", None, None, "y", "x"])], "k string, d int, v string")
    assert [(r.d, r.v, r.valid_to) for r in frames.change_history(df, ["k"], "d", "v").orderBy("d").collect()] == [(0, "x", 2), (2, None, 4), (4, "y", 5), (5, "x", None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_appended_history_is_that_of_all_rows(spark, seed):
    r = random.Random(seed)
    rows = [(k, d, r.choice(["x", "x", "y", None])) for k in "ab" for d in range(12) if r.random() < 0.8]
    r.shuffle(rows)
    schema = "k string, d int, v string"
    history = spark.createDataFrame([], schema + ", valid_to int, seen array<int>")
    for part in (rows[:7], rows[7:9], rows[9:]):
        history = frames.append_changes(history, spark.createDataFrame(part, schema), ["k"], "d", "v")
    history = frames.append_changes(history, spark.createDataFrame([("a", 3, "z")], schema), ["k"], "d", "v")
    whole = [x for x in rows if x[:2] != ("a", 3)] + [("a", 3, "z")]
    want = frames.change_history(spark.createDataFrame(whole, schema), ["k"], "d", "v").select("k", "d", "v", "valid_to")
    assert sorted(map(str, history.drop("seen").collect())) == sorted(map(str, want.collect()))


def test_weighted_means_differ_on_missing(spark):
    df = spark.createDataFrame([(10.0, 1.0), (None, 1.0), (20.0, 0.0)], "x double, w double")
    r = df.agg(agg.mean_unmasked("x", "w").alias("a"), agg.mean_masked("x", "w").alias("b")).first()
    assert (r.a, r.b) == (5.0, 10.0)
    none = spark.createDataFrame([(10.0, 0.0), (20.0, 0.0)], "x double, w double").agg(agg.mean_unmasked("x", "w").alias("a"), agg.mean_masked("x", "w").alias("b")).first()
    assert (none.a, none.b) == (None, 15.0)


def test_excluded_edges_have_no_change(spark):
    df = spark.createDataFrame([("s", day(i), 100.0 + i) for i in range(6)], "k string, d date, x double")
    out = windows.percent_change(df, "x", ["k"], "d", F.col("d").isin(day(2), day(3))).orderBy("d").collect()
    assert [r.change is None for r in out] == [True, False, True, True, True, False]


def test_lookback_needs_every_row_and_day(spark):
    rows = [("a", day(i)) for i in range(31)] + [("b", day(i)) for i in range(32) if i != 5] + [("c", day(i)) for i in range(29)]
    df = spark.createDataFrame(rows, "k string, d date").withColumn("x", F.lit(1.0)).withColumn("p", F.lit(False))
    out = windows.lookback_quality(df, ["k"], "d", "x", "p").where("usable").groupBy("k").count().collect()
    assert {r.k: r["count"] for r in out} == {"a": 2}


def test_band_uses_the_past_only(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=200)
    ok = r.random(200) > 0.2

    def band(values):
        df = spark.createDataFrame([("s", i, float(v), bool(o)) for i, (v, o) in enumerate(zip(values, ok, strict=True))], "k string, i int, r double, ok boolean")
        return [(b.q_low, b.q_high) for b in windows.residual_band(df, ["k"], "i", "r", F.col("ok"), 0.7, cap=50, least=20).orderBy("i").collect()]

    got, held, last = band(x), None, None
    for i in range(200):
        past = [x[j] for j in range(i) if ok[j]][-50:]
        if len(past) >= 20 and (last is None or i - last >= 7):
            held, last = tuple(np.quantile(past, [0.15, 0.85])), i
        assert got[i] == (pytest.approx(held) if held else (None, None))
    changed = x.copy()
    changed[150:] += 100
    assert band(changed)[:151] == got[:151]


def test_gram_solve_equals_least_squares(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(100, 3))
    y = 1 + x @ [1, -2, 0.5] + r.normal(size=100)
    df = spark.createDataFrame([("s", *map(float, row), float(t)) for row, t in zip(x, y, strict=True)], "k string, a double, b double, c double, y double")
    got = models.regressions(models.gram(df, ["k"], ["a", "b", "c"], "y"), ["k"], 4).first()
    want, rss, *_ = np.linalg.lstsq(np.column_stack([np.ones(100), x]), y, rcond=None)
    assert np.allclose(got.beta, want) and got.rss == pytest.approx(rss[0]) and got.n == 100


def _lagged(seed, n=600):
    r = np.random.default_rng(seed)
    x = 100 + r.normal(size=n)
    y = np.zeros(n)
    for t in range(2, n):
        y[t] = 0.5 * y[t - 1] + 0.8 * x[t - 2] + 0.1 * r.normal()
    return x, y


def _series_of(spark, x, y, **more):
    rows = [("s", day(i), float(a), float(b), *(v[i] for v in more.values())) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "k string, d date, x double, y double" + "".join(f", {c} {'boolean' if isinstance(v[0], bool) else 'double'}" for c, v in more.items()))


def _ols(z, t):
    inverse = np.linalg.pinv(z.T @ z)
    beta = inverse @ z.T @ t
    return beta, t - z @ beta, inverse


def _hac(z, e, inverse, lags=7):
    u = z * e[:, None]
    middle = u.T @ u + sum((1 - k / (lags + 1)) * (u[k:].T @ u[:-k] + u[:-k].T @ u[k:]) for k in range(1, lags + 1))
    return inverse @ middle @ inverse


def _box(e, p):
    n, lag = len(e), min(max(14, p + 5), max(5, len(e) // 5))
    q = n * (n + 2) * sum((e[k:] @ e[:-k] / (e @ e)) ** 2 / (n - k) for k in range(1, lag + 1))
    return lag, q, models.chi2_tail(q, lag - p)


@pytest.mark.parametrize("dummies", [False, True])
def test_order_search_equals_brute_force(spark, dummies):
    x, y = _lagged(4)
    level = 100 * np.exp(np.cumsum(y - y.mean()) / 1000)
    n, train, max_p, max_q = 600, 400, 3, 4
    days = [day(i) for i in range(n)]
    df = _series_of(spark, x, y, level=[float(v) for v in level])
    fixed = np.column_stack([np.ones(n), *([[float(d.weekday() == k) for d in days] for k in range(1, 7)] + [[float(d.month == k) for d in days] for k in range(2, 13)] if dummies else [])])

    def sample(p, q, first):
        at = np.arange(first, n)
        return np.column_stack([fixed[at], *(y[at - i] for i in range(1, p + 1)), *(x[at - j] for j in range(1, q + 1))]), y[at]

    base = fixed.shape[1]
    grid = {}
    for p in range(max_p + 1):
        for q in range(1, max_q + 1):
            z, t = (a[:train] for a in sample(p, q, 4))
            beta, e, inverse = _ols(z, t)
            block = beta[base + p :] @ np.linalg.pinv(_hac(z, e, inverse)[base + p :, base + p :]) @ beta[base + p :] / q
            grid[p, q] = (train * np.log(e @ e / train) + z.shape[1] * np.log(train), models.is_stable(beta[base : base + p]), models.f_tail(block, q, train - z.shape[1]), *_box(e, p))
    design, at = lagmodels.change_design(df, ["k"], "d", "y", "x", "level", max_p, max_q, dummies)
    assert at == base
    tried = {(r.p, r.q): r for r in lagmodels.search_grid(design.withColumnRenamed("d", "__at"), ["k"], base, max_p, max_q, train).collect()}
    assert set(tried) == set(grid)
    for k, (bic, stable, block_p, lag, _, clean) in grid.items():
        r = tried[k]
        assert (r.n, r.stable, r.lb_lag) == (train, stable, lag)
        assert r.bic == pytest.approx(bic, rel=1e-6) and r.block_p == pytest.approx(block_p, rel=1e-3, abs=1e-9) and r.lb_p == pytest.approx(clean, rel=1e-4, abs=1e-9)

    out = lagmodels.order_search(df, ["k"], "d", "y", "x", "level", max_p, max_q, train, dummies=dummies).collect()
    rules = {k: 1 if g[1] and g[5] >= 0.05 and g[2] <= 0.1 else 2 if g[1] and g[2] <= 0.1 else 3 if g[1] else 4 for k, g in grid.items()}
    inside = [k for k in grid if rules[k] == min(rules.values())]
    short = set(sorted(inside, key=lambda k: (grid[k][0], k[1], k[0]))[:12]) | set(sorted(inside, key=lambda k: (-grid[k][5], grid[k][0]))[:12])
    assert {(r.p, r.q) for r in out} == short and all(r.tried == 16 for r in out)
    assert dummies or max(out, key=lambda r: -r.rank).q >= 2
    for r in out:
        z, t = sample(r.p, r.q, max(r.p, r.q))
        made = []
        for i in range(train, len(t)):
            made.append(z[i] @ np.linalg.lstsq(z[:i], t[:i], rcond=None)[0])
        late, first = t[train:], max(r.p, r.q) + train
        rebuilt = level[first - 1 : n - 1] * np.exp(np.array(made) / 100)
        assert r.n_forecasts == len(late)
        assert r.oos_rmse_chg == pytest.approx(np.sqrt(np.mean((late - made) ** 2)), rel=1e-6)
        assert r.oos_rmse_level == pytest.approx(np.sqrt(np.mean((level[first:] - rebuilt) ** 2)), rel=1e-6)
        assert r.oos_mape_level == pytest.approx(100 * np.mean(np.abs(level[first:] - rebuilt) / level[first:]), rel=1e-6)
        beta, e, inverse = _ols(z, t)
        cov, k = _hac(z, e, inverse)[base + r.p :, base + r.p :], z.shape[1]
        f = beta[base + r.p :] @ np.linalg.pinv(cov) @ beta[base + r.p :] / r.q
        e0 = _ols(z[:, : base + r.p], t)[1]
        plain = (e0 @ e0 - e @ e) / r.q / (e @ e / (len(t) - k))
        assert r.block_f == pytest.approx(f, rel=1e-5) and r.full_f == pytest.approx(plain, rel=1e-5) and r.full_n == len(t)
        assert r.full_block_p == pytest.approx(models.f_tail(f, r.q, len(t) - k), abs=1e-6) and r.full_p == pytest.approx(models.f_tail(plain, r.q, len(t) - k), abs=1e-6)
        assert (r.box_lag, r.box_q, r.box_p) == (_box(e, r.p)[0], pytest.approx(_box(e, r.p)[1], rel=1e-5), pytest.approx(_box(e, r.p)[2], rel=1e-4, abs=1e-9))
        assert r.hac_error == pytest.approx(np.sqrt(cov[0, 0]), rel=1e-5) and np.allclose(r.beta, [beta[0], *beta[base:]], rtol=1e-4, atol=1e-6)
    place = lambda r: ({True: 1}.get(r.full_stable and r.box_p >= 0.05, 2 if r.full_stable else 3), r.oos_rmse_chg)
    assert [r.rank for r in sorted(out, key=place)] == list(range(1, len(out) + 1))
    w = models.responses(spark.createDataFrame([("s", 1, [0.0, 0.5, 0.0, 1.0])], "k string, p int, beta array<double>"), ["k"], 6).first()
    assert np.allclose(w.irf, [0, 0, 1, 0.5, 0.25, 0.125, 0.0625]) and w.peak_lag == 2 and sum(w.weights) == pytest.approx(1)


def test_stationarity_tails(spark):
    # critical values of large samples at 1, 5 and 10 %
    for stat, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        assert models.adf_tail(stat) == pytest.approx(p, abs=1.5e-3)
    assert models.adf_tail(-20) == 0 and models.adf_tail(3) == 1 and models.adf_tail(-1.61) == pytest.approx(models.adf_tail(-1.6099), abs=2e-3)
    df = spark.createDataFrame([(0.1, 0.1), (0.347, 0.1), (0.405, 0.075), (0.463, 0.05), (0.574, 0.025), (0.6565, 0.0175), (0.739, 0.01), (5.0, 0.01)], "x double, want double")
    assert all(r.p == pytest.approx(r.want) for r in df.withColumn("p", models.kpss_tail(F.col("x"))).collect())


def test_responses_and_tails():
    irf = models.impulse_response([0.5], [0.0, 1.0], 6)
    assert np.allclose(irf, [0, 0, 1, 0.5, 0.25, 0.125, 0.0625])
    assert models.response_summary(irf)["peak_lag"] == 2
    w = models.response_weights(np.array([5.0, -1.0, 1.0, 3.0]))
    assert np.allclose(w, [0, 0, 0.25, 0.75]) and np.allclose(models.response_weights(np.array([9.0, -1.0, -3.0])), [0, 0.25, 0.75])
    assert models.is_stable([0.5]) and not models.is_stable([1.1]) and models.is_stable([])
    assert models.chi2_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert models.f_tail(3.0984, 3, 20) == pytest.approx(0.05, abs=1e-4)


def test_refit_chain_and_huber():
    assert models.refit_rows([0, 1, 7, 13, 14, 22, 29, 30], 7) == [0, 7, 14, 22, 29]
    r = np.random.default_rng(5)
    x = r.normal(size=(300, 2))
    y = 3 + x @ [2, -1] + 0.1 * r.normal(size=300)
    y[:20] += 50
    assert np.allclose(models.huber(x, y), [3, 2, -1], atol=0.1)


def test_rolling_and_expanding_models_equal_brute_force(spark):
    x, y = _lagged(5, 160)
    r = np.random.default_rng(7)
    ok = [bool(v) for v in r.random(160) > 0.15]
    holes = [None if i in (50, 51, 90) else float(v) for i, v in enumerate(x)]
    df = _series_of(spark, x, y, ok=ok, z=holes).withColumn("x", F.col("x"))
    got = [v.prediction for v in models.rolling_huber(df, ["k"], "d", "y", ["x", "z"], "ok", cap=40, least=25, refit=7).orderBy("d").collect()]
    grown = [v.forecast for v in models.expanding_forecasts(df, ["k"], "d", "y", ["x", "z"], 30).orderBy("d").collect()]
    learnt, beta, last = [], None, None
    for i in range(160):
        row = None if holes[i] is None else np.array([x[i], holes[i]])
        if row is not None and len(learnt) >= 25 and (last is None or i - last >= 7):
            at, last = learnt[-40:], i
            beta = models.huber(np.array([[x[j], holes[j]] for j in at]), y[at])
        want = None if row is None or beta is None else beta[0] + row @ beta[1:]
        assert got[i] == (None if want is None else pytest.approx(want)), i
        past = [j for j in range(i) if holes[j] is not None]
        if row is not None and len(past) >= 30:
            z = np.array([[1, x[j], holes[j]] for j in past])
            want = np.array([1, *row]) @ np.linalg.lstsq(z.T @ z, z.T @ y[past], rcond=None)[0]
            assert grown[i] == pytest.approx(want, rel=1e-6)
        else:
            assert grown[i] is None
        if row is not None and ok[i]:
            learnt.append(i)


def test_stationarity_equals_brute_force(spark):
    noise = np.random.default_rng(6).normal(size=500)
    walk = np.cumsum(noise)
    out = {}
    for name, v in (("noise", noise), ("walk", walk)):
        got = models.stationarity(_series_of(spark, v, v), ["k"], "d", "x", 4).first()
        d, best = np.diff(v), None
        for k in range(5):
            z = np.column_stack([np.ones(495), v[4:-1], *(d[4 - i : 499 - i] for i in range(1, k + 1))])
            b, *_ = np.linalg.lstsq(z, d[4:], rcond=None)
            e = d[4:] - z @ b
            t = b[1] / np.sqrt(e @ e / (495 - z.shape[1]) * np.linalg.inv(z.T @ z)[1, 1])
            best = min(best or (np.inf,), (495 * np.log(e @ e / 495) + 2 * z.shape[1], t, k))
        e = v - v.mean()
        s2 = e @ e + 2 * sum((1 - k / 5) * (e[k:] @ e[:-k]) for k in range(1, 5))
        assert (got.adf, got.adf_lags) == (pytest.approx(best[1]), best[2]) and got.kpss == pytest.approx((np.cumsum(e) ** 2).sum() / (500 * s2))
        assert got.adf_p == pytest.approx(models.adf_tail(best[1])) and 0.01 <= got.kpss_p <= 0.1
        out[name] = got.stationary_like
    assert out == {"noise": True, "walk": False}


def test_exact_quantiles_equal_numpy(spark):
    r = np.random.default_rng(8)
    rows = [("ab"[i % 2], None if i % 11 == 0 else float(r.integers(0, 40))) for i in range(500)] + [("c", None), (None, 3.0), (None, 5.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {v.k: v for v in agg.exact_quantiles(df, ["k"], "x", {"lo": 0.1, "mid": 0.5, "hi": 0.93}).collect()}
    assert set(got) == {"a", "b", None}
    for k in got:
        own = [x for key, x in rows if key == k and x is not None]
        assert np.allclose([got[k].lo, got[k].mid, got[k].hi], np.quantile(own, [0.1, 0.5, 0.93]))
    values = sorted({x for _, x in rows if x is not None})
    assert sorted(v.step for v in agg.ordered_steps(df, "x").collect()) == sorted(np.diff(values).tolist())


def test_nearest_equals_brute_force(spark):
    r = np.random.default_rng(9)
    points = [(i, "ab"[i % 2], float(r.integers(0, 9) * 500), float(r.integers(0, 9) ** 3 * 500)) for i in range(120)] + [(500, "alone", 0.0, 0.0), (600, "two", 0.0, 0.0), (601, "two", 9e6, 9e6)]
    df = spark.createDataFrame(points, "id long, g string, x double, y double")
    other = df.select(F.col("id").alias("id2"), "g", F.col("x").alias("x2"), F.col("y").alias("y2"))
    got = {v.id: (v.id2, v.d2) for v in joins.nearest(df, other, ["g"], 500.0, exclude_self=True).collect()}
    for i, g, x, y in points:
        best = min((((x - a) ** 2 + (y - b) ** 2, j) for j, h, a, b in points if h == g and j != i), default=None)
        assert got.get(i) == (None if best is None else (best[1], best[0])), i
    same = {v.id: v.id2 for v in joins.nearest(df, other, ["g"], 500.0).where("d2 = 0").collect()}
    assert len(same) == len(points) and joins.nearest(df.limit(0), other, ["g"], 500.0).count() == 0


def _rolled(rows, xs, y, ok, cap, least, refit):
    """Predictions of rolling robust fits, row by row."""
    out, learnt, beta, last = [], [], None, None
    for i, r in enumerate(rows):
        x = [r[c] for c in xs]
        whole = all(v is not None for v in x)
        if whole and len(learnt) >= least and (last is None or i - last >= refit):
            at, last = learnt[-cap:], i
            beta = models.huber(np.array([[rows[j][c] for c in xs] for j in at]), np.array([y(rows[j]) for j in at]))
        out.append(beta[0] + np.array(x) @ beta[1:] if whole and beta is not None else None)
        if whole and y(r) is not None and ok(r):
            learnt.append(i)
    return out


def test_layered_prices_equal_brute_force(spark):
    r = np.random.default_rng(8)
    n, horizon = 420, 4
    intl = np.cumsum(r.normal(size=n)) + 50
    retail = 2 * intl + 10 + r.normal(size=n)
    days = [day(k) for k in range(n)]
    ends = sorted({d + dt.timedelta((5 - d.weekday()) % 7) for d in days})
    supply = {e: 1.5 * float(np.mean([v for d, v in zip(days, intl, strict=True) if e - dt.timedelta(6) <= d <= e])) + float(r.normal()) for e in ends if e != ends[9]}
    daily = spark.createDataFrame([("s", d, float(a), None if k == 40 else float(b), 100 <= k < 120) for k, (d, a, b) in enumerate(zip(days, retail, intl, strict=True))], "k string, d date, retail double, intl double, excluded boolean")
    refinery = spark.createDataFrame([("s", e, v) for e, v in supply.items()], "k string, week_end date, refinery double")
    weights = [0.1, 0.2, 0.4, 0.2, 0.1]
    w = spark.createDataFrame([("s", weights)], "k string, weights array<double>")
    no = w.limit(0)
    few, week = {"cap": 90, "least": 60, "refit": 7}, {"cap": 30, "least": 24, "refit": 3}
    got = layers.layered_prices(daily, refinery, ["k"], w, no, horizon, 3, few, week)

    weekly, weekly_xs = layers.weekly_frame(daily, refinery, ["k"], no, 3)
    weekly = weekly.orderBy("week_end").collect()
    level = {x.week_end: x.intl_w for x in weekly}
    assert [x.week_end for x in weekly] == sorted(supply) and all(x.irf == pytest.approx(x.intl_w) for x in weekly)
    for a, b in zip(weekly, weekly[1:], strict=False):
        assert b.step == pytest.approx(level[b.week_end] - level[a.week_end]) and b.rise - b.fall == pytest.approx(b.step)
    fair = dict(zip([x.week_end for x in weekly], _rolled(weekly, weekly_xs, lambda x: x.refinery, lambda x: not x.excluded, **week), strict=True))
    stored = {x.week_end: x.fair_refinery for x in got.weekly.collect()}
    assert sum(v is not None for v in fair.values()) > 10 and all(stored[k] == (v if v is None else pytest.approx(v)) for k, v in fair.items())

    frame, direct_xs, spread_xs = layers.daily_frame(daily, ["k"], w, horizon)
    rows = [x.asDict() for x in frame.orderBy("d").collect()]
    for k in (10, 200):
        assert rows[k]["irf"] == pytest.approx(sum(weights[h] * intl[k - h] for h in range(5)))
        assert rows[k]["irf_rise"] == pytest.approx(sum(weights[h] * max(intl[k - h] - intl[k - h - 1], 0) for h in range(5)))
    for x in rows:
        known = [e for e in fair if e < x["d"] and fair[e] is not None]
        x["fair_refinery"] = fair[max(known)] if known else None
        x["spread"] = None if x["fair_refinery"] is None else x["retail"] - x["fair_refinery"]
    direct = _rolled(rows, direct_xs, lambda x: x["retail"], lambda x: not x["excluded"], **few)
    spread = _rolled(rows, ["fair_refinery", *spread_xs], lambda x: x["spread"], lambda x: not x["excluded"], **few)
    two = [None if v is None else v + x["fair_refinery"] for v, x in zip(spread, rows, strict=True)]
    out = got.daily.orderBy("d").collect()
    same = lambda a, b: a == (None if b is None else pytest.approx(b, rel=1e-6))
    assert sum(v is not None for v in two) > 50
    assert all(same(o.direct, a) and same(o.two_layer, b) and same(o.fair_refinery, x["fair_refinery"]) for o, a, b, x in zip(out, direct, two, rows, strict=True))
    mae = {m: np.mean([abs(x["retail"] - v) for v, x in zip(fit, rows, strict=True) if v is not None and not x["excluded"]]) for m, fit in (("direct", direct), ("two_layer", two))}
    metrics = {m.model: m for m in got.metrics.collect()}
    assert set(metrics) == {"refinery_weekly", "direct", "two_layer"} and all(metrics[m].mae == pytest.approx(v, rel=1e-6) for m, v in mae.items())
    choice = "two_layer" if mae["two_layer"] <= 1.15 * mae["direct"] else "direct"
    assert [m for m in metrics if metrics[m].chosen] == [choice]
    assert all(same(o.final, b if choice == "two_layer" else a) for o, a, b in zip(out, direct, two, strict=True))
    strict = layers.layered_prices(daily, refinery, ["k"], w, no, horizon, 3, few, week, allowance=0.01)
    assert [m.model for m in strict.metrics.collect() if m.chosen] == ["direct"]


def test_delta_models_are_chosen_on_the_holdout_and_scored_by_month(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import array_to_vector

    r = np.random.default_rng(2)
    rows = []
    for i in range(400):
        a, b = r.normal(size=2)
        rows.append(("train" if i < 240 else "stop" if i < 300 else "holdout", float(3 * a - b + 0.01 * r.normal()), 10.0, 1.0 + i % 3, [float(a), float(b)], f"2024-{1 + i // 100:02d}", i))
    t = spark.createDataFrame(rows, "part string, delta double, y_lag1 double, weight double, x array<double>, month string, id int").withColumn("raw", array_to_vector("x")).withColumn("y", F.col("y_lag1") + F.col("delta"))
    told = {m: (n, weighted, chosen) for m, n, _, _, weighted, chosen in delta.fit_delta_models(t, f"{tmp_path}/model")}
    assert {m: v[0] for m, v in told.items()} == {"robust linear": 100, "boosted trees": 100}
    assert told["robust linear"][2] and not told["boosted trees"][2] and told["robust linear"][1] < 0.05 < told["boosted trees"][1]
    model = PipelineModel.load(f"{tmp_path}/model")
    want = {x.id: x.y_lag1 + x.prediction for x in model.transform(t).collect()}
    held = [x for x in rows if x[0] == "holdout"]
    weighted = sum(x[3] * abs(10 + x[1] - want[x[6]]) for x in held) / sum(x[3] for x in held)
    assert told["robust linear"][1] == pytest.approx(weighted)
    out = f"{tmp_path}/scores"
    assert delta.score_months(t.where("month < '2024-03'"), f"{tmp_path}/model", out, ["id"], at_once=1) == ["2024-01", "2024-02"]
    assert delta.score_months(t, f"{tmp_path}/model", out, ["id"], again=("2024-01",), at_once=2) == ["2024-01", "2024-03", "2024-04"]
    got = {x.id: x.prediction for x in spark.read.parquet(out).collect()}
    assert got == want and spark.read.parquet(out).count() == 400


def test_sequences_are_stored_once_and_made_by_piece(spark):
    r = np.random.default_rng(5)
    series = {("f", g): sorted(r.choice(900, n, replace=False).tolist()) for g, n in (("a", 28), ("b", 29), ("c", 600), ("e", 256), ("h", 257))}
    rows = [(f, g, day(k), *map(float, r.normal(size=3))) for (f, g), ks in series.items() for k in ks]
    df = spark.createDataFrame(rows, "fuel string, grid_id string, d date, y double, national double, weight double").withColumn("static", F.array(F.lit(2.0), F.length("grid_id") * 3.0))
    pieces = delta.series_pieces(df, ["fuel", "grid_id"], "d", ["y", "national", "weight"], ["static"]).cache()
    assert pieces.agg(F.sum(F.size("days"))).first()[0] < 1.2 * len(rows)
    want = {}
    for key in series:
        own = sorted(x[2:] for x in rows if x[:2] == key)
        for i in range(28, len(own)):
            past, (d, y, _, weight), last = own[i - 28 : i], own[i], own[i - 1][1]
            steps = [v for x in past for v in (x[1] - last, x[2] - last, x[3])]
            raw = [*steps, last - past[-1][2], past[-1][3], (d - past[-1][0]).days, float(np.cumsum([x[1] for x in past])[-1]) / 28 - last, 2.0, 3.0]
            want[*key, d] = (d.strftime("%Y-%m"), y, last, weight, y - last, raw)
    got = {(x.fuel, x.grid_id, x.d): (x.month, x.y, x.y_lag1, x.weight, x.delta, x.raw.toArray().tolist()) for x in delta.sequence_rows(delta.spread(pieces, 100), ["fuel", "grid_id"]).collect()}
    assert got == want
    some = ["2024-05", "2025-01"]
    assert {(x.fuel, x.grid_id, x.d) for x in delta.sequence_rows(pieces, ["fuel", "grid_id"], some).collect()} == {k for k, v in want.items() if v[0] in some}
    assert {x.m for x in pieces.select(F.explode("months").alias("m")).distinct().collect()} == {v[0] for v in want.values()}


def test_learners_keep_no_rows_and_reach_what_brute_force_finds(spark):
    from fairgrid.operators import learners

    r = np.random.default_rng(8)
    x = np.column_stack([r.normal(size=600), r.integers(0, 4, 600), np.full(600, 3.0), r.exponential(size=600)])
    d, w = 2 * x[:, 0] - x[:, 1] + np.where(x[:, 3] > 1, 3, 0) + r.standard_t(2, size=600), 1.0 + r.integers(0, 3, 600)
    part = np.repeat([0, 1, 2], [400, 100, 100])
    rows = [(("train", "stop", "holdout")[p], float(v), float(v) + 5, 5.0, float(k), z.tolist()) for p, v, k, z in zip(part, d, w, x, strict=True)]
    t = spark.createDataFrame(rows, "part string, delta double, y double, y_lag1 double, weight double, raw array<double>").repartition(3)
    z, e, k = x[:400], d[:400], w[:400]
    mean, inverse, label = learners.spread_of(learners.packed(t), delta.row_parts)
    assert mean == pytest.approx(z.mean(0)) and inverse[2] == 0 and inverse[[0, 1, 3]] == pytest.approx(1 / z[:, [0, 1, 3]].std(0)) and label == pytest.approx([k.sum(), k @ e / k.sum(), np.sqrt(k @ e**2 / k.sum() - (k @ e / k.sum()) ** 2)])
    line = learners.robust_linear(t, delta.row_parts, mean, inverse, label)
    slope = np.array(line["coefficients"])

    def loss(slope, intercept, scale):
        off = np.abs(e - z @ slope - intercept) / scale
        return k @ (scale * (1 + np.where(off <= 1.35, off**2, 2 * 1.35 * off - 1.35**2))) / k.sum() / 2 + 0.5e-4 * ((slope[[0, 1, 3]] / inverse[[0, 1, 3]]) ** 2).sum()

    scales = np.linspace(0.3, 3, 2_701)
    least = min(loss(slope, line["intercept"], s) for s in scales)
    for i in (0, 1, 3, 4):
        for move in (-0.01, 0.01):
            other = slope + move * (np.arange(4) == i)
            assert min(loss(other, line["intercept"] + move * (i == 4), s) for s in scales) > least
    bin_of = learners.bins_of(t, delta.row_parts, mean, inverse)
    trees = learners.boosted_trees(t, delta.row_parts, mean, inverse, bin_of, 3, 3, 0.2)
    cell = learners.cells(x.T, mean, inverse)
    b = np.stack([bin_of[f][cell[f]] for f in range(4)])
    made = np.zeros(600)
    kept, best = 0, np.inf
    told = []
    for m in range(3):
        rest, node, value = (d - made) * (1 if m == 0 else 0.4), np.zeros(600, int), np.zeros(600)
        learn = part == 0
        for _ in range(3):
            for j in set(node[learn]):
                own = learn & (node == j)
                gains = {}
                for f in range(4):
                    for c in range(31):
                        go = own & (b[f] > c)
                        if go.any() and (own & ~go).any():
                            gains[f, c] = sum((w[g] @ rest[g]) ** 2 / w[g].sum() for g in (go, own & ~go)) - (w[own] @ rest[own]) ** 2 / w[own].sum()
                top = max(gains, key=gains.get, default=None)
                right = (b[top[0]] > top[1]) if top and gains[top] > 1e-9 else np.zeros(600, bool)
                node = np.where(node == j, 10 * (j + 1) + right, node)
        for j in set(node[learn]):
            own = learn & (node == j)
            value[node == j] = w[own] @ rest[own] / w[own].sum()
        made = made + value
        told.append(made)
        off = w[part == 1] @ (d - made)[part == 1] ** 2
        if off > best:
            break
        if off < best:
            best, kept = off, m + 1
    assert len(trees["trees"]) == kept and learners.predicted(trees, x.T) == pytest.approx(told[kept - 1])
    errors = learners.errors(t, delta.row_parts, [line, trees])
    for got, made in zip(errors, (x @ slope + line["intercept"], told[kept - 1]), strict=True):
        off = np.abs(d - made)[part == 2]
        assert got == pytest.approx((100, off.mean(), np.sqrt((off**2).mean()), w[part == 2] @ off / w[part == 2].sum()))


def test_pieces_are_scored_where_their_rows_are_made(spark):
    import json

    from fairgrid.operators import learners

    r = np.random.default_rng(5)
    rows = [(g, day(k), *map(float, r.normal(size=3))) for g in "ab" for k in range(400)]
    df = spark.createDataFrame(rows, "grid_id string, d date, y double, national double, weight double").withColumn("static", F.array(F.lit(2.0)))
    pieces = delta.series_pieces(df, ["grid_id"], "d", ["y", "national", "weight"], ["static"])
    model = learners.DeltaModel(json.dumps({"intercept": 0.5, "coefficients": r.normal(size=89).tolist()}))
    want = {(x.grid_id, x.d): (x.month, x.y_lag1 + x.prediction) for x in model.transform(delta.sequence_rows(pieces, ["grid_id"])).collect()}
    some = sorted({m for m, _ in want.values()})[2:5]
    got = {(x.grid_id, x.d): (x.month, x.prediction) for x in delta.piece_scores(pieces, ["grid_id"], some, model).collect()}
    assert got == {k: v for k, v in want.items() if v[0] in some} and len(want) == 2 * 372


def test_series_move_once_and_are_those_of_plain_aggregates(spark, tmp_path):
    from fairgrid.plans import models as plans
    from fairgrid.plans.tables import grid_day

    row = ("date_add(date'1998-01-01', cast(id div 40 as int)) l_shipdate", "id % 20 l_suppkey", "100D + id % 7 + id % 11 l_extendedprice", "1D + id % 3 l_quantity", "if(id % 3 = 0, 'F', 'O') l_linestatus", "id l_partkey", "'N' l_returnflag", "id l_orderkey", "1 l_linenumber")
    spark.range(30_000).selectExpr(*row).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(15).selectExpr("id s_suppkey", "'s' s_name", "id % 2 s_nationkey", "id * 10D s_acctbal").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(2).selectExpr("id n_nationkey", "'n' n_name", "0L n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(1).selectExpr("id r_regionkey", "'r' r_name").write.parquet(f"{tmp_path}/region.parquet")
    before = _stages(spark)
    rows = plans._sequence_pieces(spark, str(tmp_path)).collect()
    assert sum(n for k, n in _stages(spark).items() if k not in before) < 1.2 * 30_000
    days = {(r.fuel, r.grid_id, x.d): (x.y, x.national, x.weight) for r in rows for x in r.days}
    grid = [r for r in grid_day(spark, str(tmp_path)).collect()]
    nation = {}
    for r in grid:
        nation.setdefault((r.fuel, r.d), []).append((r.price * r.w, r.w))
    assert days.keys() == {(r.fuel, r.grid_id, r.d) for r in grid}
    for r in grid:
        national = sum(a for a, _ in nation[r.fuel, r.d]) / sum(b for _, b in nation[r.fuel, r.d])
        assert days[r.fuel, r.grid_id, r.d] == pytest.approx((r.price, national, r.w))
    told = {(r.fuel, r.grid_id): r.static for r in rows}
    for r in grid:
        k = r.cell_x // 500 + 10 * (r.cell_y // 500)
        assert told[r.fuel, r.grid_id] == pytest.approx([r.cell_x / 1000, r.cell_y / 1000, float(k < 15), k / 100 if k < 15 else 0.0])


def test_station_matrix_keeps_every_value_and_parses_a_date_once_a_line(spark, tmp_path):
    from fairgrid.sources import readers

    r = random.Random(4)
    rows = {(day(d), f"A{s}"): round(r.random() * 1000 + 1, 3) for d in range(30) for s in range(25) if r.random() < 0.2}
    df = spark.createDataFrame([(*k, v) for k, v in rows.items()] + [(*k, v - 0.5) for k, v in list(rows.items())[:9]] + [(day(3), "A99", None)], "date date, station_id string, price double")
    readers.write_price_matrix(df, f"{tmp_path}/m", 7)
    out = readers.read_price_matrix(spark, f"{tmp_path}/m", "diesel")
    assert {(x.date, x.station_id): x.price for x in out.collect()} == rows and out.count() == len(rows)
    widths = {x.block: x.n for x in spark.read.text(f"{tmp_path}/m").groupBy("block").agg(F.collect_set(F.size(F.split("value", ","))).alias("n")).collect()}
    assert sum(n[0] - 1 for n in widths.values()) == len({s for _, s in rows} | {"A99"}) and all(len(n) == 1 for n in widths.values())
    above = out._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert "2,4" not in above  # the pattern of dates


def test_lag_sequence_looks_up_rows_and_differences_are_rounded_once(spark, tmp_path):
    from fairgrid.plans import registry

    rows = [(k, d, float(d * d + len(k)), None if d == 3 else float(d)) for k, n in (("a", 9), ("bb", 3), ("ccc", 4)) for d in range(n)]
    out = windows.lag_sequence(spark.createDataFrame(rows, "k string, d int, x double, p double"), ["x", "p"], 3, ["k"], "d")
    want = {(k, d): [list(v[2:]) for v in rows if v[0] == k and d - 3 <= v[1] < d] if d >= 3 else None for k, d, *_ in rows}
    assert {(x.k, x.d): x.sequence for x in out.collect()} == want
    assert "collect_list" not in out._jdf.queryExecution().optimizedPlan().toString()
    plan = registry.QUERIES["win_06_lag_differences"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and plan.count("round(") <= 2


def test_days_and_lags_of_a_station_are_made_where_its_observations_are_dealt(spark, tmp_path):
    from fairgrid.plans import registry

    row = ("date_add(date'1992-01-01', cast(id div 100 as int)) l_shipdate", "id % 50 l_suppkey", "100D + id % 7 + id % 11 l_extendedprice", "2D l_quantity", "'F' l_linestatus", "id l_partkey", "'N' l_returnflag", "id l_orderkey", "1 l_linenumber")
    spark.range(6_000).selectExpr(*row).write.parquet(f"{tmp_path}/lineitem.parquet")
    before = _stages(spark)
    got = {(x.station_id, x.d): x for x in registry.QUERIES["win_06_lag_differences"](spark, str(tmp_path)).collect()}
    assert sum(n for k, n in _stages(spark).items() if k not in before) < 1.2 * 6_000  # observations move once, days do not
    price = {(s, k): sum((100 + i % 7 + i % 11) / 2 for i in (100 * k + s, 100 * k + s + 50)) / 2 for s in range(50) for k in range(60)}
    start = dt.date(1992, 1, 1)
    assert got.keys() == {(s, start + dt.timedelta(k)) for s, k in price if k >= 28}
    for (s, d), x in got.items():
        k = (d - start).days
        assert all(x[f"lag{j}"] == pytest.approx(price[s, k - j]) for j in range(1, 29)) and all(x[f"delta{j}"] == pytest.approx(price[s, k - j] - price[s, k - j - 1]) for j in range(1, 28))


def test_decay_sums_equal_all_pairs_and_copy_few_points(spark):
    r = random.Random(3)
    pts = [(k, i, float(r.randrange(-20, 20) * 50), float(r.randrange(-20, 20) * 50), float(i % 4)) for k in (1, 2) for i in range(80)]
    a = spark.createDataFrame([x[:4] for x in pts], "k int, id int, x double, y double")
    b = spark.createDataFrame(pts, "k int, id2 int, x2 double, y2 double, n double")
    got = {(x.k, x.id): x.influence for x in joins.decay_sum(a, b, 150.0, 100.0, F.col("n"), keys=["k"]).collect()}
    far = lambda p, q: ((p[2] - q[2]) ** 2 + (p[3] - q[3]) ** 2) ** 0.5
    want = {p[:2]: sum(q[4] * np.exp(-far(p, q) / 100) for q in pts if q[0] == p[0] and q[1] != p[1] and far(p, q) <= 150) for p in pts}
    assert got == {k: pytest.approx(v) for k, v in want.items()}
    one, two = joins._near_buckets(a, b, 150.0)
    assert one.count() == len(pts) and two.count() < 4 * len(pts)


def test_band_takes_one_look_at_each_series(spark):
    r = random.Random(6)
    rows = [(k, i, r.choice([None, r.random()]), r.choice([True, True, None])) for k in ("a", "b") for i in range(150)] + [("c", 0, 1.0, True)]
    out = windows.residual_band(spark.createDataFrame(rows, "k string, i int, r double, ok boolean"), ["k"], "i", "r", F.col("ok"), 0.7, cap=30, least=10)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    got, held = {(x.k, x.i): (x.q_low, x.q_high) for x in out.collect()}, {}
    for k, i, _, _ in rows:
        past = [v for key, j, v, ok in rows if key == k and j < i and ok and v is not None][-30:]
        if len(past) >= 10 and (k not in held or i - held[k][0] >= 7):
            held[k] = (i, tuple(np.quantile(past, [0.15, 0.85])))
        assert got[k, i] == (pytest.approx(held[k][1]) if k in held else (None, None))
    assert len(got) == len(rows)
