"""Time series and risk operators against direct numpy/pandas computations."""

import datetime as dt
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabulon.operators import risk as R
from tabulon.operators import timeseries as TS


def test_trim_pads_start_and_end(spark):
    df = spark.createDataFrame([("s", dt.date(2020, 1, 3), 1.0), ("s", dt.date(2020, 1, 6), 2.0),
                                ("s", dt.date(2019, 12, 1), 9.0)], "series STRING, dt DATE, value DOUBLE")
    got = sorted(map(tuple, TS.trim_date_range(df, "series", "dt", "value", "2020-01-02", "2020-01-10").collect()))
    assert got == [("s", dt.date(2020, 1, 2), 1.0), ("s", dt.date(2020, 1, 3), 1.0),
                   ("s", dt.date(2020, 1, 6), 2.0), ("s", dt.date(2020, 1, 10), 2.0)]


def test_asof_fill_carries_weekend_prices_and_across_months(spark):
    prices = [("s", dt.date(2020, 1, 30), 1.0), ("s", dt.date(2020, 2, 1), 2.0),  # Saturday
              ("s", dt.date(2020, 4, 2), 3.0)]
    df = spark.createDataFrame(prices, "series STRING, dt DATE, value DOUBLE")
    cal = TS.weekday_calendar(df, "series", "2020-01-30", "2020-04-04")
    got = {r["dt"]: r["value"] for r in TS.asof_fill(df, cal, "series", "dt", "value").collect()}
    p = pd.Series({pd.Timestamp(d): v for _, d, v in prices}).sort_index()
    for d, v in got.items():
        exp = p[p.index <= pd.Timestamp(d)].iloc[-1]
        assert v == exp, d
    assert all(d.weekday() < 5 for d in got)
    assert got[dt.date(2020, 2, 3)] == 2.0 and got[dt.date(2020, 3, 31)] == 2.0 and got[dt.date(2020, 4, 3)] == 3.0


def test_rolling_return_matches_shift(spark):
    days = [d for d in pd.bdate_range("2021-03-01", periods=30)]
    vals = [100.0 + i * i for i in range(30)]
    df = spark.createDataFrame([("s", d.date(), v) for d, v in zip(days, vals)], "series STRING, dt DATE, value DOUBLE")
    got = {r["idx"]: r["ret"] for r in TS.rolling_return(df, "series", "dt", "value").collect()}
    exp = {i: (vals[i + 9] - vals[i]) / vals[i] for i in range(21)}
    assert got.keys() == exp.keys() and all(abs(got[i] - exp[i]) < 1e-12 for i in exp)


def test_k_smallest_is_exact(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=20000)
    x[:50] = x[50]  # ties
    df = spark.createDataFrame(pd.DataFrame({"trial_id": np.arange(len(x)), "ret": x}))
    for k in (1, 7, 1000, 19999, 20000):
        kth, s = R.k_smallest_summary(df, "ret", k, buckets=16, few=50)
        xs = np.sort(x)
        assert kth == xs[k - 1] and abs(s - xs[:k].sum()) < 1e-9


def test_k_smallest_of_heavy_ties(spark):
    """All equal, and a few values that hold nearly everything."""
    same = spark.range(5000).select(F.col("id").alias("trial_id"), F.lit(0.5).alias("ret"))
    assert R.k_smallest_summary(same, "ret", 250, few=10) == (0.5, 125.0)
    assert R.value_at_risk(same).first()[:] == (250, 0.5, 0.5)
    x = np.repeat([3.0, 1.0, 2.0, 1.5], [2000, 10, 1500, 1])
    df = spark.createDataFrame(pd.DataFrame({"trial_id": np.arange(len(x)), "ret": x}))
    for k in (1, 10, 11, 12, 1511, 1512, 3511):
        kth, s = R.k_smallest_summary(df, "ret", k, few=3)
        assert (kth, s) == (np.sort(x)[k - 1], np.sort(x)[:k].sum())
    rows = R.k_smallest_rows(df, "ret", 700, "trial_id").toPandas().sort_values(["ret", "trial_id"])
    want = df.toPandas().sort_values(["ret", "trial_id"]).head(700)
    assert rows["trial_id"].tolist() == want["trial_id"].tolist()


def test_no_trials(spark):
    none = R.factor_scenarios(spark, None, None, 100, 1, 2, 2)
    ret = R.portfolio_trial_returns(none, None, 2)
    assert none.columns == ["trial_id", "f0", "f1"] and ret.count() == 0
    assert R.value_at_risk(ret).count() == 0 and R.bootstrap_tail_stats(ret, 1, 3).count() == 0


def test_singular_covariance(spark):
    cov = np.array([[0.04, 0.04], [0.04, 0.04]])
    assert np.allclose(R.cholesky(cov) @ R.cholesky(cov).T, cov)


def test_value_at_risk(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([5, -3, 2, -10, 7, 1] * 10)], "trial_id BIGINT, ret DOUBLE")
    r = R.value_at_risk(df).first()
    assert r["k"] == 3 and r["var"] == -10.0 and r["cvar"] == -10.0


def test_bootstrap_interval_clamps(spark):
    st = spark.createDataFrame([(0, 1.5)], "replicate INT, var DOUBLE")
    r = R.bootstrap_interval(st, "var", 0.05, 1).first()
    assert r["lower"] == 1.5 and r["upper"] == 1.5


def test_bootstrap_tail_is_exact(spark):
    """Against the expanded multisets, smooth returns and all-equal ones."""
    rng = np.random.default_rng(5)
    for x in (rng.normal(size=3000), np.full(3000, 0.25), np.round(rng.normal(size=900), 1), np.array([1.0])):
        df = spark.createDataFrame(pd.DataFrame({"trial_id": np.arange(len(x)), "ret": x}))
        got = {r["replicate"]: r for r in R.bootstrap_tail_stats(df, 9, 5, tail=1.0).collect()}
        w = R.bootstrap_weights(df, 9, 5).toPandas()
        for rep, part in w.groupby("replicate"):
            vals = np.sort(np.repeat(part["ret"].to_numpy(), part["weight"].to_numpy()))
            k = max(len(vals) // 20, 1)
            r = got.pop(rep)
            assert (r["n"], r["k"], r["var"]) == (len(vals), k, vals[k - 1]) and abs(r["cvar"] - vals[:k].mean()) < 1e-9
        assert not got


def test_bootstrap_tail_has_the_law_of_single_draws(spark):
    """Means and spreads over many replicates, tail draws against all single
    draws; the rank leaves the first band of the small table often."""
    rng = np.random.default_rng(8)
    for size, reps in ((60, 400), (2000, 150)):
        x = rng.normal(size=size)
        df = spark.createDataFrame(pd.DataFrame({"trial_id": np.arange(size), "ret": x}))
        a, b = (R.bootstrap_tail_stats(df, seed, reps, tail=tail).toPandas() for seed, tail in ((11, 0.07), (12, 1.0)))
        assert sorted(a.replicate) == sorted(b.replicate) == list(range(reps))
        assert (a.k == np.maximum(a.n // 20, 1)).all() and a["var"].isin(x).all() and (a.cvar <= a["var"] + 1e-12).all()
        for c in ("n", "var", "cvar"):
            se = math.sqrt(a[c].var() / reps + b[c].var() / reps)
            assert abs(a[c].mean() - b[c].mean()) < 4 * se, c
            assert 0.7 < a[c].std() / b[c].std() < 1.4, c


def test_a_rank_beyond_the_first_band_widens_it(spark):
    """With a first band far below the 5% rank every replicate needs the
    next one: the rank is taken from the spread draws, exactly."""
    x = np.arange(400.0)
    df = spark.createDataFrame(pd.DataFrame({"trial_id": np.arange(400), "ret": x}))
    out = R.bootstrap_tail_stats(df, 3, 30, tail=0.005).toPandas()
    assert len(out) == 30 and abs(out["var"].mean() - 19) < 4 and (out["var"] > 2).all()
    spread = R.spread_draws(df.select(F.col("trial_id").alias("_id"), F.col("ret").alias("_x")), {0: 4000, 1: 0, 2: 8000}, 5)
    n = {r["replicate"]: (r["w"], r["d"]) for r in spread.groupBy("replicate").agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("d")).collect()}
    assert {r: w for r, (w, _) in n.items()} == {0: 4000, 2: 8000} and all(d == 400 for _, d in n.values())


def test_bootstrap_weights_are_poisson(spark):
    df = spark.range(20000).select(F.col("id").alias("trial_id"))
    w = R.bootstrap_weights(df, 3, 2).groupBy("replicate").agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("d")).collect()
    assert all(abs(r["n"] - 20000) < 600 and abs(r["d"] - 20000 * (1 - math.exp(-1))) < 400 for r in w)


def test_kupiec_zero_failures_and_pvalue(spark):
    c = spark.createDataFrame([(100, 0), (250, 20)], "total BIGINT, failures BIGINT")
    r = R.kupiec_test(c, 0.05).collect()
    lr0 = -2 * (100 * math.log(0.95) - 0.0)
    assert abs(r[0]["lr"] - lr0) < 1e-9
    t, x, p = 250.0, 20.0, 0.05
    lr1 = -2 * ((t - x) * math.log(1 - p) + x * math.log(p) - ((t - x) * math.log(1 - x / t) + x * math.log(x / t)))
    assert abs(r[1]["lr"] - lr1) < 1e-9
    assert abs(r[1]["p_value"] - math.erfc(math.sqrt(lr1 / 2))) < 1e-6


def test_ols_matches_numpy(spark):
    rng = np.random.default_rng(1)
    n, p = 200, 4
    x = rng.normal(size=(n, p))
    feats = spark.createDataFrame([(i, [1.0] + list(map(float, x[i]))) for i in range(n)], "idx BIGINT, x ARRAY<DOUBLE>")
    rows = []
    for s in ("a", "b"):
        beta = rng.normal(size=p + 1)
        y = x @ beta[1:] + beta[0] + rng.normal(scale=0.01, size=n)
        rows += [(s, i, float(y[i])) for i in range(n)]
    yd = spark.createDataFrame(rows, "series STRING, idx BIGINT, ret DOUBLE")
    got = R.ols_per_group(yd, "series", "idx", "ret", feats).toPandas()
    for s in ("a", "b"):
        yy = np.array([r[2] for r in rows if r[0] == s])
        exp = np.linalg.lstsq(np.c_[np.ones(n), x], yy, rcond=None)[0]
        c = got[got.series == s].sort_values("pos")["coef"].to_numpy()
        assert np.allclose(c, exp, atol=1e-8)
        resid = yy - np.c_[np.ones(n), x] @ c
        assert np.allclose(np.c_[np.ones(n), x].T @ resid, 0, atol=1e-7)


def test_ols_of_different_dates_and_singular_designs(spark):
    """One design per set of dates; a repeated feature gives the least-norm
    solution; a key without dates in common has no rows."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 2))
    feats = np.c_[np.ones(60), x, x[:, 1]]
    fd = spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(feats)], "idx BIGINT, x ARRAY<DOUBLE>")
    dates = {"a": range(60), "b": range(60), "c": range(10, 60), "d": range(0, 60, 2), "e": range(100, 110)}
    rows = [(k, i, float(rng.normal())) for k, v in dates.items() for i in v] + [("a", 200, None)]
    got = R.ols_per_group(spark.createDataFrame(rows, "series STRING, idx BIGINT, ret DOUBLE"), "series", "idx", "ret", fd).toPandas()
    assert set(got.series) == set("abcd")
    for k in "abcd":
        own = [(i, r) for s, i, r in rows if s == k and i < 60]
        want = np.linalg.lstsq(feats[[i for i, _ in own]], np.array([r for _, r in own]), rcond=None)[0]
        assert np.allclose(got[got.series == k].sort_values("pos")["coef"], want, atol=1e-8)


def test_portfolio_return_is_the_mean_of_the_instruments(spark):
    """The mean weights on the features equal the mean over instruments of
    their own returns, all features in play."""
    rng = np.random.default_rng(4)
    nf, n = 2, 80
    f = rng.normal(size=(n, nf)) / 10
    fm = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(f)], "idx BIGINT, f0 DOUBLE, f1 DOUBLE")
    rows = [(k, i, float(rng.normal())) for k in "abc" for i in range(n)]
    w = R.ols_per_group(spark.createDataFrame(rows, "series STRING, idx BIGINT, ret DOUBLE"), "series", "idx", "ret", R.feature_table(fm, "idx", nf))
    trials = R.factor_scenarios(spark, np.zeros(2), np.eye(2) / 100, 200, 3, 2, nf)
    mean = R.mean_weights(w, 1 + 3 * nf)
    assert all(abs(v) > 1e-6 for v in mean)
    got = R.portfolio_trial_returns(trials, mean, nf).toPandas().set_index("trial_id")["ret"]
    each = w.toPandas().pivot(index="series", columns="pos", values="coef").to_numpy()
    t = trials.toPandas().set_index("trial_id")
    v = t[["f0", "f1"]].to_numpy()
    feats = np.c_[np.ones(200), np.sign(v) * v * v, np.sign(v) * np.sqrt(abs(v)), v]
    assert np.allclose(got.loc[t.index], (feats @ each.T).mean(1), atol=1e-9)


def test_normals_are_normal_and_independent(spark):
    from tabulon.functions.rng import counter_normals
    z = counter_normals(spark.range(40_000), 7, "id", 4).toPandas()[[f"z{i}" for i in range(4)]].to_numpy()
    assert np.allclose(z.mean(0), 0, atol=0.02) and np.allclose(np.cov(z.T), np.eye(4), atol=0.03)
    assert abs((z ** 4).mean() - 3) < 0.15 and abs((z < -1.6448536).mean() - 0.05) < 0.004
    assert np.allclose(np.corrcoef(z[:-1, 0], z[1:, 0])[0, 1], 0, atol=0.02)


def test_kde_of_many_samples_within_its_bound(spark):
    rng = np.random.default_rng(6)
    xs = np.concatenate([rng.normal(size=3000), rng.normal(8, 0.1, size=500), [0.0] * 50])
    df = spark.createDataFrame(pd.DataFrame({"x": xs})).union(spark.createDataFrame([(None,)], "x DOUBLE"))
    lo, hi, h = R.sample_range_and_bandwidth(df, "x")
    for order in (2, 4, 8):
        d = R.kde_density(df, "x", R.density_grid(lo, hi, 40), h, order=order).orderBy("pos").collect()
        direct = [np.mean(np.exp(-0.5 * ((r["point"] - xs) / h) ** 2) / (h * math.sqrt(2 * math.pi))) for r in d]
        worst = max(abs(r["density"] - e) for r, e in zip(d, direct))
        assert worst <= R.kde_error_bound(h, order=order) + 1e-14, order
    assert [R.hermite(m) for m in range(4)] == [[1], [0, 1], [-1, 0, 1], [0, -3, 0, 1]]


def test_kde_matches_direct(spark):
    xs = [0.1, 0.4, -0.3, 0.25, 0.9, -1.2]
    df = spark.createDataFrame([(v,) for v in xs], "x DOUBLE")
    lo, hi, h = R.sample_range_and_bandwidth(df, "x")
    assert abs(h - 1.06 * np.std(xs) * len(xs) ** -0.2) < 1e-12
    d = R.kde_density(df, "x", R.density_grid(lo, hi, 10), h).orderBy("pos").collect()
    for r in d:
        exp = np.mean(np.exp(-0.5 * ((r["point"] - np.array(xs)) / h) ** 2) / (h * math.sqrt(2 * math.pi)))
        assert abs(r["density"] - exp) < 1e-12


def test_scenarios_have_target_covariance(spark):
    means = np.array([0.01, -0.02])
    cov = np.array([[0.04, 0.01], [0.01, 0.09]])
    t = R.factor_scenarios(spark, means, cov, 20000, 5, 4, 2).toPandas()
    assert np.allclose(t[["f0", "f1"]].mean().to_numpy(), means, atol=0.01)
    assert np.allclose(np.cov(t[["f0", "f1"]].to_numpy().T), cov, atol=0.01)
