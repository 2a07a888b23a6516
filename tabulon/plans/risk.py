"""Market-risk analysis (fixtures F-prices, F-factors)."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.rng import duck_counter_normals_sql
from tabulon.operators import risk as R
from tabulon.operators import timeseries as TS
from tabulon.operators.clean import filter_min_count
from tabulon.plans import duck
from tabulon.plans import fixtures as fx
from tabulon.sources.files import parse_price_csv
from tabulon.sources.text import parse_price_tsv
from tabulon.session import cut, held, written

START, END = "1995-06-01", "2000-06-01"     # five years, both Thursdays
MIN_HISTORY = 260 * 5 + 10
FACTORS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
NF = len(FACTORS)
NUM_TRIALS, PARALLELISM, SEED = 10_000_000, 1_000, 1001
REPLICATES, P_VALUE, BOOT_SEED = 100, 0.05, 2024
CONFIDENCE = 0.05
WEIGHT_DIGITS = 8


def _fmt(v):
    return F.format_string("%s", v)


def price_tsv_lines(spark, sf_dir) -> DataFrame:
    f = fx.factor_prices(spark, sf_dir)
    return f.select("series", F.concat(F.date_format("dt", "MMM dd, yyyy"), F.lit("    "),
                                       F.col("value").cast("string")).alias("value"))


def price_csv_lines(spark, sf_dir) -> DataFrame:
    """Lines of one CSV file per instrument (header included), plus one
    saved error page per factor series."""
    p = fx.instrument_prices(spark, sf_dir)
    data = p.select(F.concat_ws(",", F.date_format("dt", "yyyy-MM-dd"), F.col("value").cast("string"),
                                F.lit("0")).alias("value"), F.concat("series", F.lit(".csv")).alias("file"), F.lit(1).alias("at"))
    heads = p.select("series").distinct().select(F.lit("Date,Close,Volume").alias("value"),
                                                 F.concat("series", F.lit(".csv")).alias("file"), F.lit(0).alias("at"))
    f = fx.factor_prices(spark, sf_dir)
    errs = f.select(F.concat(F.lit("<html><body>"), F.date_format("dt", "yyyy-MM-dd"), F.lit("</body></html>"))
                    .alias("value"), F.concat(F.lit("err-"), F.col("series"), F.lit(".csv")).alias("file"), F.lit(0).alias("at"))
    return data.unionByName(heads).unionByName(errs)


def instruments(spark, sf_dir) -> DataFrame:
    """Filled weekday histories of the instruments with enough history."""
    raw = filter_min_count(fx.instrument_prices(spark, sf_dir), "series", MIN_HISTORY)
    return _prepare(raw)


def factors(spark, sf_dir) -> DataFrame:
    raw = fx.factor_prices(spark, sf_dir).where(F.col("series").isin(FACTORS))
    return _prepare(raw)


def _prepare(raw: DataFrame) -> DataFrame:
    # the trimmed histories (series x days, small next to the order table they
    # come from) feed the calendar and both sides of the fill: build them once
    trimmed = cut(TS.trim_date_range(raw, "series", "dt", "value", START, END))
    cal = TS.weekday_calendar(trimmed, "series", START, END)
    return TS.asof_fill(trimmed, cal, "series", "dt", "value")


def instrument_returns(spark, sf_dir):
    return TS.rolling_return(instruments(spark, sf_dir), "series", "dt", "value")


def factor_matrix(spark, sf_dir):
    r = TS.rolling_return(factors(spark, sf_dir), "series", "dt", "value")
    return R.factor_matrix(r, "series", "idx", "ret", FACTORS)


def model(spark, sf_dir):
    """Trials and their portfolio returns under the full factor model: the
    regression of every instrument on the twelve features and an intercept.
    The mean weights are rounded to ``WEIGHT_DIGITS`` places, so that both
    engines of a check run the trials of one and the same model."""
    with held(factor_matrix(spark, sf_dir)) as fm:
        means, cov = R.covariance(fm, NF)
        weights = cut(R.ols_per_group(instrument_returns(spark, sf_dir), "series", "idx", "ret", R.feature_table(fm, "idx", NF)))
        wbar = R.mean_weights(weights, 1 + 3 * NF)
    wbar = wbar and [math.floor(w * 10**WEIGHT_DIGITS + 0.5) / 10**WEIGHT_DIGITS for w in wbar]
    trials = R.factor_scenarios(spark, means, cov, NUM_TRIALS, SEED, PARALLELISM, NF)
    return trials, R.portfolio_trial_returns(trials, wbar, NF)


def trial_returns(spark, sf_dir):
    """The (trial_id, ret) of all trials, written: 16 bytes a trial, computed
    once for all the passes over them."""
    return written(model(spark, sf_dir)[1])


def q_scan_price_tsv(spark, sf_dir):
    return parse_price_tsv(price_tsv_lines(spark, sf_dir), series="series")


def q_scan_price_csv(spark, sf_dir):
    return parse_price_csv(price_csv_lines(spark, sf_dir), at="at")


def q_filter_min_history(spark, sf_dir):
    raw = filter_min_count(fx.instrument_prices(spark, sf_dir), "series", MIN_HISTORY)
    return raw.groupBy("series").agg(F.count(F.lit(1)).alias("n"))


def q_trim_date_range(spark, sf_dir):
    return TS.trim_date_range(fx.instrument_prices(spark, sf_dir), "series", "dt", "value", START, END)


def q_weekday_calendar(spark, sf_dir):
    return TS.weekday_calendar(fx.instrument_prices(spark, sf_dir), "series", START, END)


def q_asof_fill(spark, sf_dir):
    return instruments(spark, sf_dir)


def q_rolling_return(spark, sf_dir):
    r = instrument_returns(spark, sf_dir)
    return r.select("series", "idx", F.round("ret", 6).alias("ret"))


def q_factor_returns(spark, sf_dir):
    r = TS.rolling_return(factors(spark, sf_dir), "series", "dt", "value")
    return r.select("series", "idx", F.round("ret", 6).alias("ret"))


def q_transpose_series(spark, sf_dir):
    fm = factor_matrix(spark, sf_dir)
    return fm.select("idx", *[F.round(f"f{i}", 6).alias(f"f{i}") for i in range(NF)])


def q_signed_power_features(spark, sf_dir):
    fm = factor_matrix(spark, sf_dir)
    ft = R.feature_table(fm, "idx", NF)
    return ft.select("idx", F.posexplode(F.slice("x", 2, 3 * NF)).alias("pos", "value")) \
             .select("idx", "pos", F.round("value", 6).alias("value"))


def q_covariance_matrix(spark, sf_dir):
    c = R.covariance_long(factor_matrix(spark, sf_dir), NF)
    return c.select("i", "j", F.round("cov", 9).alias("cov"))


def q_ols_per_group(spark, sf_dir):
    fm = factor_matrix(spark, sf_dir)
    return R.ols_per_group(instrument_returns(spark, sf_dir), "series", "idx", "ret", R.feature_table(fm, "idx", NF))


def _per_part(trials, cols):
    """Per part of the trial range: rows, and mean, least, largest and a
    checksum (rounded values times a weight of the trial) of each column --
    every trial checked in as many rows as the range has parts."""
    per = NUM_TRIALS // PARALLELISM
    aggs = [f(c).alias(f"{c}_{n}") for c in cols for n, f in (("mean", F.avg), ("min", F.min), ("max", F.max))]
    aggs += [F.sum(F.floor(F.col(c) * 1e5 + 0.5) * (F.col("trial_id") % 1009 + 1)).alias(f"{c}_sum") for c in cols]
    g = trials.groupBy((F.col("trial_id") / per).cast("bigint").alias("part")).agg(F.count(F.lit(1)).alias("n"), *aggs)
    return g.select("part", "n", *[F.round(f"{c}_{n}", 6).alias(f"{c}_{n}") for c in cols for n in ("mean", "min", "max")], *[f"{c}_sum" for c in cols])


def q_factor_scenarios(spark, sf_dir):
    trials, _ = model(spark, sf_dir)
    return _per_part(trials, [f"f{i}" for i in range(NF)])


def q_portfolio_trial_returns(spark, sf_dir):
    return _per_part(model(spark, sf_dir)[1], ["ret"])


def q_smallest_fraction(spark, sf_dir):
    """The lowest 5% of the trials, by return in millionths and trial id:
    what lies closer together is a tie, so that the last digits of a
    floating-point return never decide who belongs."""
    ret = model(spark, sf_dir)[1]
    ret = written(ret.select("trial_id", F.floor(F.col("ret") * 1e6 + 0.5).alias("micro")))
    n = ret.count()
    low = R.k_smallest_rows(ret, "micro", max(n // 20, 1), "trial_id") if n else ret
    return low.select("trial_id", (F.col("micro") / F.lit(1e6)).alias("ret"))


def _var(spark, sf_dir):
    return R.value_at_risk(trial_returns(spark, sf_dir))


def q_value_at_risk(spark, sf_dir):
    return _var(spark, sf_dir).select("k", F.round("var", 6).alias("var"))


def q_conditional_var(spark, sf_dir):
    return _var(spark, sf_dir).select("k", F.round("cvar", 6).alias("cvar"))


def _boot(spark, sf_dir):
    return R.bootstrap_tail_stats(trial_returns(spark, sf_dir), BOOT_SEED, REPLICATES)


def q_bootstrap_resample(spark, sf_dir):
    w = R.bootstrap_weights(trial_returns(spark, sf_dir).select("trial_id"), BOOT_SEED, REPLICATES)
    return w.groupBy("replicate").agg(F.sum("weight").cast("bigint").alias("n"),
                                      F.count(F.lit(1)).alias("distinct_rows"))


def q_bootstrap_interval(spark, sf_dir):
    st = _boot(spark, sf_dir)
    out = None
    for stat in ("var", "cvar"):
        iv = R.bootstrap_interval(st, stat, P_VALUE, REPLICATES).select(
            F.lit(stat).alias("stat"), F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"))
        out = iv if out is None else out.unionByName(iv)
    return out


def _backtest(spark, sf_dir):
    v = _var(spark, sf_dir).first()  # one number to the driver
    port = instrument_returns(spark, sf_dir).groupBy("idx").agg(F.avg("ret").alias("ret"))
    return R.count_failures(port, "ret", v["var"] if v else None)


def q_count_failures(spark, sf_dir):
    return _backtest(spark, sf_dir)


def q_kupiec_test(spark, sf_dir):
    k = R.kupiec_test(_backtest(spark, sf_dir), CONFIDENCE)
    return k.select("total", "failures", F.round("lr", 6).alias("lr"), F.round("p_value", 6).alias("p_value"))


def _kde(samples):
    lo, hi, h = R.sample_range_and_bandwidth(samples, "x")
    if lo is None:  # no samples
        return samples.select(F.lit(0).alias("pos"), F.lit(0.0).alias("point"), F.lit(0.0).alias("density")).where(F.lit(False))
    return R.kde_density(samples, "x", R.density_grid(lo, hi), h)


def q_kde_density(spark, sf_dir):
    """Density of a factor's returns."""
    d = _kde(factor_matrix(spark, sf_dir).select(F.col("f2").alias("x")))
    return d.select("pos", "point", F.round("density", 6).alias("density"))


def q_density_grid(spark, sf_dir):
    """Density of the trial returns, all of them."""
    d = _kde(trial_returns(spark, sf_dir).select(F.col("ret").alias("x")))
    return d.select("pos", "point", F.round("density", 6).alias("density"))


QUERIES = {
    "scan_price_tsv": q_scan_price_tsv,
    "scan_price_csv": q_scan_price_csv,
    "filter_min_history": q_filter_min_history,
    "trim_date_range": q_trim_date_range,
    "weekday_calendar": q_weekday_calendar,
    "asof_fill": q_asof_fill,
    "rolling_return": q_rolling_return,
    "factor_returns": q_factor_returns,
    "transpose_series": q_transpose_series,
    "signed_power_features": q_signed_power_features,
    "covariance_matrix": q_covariance_matrix,
    "ols_per_group": q_ols_per_group,
    "factor_scenarios": q_factor_scenarios,
    "portfolio_trial_returns": q_portfolio_trial_returns,
    "smallest_fraction": q_smallest_fraction,
    "value_at_risk": q_value_at_risk,
    "conditional_var": q_conditional_var,
    "bootstrap_resample": q_bootstrap_resample,
    "bootstrap_interval": q_bootstrap_interval,
    "count_failures": q_count_failures,
    "kupiec_test": q_kupiec_test,
    "kde_density": q_kde_density,
    "density_grid": q_density_grid,
}

# ---------------------------------------------------------------- oracle SQL
_S, _E = f"DATE '{START}'", f"DATE '{END}'"


def _prep_ctes(src: str, pre: str) -> dict:
    return {
        f"{pre}raw": src,
        f"{pre}kept": f"SELECT series, dt, value FROM {pre}raw WHERE dt >= {_S} AND dt <= {_E}",
        f"{pre}edge": f"SELECT series, MIN(dt) AS f, MAX(dt) AS l, arg_min(value, dt) AS fv, arg_max(value, dt) AS lv "
                      f"FROM {pre}kept GROUP BY series",
        f"{pre}trim": f"SELECT * FROM {pre}kept UNION ALL SELECT series, {_S}, fv FROM {pre}edge WHERE f <> {_S} "
                      f"UNION ALL SELECT series, {_E}, lv FROM {pre}edge WHERE l <> {_E}",
        f"{pre}cal": f"SELECT s.series, CAST(d.dt AS DATE) AS dt FROM (SELECT DISTINCT series FROM {pre}trim) s, "
                     f"generate_series({_S}, {_E} - INTERVAL 1 DAY, INTERVAL 1 DAY) d(dt) WHERE isodow(d.dt) <= 5",
        f"{pre}fill": f"SELECT c.series, c.dt, p.value FROM {pre}cal c ASOF LEFT JOIN {pre}trim p "
                      f"ON c.series = p.series AND c.dt >= p.dt",
        f"{pre}num": f"SELECT series, dt, value, ROW_NUMBER() OVER (PARTITION BY series ORDER BY dt) - 1 AS idx "
                     f"FROM {pre}fill",
        f"{pre}ret": f"SELECT a.series, a.idx, a.dt, (b.value - a.value) / a.value AS ret FROM {pre}num a "
                     f"JOIN {pre}num b ON a.series = b.series AND b.idx = a.idx + 9",
    }


_INSTR_SRC = ("SELECT * FROM fprices WHERE series IN (SELECT series FROM fprices GROUP BY series "
              f"HAVING COUNT(*) >= {MIN_HISTORY})")
_FACT_SRC = "SELECT * FROM ffactors WHERE series IN (" + ", ".join(f"'{f}'" for f in FACTORS) + ")"


def _fm_sql() -> str:
    cols = ", ".join(f"MAX(CASE WHEN series = '{f}' THEN ret END) AS f{i}" for i, f in enumerate(FACTORS))
    nn = " AND ".join(f"f{i} IS NOT NULL" for i in range(NF))
    return f"SELECT * FROM (SELECT idx, {cols} FROM f_ret GROUP BY idx) x WHERE {nn}"


def _chol_sql() -> str:
    """Cholesky factor entries l{i}_{j} of the factor covariance, closed form."""
    expr = {}
    for i in range(NF):
        for j in range(i + 1):
            s = " ".join(f"- l{i}_{k} * l{j}_{k}" for k in range(j))
            if i == j:
                expr[(i, j)] = f"sqrt(c{i}_{i} {s})"
            else:
                expr[(i, j)] = f"(c{i}_{j} {s}) / l{j}_{j}"
    # inline dependencies by nesting selects, one column per level
    covs = ", ".join(f"covar_samp(f{i}, f{j}) AS c{i}_{j}" for i in range(NF) for j in range(i + 1))
    means = ", ".join(f"AVG(f{i}) AS m{i}" for i in range(NF))
    sql = f"SELECT {covs}, {means} FROM fm"
    for (i, j), e in sorted(expr.items(), key=lambda kv: (kv[0][1], kv[0][0])):
        sql = f"SELECT *, {e} AS l{i}_{j} FROM ({sql}) q{i}{j}"
    return sql


def _scen_sql() -> str:
    fs = []
    for i in range(NF):
        terms = " + ".join(f"ch.l{i}_{k} * z{k}" for k in range(i + 1))
        fs.append(f"ch.m{i} + {terms} AS f{i}")
    z = duck_counter_normals_sql(f"SELECT range AS trial_id FROM range({NUM_TRIALS})", SEED, "trial_id", NF)
    return f"SELECT z.trial_id, {', '.join(fs)} FROM ({z}) z, chol ch"


def _feature_sql() -> list[str]:
    """The features over f0 .., the intercept first."""
    return ["1.0::DOUBLE", *[f"sign(f{i}) * f{i} * f{i}" for i in range(NF)], *[f"sign(f{i}) * sqrt(abs(f{i}))" for i in range(NF)],
            *[f"f{i}" for i in range(NF)]]


def _weight_ctes() -> dict:
    """The mean weights: instruments observed at the same dates share one
    design, so the mean of their regressions is the regression of their mean
    return. Normal equations (i, j, v), the right-hand side as column P, and
    one elimination step per CTE."""
    feats = _feature_sql()
    p = len(feats)
    c = {"xl": duck.kept(" UNION ALL ".join(f"SELECT idx, {i} AS i, {e} AS v FROM fm" for i, e in enumerate(feats))),
         "yb": duck.kept("SELECT idx, AVG(ret) AS y FROM i_ret GROUP BY idx"),
         "g0": duck.kept("SELECT a.i, b.i AS j, SUM(a.v * b.v) AS v FROM xl a JOIN xl b ON a.idx = b.idx JOIN yb ON a.idx = yb.idx GROUP BY a.i, b.i "
                         f"UNION ALL SELECT a.i, {p}, SUM(a.v * y) FROM xl a JOIN yb ON a.idx = yb.idx GROUP BY a.i")}
    for k in range(p):
        c[f"g{k + 1}"] = duck.kept(
            f"SELECT a.i, a.j, CASE WHEN a.i = {k} THEN a.v / d.v ELSE a.v - r.v * t.v / d.v END AS v FROM g{k} a "
            f"JOIN g{k} d ON d.i = {k} AND d.j = {k} JOIN g{k} r ON r.i = a.i AND r.j = {k} JOIN g{k} t ON t.i = {k} AND t.j = a.j")
    c["wv"] = duck.kept("SELECT " + ", ".join(
        f"MAX(CASE WHEN i = {i} THEN floor(v * {10**WEIGHT_DIGITS}::DOUBLE + 0.5::DOUBLE) / {10**WEIGHT_DIGITS}::DOUBLE END) AS w{i}" for i in range(p))
        + f" FROM g{p} WHERE j = {p}")
    c["tr"] = "SELECT s.trial_id, wv.w0 + " + " + ".join(f"wv.w{i} * ({e})" for i, e in enumerate(feats) if i) + " AS ret FROM scen s, wv"
    return c


def _ctes(**more) -> dict:
    c = dict(fprices=duck.F_PRICES, ffactors=duck.F_FACTORS)
    c.update(_prep_ctes(_INSTR_SRC, "i_"))
    c.update(_prep_ctes(_FACT_SRC, "f_"))
    c["fm"] = _fm_sql()
    c["chol"] = _chol_sql()
    c["scen"] = _scen_sql()
    c.update(_weight_ctes())
    c["var"] = ("SELECT MAX(k) AS k, MAX(ret) AS var, SUM(ret) / MAX(k) AS cvar FROM (SELECT ret, "
                "ROW_NUMBER() OVER (ORDER BY ret, trial_id) AS rn, GREATEST(COUNT(*) OVER () // 20, 1) AS k FROM tr) x "
                "WHERE rn <= k")
    c.update(more)
    return c


def _q(body, **more):
    return duck.with_ctes(body, **_ctes(**more))


def _per_part_sql(table: str, cols: list[str]) -> str:
    aggs = ", ".join([f"ROUND({f}({c}), 6) AS {c}_{n}" for c in cols for n, f in (("mean", "AVG"), ("min", "MIN"), ("max", "MAX"))]
                     + [f"CAST(SUM(CAST(floor({c} * 1e5::DOUBLE + 0.5::DOUBLE) AS BIGINT) * (trial_id % 1009 + 1)) AS BIGINT) AS {c}_sum" for c in cols])
    return f"SELECT CAST(trial_id // {NUM_TRIALS // PARALLELISM} AS BIGINT) AS part, COUNT(*) AS n, {aggs} FROM {table} GROUP BY 1"


_BT = ("SELECT COUNT(*) AS total, SUM(CASE WHEN p.ret < (SELECT var FROM var) THEN 1 ELSE 0 END) AS failures FROM "
       "(SELECT idx, AVG(ret) AS ret FROM i_ret GROUP BY idx) p")
_LR = ("GREATEST(-2.0 * ((CASE WHEN total - failures = 0 THEN 0 ELSE (total - failures) * ln(1 - {p}) END + "
       "CASE WHEN failures = 0 THEN 0 ELSE failures * ln({p}) END) - "
       "(CASE WHEN total - failures = 0 THEN 0 ELSE (total - failures) * ln(1 - failures / total) END + "
       "CASE WHEN failures = 0 THEN 0 ELSE failures * ln(failures / total) END)), 0.0)").format(p=CONFIDENCE)


def _kde_sql(samples: str) -> str:
    return ("SELECT g.pos, g.point, ROUND(AVG(exp(-0.5::DOUBLE * ((g.point - s.x) / b.h) * ((g.point - s.x) / b.h)) / b.h "
            f"* {1.0 / math.sqrt(2.0 * math.pi)!r}::DOUBLE), 6) AS density FROM ({samples}) s, "
            f"(SELECT 1.06 * STDDEV_POP(x) * POWER(COUNT(x), -0.2) AS h, MIN(x) AS lo, MAX(x) AS hi FROM ({samples}) y) b, "
            "LATERAL (SELECT CAST(i AS INTEGER) AS pos, ROUND(b.lo + i * (b.hi - b.lo) / 100.0, 5) AS point "
            "FROM range(100) r(i)) g GROUP BY g.pos, g.point")


def oracle() -> dict:
    return {
        "scan_price_tsv": duck.with_ctes("SELECT series, dt, value FROM f", f=duck.F_FACTORS),
        "scan_price_csv": duck.with_ctes("SELECT series, dt, value FROM p", p=duck.F_PRICES),
        "filter_min_history": duck.with_ctes(f"SELECT series, COUNT(*) AS n FROM p GROUP BY series HAVING COUNT(*) >= {MIN_HISTORY}",
                                             p=duck.F_PRICES),
        "trim_date_range": duck.with_ctes("SELECT series, dt, value FROM x_trim",
                                          **_prep_ctes(duck.F_PRICES, "x_")),
        "weekday_calendar": duck.with_ctes(
            f"SELECT s.series, CAST(d.dt AS DATE) AS dt FROM (SELECT DISTINCT series FROM p) s, "
            f"generate_series({_S}, {_E} - INTERVAL 1 DAY, INTERVAL 1 DAY) d(dt) WHERE isodow(d.dt) <= 5", p=duck.F_PRICES),
        "asof_fill": _q("SELECT series, dt, value FROM i_fill"),
        "rolling_return": _q("SELECT series, idx, ROUND(ret, 6) AS ret FROM i_ret"),
        "factor_returns": _q("SELECT series, idx, ROUND(ret, 6) AS ret FROM f_ret"),
        "transpose_series": _q("SELECT idx, " + ", ".join(f"ROUND(f{i}, 6) AS f{i}" for i in range(NF)) + " FROM fm"),
        "signed_power_features": _q(
            "SELECT idx, pos, ROUND(value, 6) + 0.0 AS value FROM (" + " UNION ALL ".join(
                [f"SELECT idx, {i} AS pos, sign(f{i}) * f{i} * f{i} AS value FROM fm" for i in range(NF)]
                + [f"SELECT idx, {NF + i} AS pos, sign(f{i}) * sqrt(abs(f{i})) AS value FROM fm" for i in range(NF)]
                + [f"SELECT idx, {2 * NF + i} AS pos, f{i} AS value FROM fm" for i in range(NF)]) + ") u"),
        "covariance_matrix": _q("SELECT i, j, ROUND(cov, 9) AS cov FROM (" + " UNION ALL ".join(
            f"SELECT {i} AS i, {j} AS j, covar_samp(f{i}, f{j}) AS cov FROM fm" for i in range(NF) for j in range(NF)) + ") c"),
        "factor_scenarios": _q(_per_part_sql("scen", [f"f{i}" for i in range(NF)])),
        "portfolio_trial_returns": _q(_per_part_sql("tr", ["ret"])),
        "smallest_fraction": _q("SELECT trial_id, micro / 1000000.0::DOUBLE AS ret FROM (SELECT trial_id, CAST(floor(ret * 1000000.0::DOUBLE + 0.5::DOUBLE) "
                                f"AS BIGINT) AS micro FROM tr) m ORDER BY micro, trial_id LIMIT {max(NUM_TRIALS // 20, 1)}"),
        "value_at_risk": _q("SELECT CAST(k AS BIGINT) AS k, ROUND(var, 6) AS var FROM var"),
        "conditional_var": _q("SELECT CAST(k AS BIGINT) AS k, ROUND(cvar, 6) AS cvar FROM var"),
        "count_failures": _q("SELECT total, CAST(failures AS BIGINT) AS failures FROM (" + _BT + ") b"),
        "kupiec_test": _q("SELECT total, CAST(failures AS BIGINT) AS failures, ROUND(lr, 6) AS lr, "
                          "ROUND(" + R.erfc_sql("sqrt(lr / 2.0)") + ", 6) AS p_value FROM (SELECT total, failures, "
                          + _LR + " AS lr FROM (" + _BT + ") b) k"),
        "kde_density": _q(_kde_sql("SELECT f2 AS x FROM fm")),
        "density_grid": _q(_kde_sql("SELECT x FROM sample"), sample=duck.kept("SELECT ret AS x FROM tr")),
    }
