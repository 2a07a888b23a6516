"""Market-risk jobs on long tables: factor features, regression weights,
Monte Carlo scenarios, VaR / CVaR, bootstrap intervals, backtest, density.

Only tiny model state reaches the driver (a factor covariance matrix, its
Cholesky factor, averaged regression weights, quantile bounds, one row per
bootstrap replicate); VaR and bootstrap statistics run eagerly for it. Trial
tables are generated in-plan with ``spark.range`` and counter-based normals,
so they are identical on any cluster layout and after task retries.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabulon.functions.rng import counter_normals, fast_uniform
from tabulon.functions.stats import signed_sqrt, signed_square
from tabulon.operators.windows import dense_index
from tabulon.session import cut, held


# ---------------------------------------------------------------- features
def factor_matrix(returns: DataFrame, key: str, idx: str, ret: str, factors: list[str]) -> DataFrame:
    """(idx, f0 .. fn-1): factor returns side by side per date index
    (a pivot with the factor list given, so no discovery pass)."""
    p = returns.where(F.col(key).isin(factors)).groupBy(idx).pivot(key, factors).agg(F.first(ret))
    return p.select(idx, *[F.col(f"`{f}`").alias(f"f{i}") for i, f in enumerate(factors)]) \
            .dropna()


def featurize(cols: list) -> list[Column]:
    """Signed squares, signed square roots, then the raw values."""
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    return [signed_square(c) for c in cs] + [signed_sqrt(c) for c in cs] + cs


def feature_table(fm: DataFrame, idx: str, n_factors: int) -> DataFrame:
    """(idx, x ARRAY<DOUBLE>) with x = [1, features...] (intercept first)."""
    feats = featurize([f"f{i}" for i in range(n_factors)])
    return fm.select(idx, F.array(F.lit(1.0), *feats).alias("x"))


# ---------------------------------------------------------------- moments
def covariance(fm: DataFrame, n_factors: int) -> tuple[np.ndarray, np.ndarray]:
    """Sample means and sample covariance of the factor columns (one
    aggregate pass; returns n and n x n numbers to the driver), or
    (None, None) where there are too few rows for a covariance."""
    cols = [f"f{i}" for i in range(n_factors)]
    aggs = [F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]
    aggs += [F.covar_samp(cols[i], cols[j]).alias(f"c{i}_{j}") for i in range(n_factors) for j in range(i, n_factors)]
    r = fm.agg(*aggs).first()
    if any(r[f"c{i}_{i}"] is None for i in range(n_factors)):
        return None, None
    means = np.array([r[f"m{i}"] for i in range(n_factors)])
    cov = np.zeros((n_factors, n_factors))
    for i in range(n_factors):
        for j in range(i, n_factors):
            cov[i, j] = cov[j, i] = r[f"c{i}_{j}"]
    return means, cov


def covariance_long(fm: DataFrame, n_factors: int) -> DataFrame:
    """(i, j, cov) sample covariances as a table (no driver step)."""
    cols = [f"f{i}" for i in range(n_factors)]
    aggs = [F.covar_samp(cols[i], cols[j]).alias(f"c{i}_{j}") for i in range(n_factors) for j in range(n_factors)]
    wide = fm.agg(*aggs)
    st = ", ".join(f"{i}, {j}, c{i}_{j}" for i in range(n_factors) for j in range(n_factors))
    return wide.selectExpr(f"stack({n_factors * n_factors}, {st}) AS (i, j, cov)")


# ---------------------------------------------------------------- regression
def ols_per_group(y: DataFrame, key: str, idx: str, yv: str, features: DataFrame) -> DataFrame:
    """(key, pos, coef): least squares of y on x per key, intercept at pos 0.

    A multi-response system: keys observed at the same dates share one design.
    A key's dates are known by their count and two hash sums; each design is
    summed once, from the dates of its smallest key (one aggregate of the
    upper triangle, no row per entry), and inverted once; the right-hand
    sides X'y are one aggregate of p sums per key; a key's coefficients are
    the products of the two. Singular designs give the least-norm solution.
    Dates without a response or without features are left out; a date given
    twice for a key counts once in its design and is an error of the input."""
    p = features.select(F.size("x").alias("p")).first()
    out = y.schema[key].dataType.simpleString()
    if p is None:
        return y.sparkSession.createDataFrame([], f"`{key}` {out}, pos BIGINT, coef DOUBLE")
    p = p["p"]
    x = features.select(F.col(idx).alias("_i"), F.col("x").alias("_x"))
    j = y.where(F.col(yv).isNotNull()).select(F.col(key).alias("_k"), F.col(idx).alias("_i"), F.col(yv).alias("_y")).join(x, "_i")
    sums = [F.sum(F.col("_x")[i] * F.col("_y")).alias(f"b{i}") for i in range(p)]
    dates = [F.count(F.lit(1)).alias("d0"), F.sum(F.xxhash64("_i").cast("decimal(38,0)")).alias("d1"), F.sum(F.hash("_i").cast("bigint")).alias("d2")]
    keys = cut(j.groupBy("_k").agg(*dates, *sums))
    own = ["d0", "d1", "d2"]
    designs = keys.groupBy(*own).agg(F.min("_k").alias("_k"))
    pairs = [(a, b) for a in range(p) for b in range(a, p)]
    upper = j.join(designs, "_k").groupBy(*own).agg(*[F.sum(F.col("_x")[a] * F.col("_x")[b]).alias(f"m{a}_{b}") for a, b in pairs])

    def invert(parts):
        import pandas as pd

        for pdf in parts:  # one row per design
            inverses = []
            for row in pdf[[f"m{a}_{b}" for a, b in pairs]].to_numpy(float):
                m = np.zeros((p, p))
                for (a, b), v in zip(pairs, row):
                    m[a, b] = m[b, a] = v
                scale = 1 / np.sqrt(np.where(np.diag(m) > 0, np.diag(m), 1.0))  # columns of one length
                inverses.append((np.linalg.pinv(m * scale * scale[:, None], rcond=1e-13, hermitian=True) * scale * scale[:, None]).tolist())
            yield pd.DataFrame({**{c: pdf[c] for c in own}, "inv": inverses})

    inverse = upper.mapInPandas(invert, "d0 bigint, d1 decimal(38,0), d2 bigint, inv array<array<double>>")
    rhs = F.array(*[f"b{i}" for i in range(p)])
    coefs = F.transform("inv", lambda r: F.aggregate(F.zip_with(r, rhs, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v))
    solved = keys.join(inverse, own).select(F.col("_k").alias(key), F.posexplode(coefs).alias("pos", "coef"))
    return solved.select(key, F.col("pos").cast("bigint").alias("pos"), "coef")


def mean_weights(weights: DataFrame, n_pos: int) -> list[float] | None:
    """Average weight vector over instruments (n_pos numbers to the driver).
    Trial returns are linear in the weights, so the mean of instrument
    returns equals one dot product with these. None without instruments."""
    n = weights.select(weights.columns[0]).distinct().count()
    if n == 0:
        return None
    sums = dict(weights.groupBy("pos").agg(F.sum("coef").alias("s")).select("pos", "s").collect())
    return [float(sums.get(p, 0.0)) / n for p in range(n_pos)]


# ---------------------------------------------------------------- scenarios
def cholesky(cov: np.ndarray) -> np.ndarray:
    """A matrix L with L L' = cov: the Cholesky factor, or, where the
    covariance is singular, the square root of its eigenvalues."""
    try:
        return np.linalg.cholesky(cov)
    except np.linalg.LinAlgError:
        values, vectors = np.linalg.eigh(cov)
        q, r = np.linalg.qr((vectors * np.sqrt(np.clip(values, 0, None))).T)
        return (r * np.where(np.diag(r) < 0, -1.0, 1.0)[:, None]).T


def factor_scenarios(spark, means, cov, num_trials: int, seed: int, partitions: int, n_factors: int) -> DataFrame:
    """(trial_id, f0 .. fn-1): multivariate normal draws mean + L z with L
    the Cholesky factor of ``cov`` (literals) and z counter-based normals.
    No trials without a covariance."""
    if means is None:
        return spark.range(0).select(F.col("id").alias("trial_id"), *[F.lit(0.0).alias(f"f{i}") for i in range(n_factors)])
    n = len(means)
    chol = cholesky(cov)
    t = spark.range(0, num_trials, 1, partitions).withColumnRenamed("id", "trial_id")
    t = counter_normals(t, seed, "trial_id", n)
    cols = []
    for i in range(n):
        e = F.lit(float(means[i]))
        for k in range(i + 1):
            e = e + F.lit(float(chol[i, k])) * F.col(f"z{k}")
        cols.append(e.alias(f"f{i}"))
    return t.select("trial_id", *cols)


def portfolio_trial_returns(trials: DataFrame, w: list[float] | None, n_factors: int) -> DataFrame:
    """(trial_id, ret): w . [1, features(trial)] with the averaged weights;
    none without weights."""
    if w is None:
        return trials.where(F.lit(False)).select("trial_id", F.lit(0.0).alias("ret"))
    feats = featurize([f"f{i}" for i in range(n_factors)])
    ret = F.lit(w[0])
    for k, f in enumerate(feats, start=1):
        ret = ret + F.lit(w[k]) * f
    return trials.select("trial_id", ret.alias("ret"))


# ---------------------------------------------------------------- tails
def value_histogram(df: DataFrame, col: str, lo: float, hi: float, buckets: int) -> list:
    """Rows (n, s, least, most) of the non-empty ones of ``buckets`` equal
    cuts of [lo, hi], in order: one partially aggregated pass."""
    at = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(hi - lo) * buckets), F.lit(buckets - 1))
    rows = df.groupBy(at.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.sum(col).alias("s"), F.min(col).alias("least"), F.max(col).alias("most"))
    return sorted(rows.collect(), key=lambda r: r["b"])


def value_range(df: DataFrame, col: str) -> tuple[int, float, float]:
    """(rows with a value, least, largest) in one pass."""
    r = df.agg(F.count(col).alias("n"), F.min(F.col(col).cast("double")).alias("lo"), F.max(F.col(col).cast("double")).alias("hi")).first()
    return r["n"], r["lo"], r["hi"]


def k_smallest_summary(df: DataFrame, col: str, k: int, buckets: int = 4096, few: int = 20_000,
                       given: tuple[int, float, float] | None = None) -> tuple[float, float]:
    """Exact (k-th smallest value, sum of the k smallest) without sorting the
    table or gathering it in one task.

    A histogram of the range counts and sums its buckets; the bucket that
    holds rank k becomes the range, until it holds ``few`` rows at most,
    which come to the driver as values with counts, or one value only, which
    counts as value times count. Every round narrows: the least and the most
    value of a range lie in different buckets. ``given`` is the table's
    ``value_range``, if it is known. (nan, nan) for no rows."""
    x = F.col(col)
    band = df.where(x.isNotNull()).select(x.cast("double").alias(col))
    m, lo, hi = given or value_range(band, col)
    if m == 0 or k <= 0:
        return float("nan"), float("nan")
    rank, below = min(k, m), 0.0
    while m > few and lo < hi:
        for b in value_histogram(band, col, lo, hi, buckets):
            if rank <= b["n"]:
                break
            rank, below = rank - b["n"], below + b["s"]
        m, lo, hi = b["n"], b["least"], b["most"]
        band = band.where(F.col(col).between(F.lit(lo), F.lit(hi)))
    if lo == hi:
        return lo, below + rank * lo
    for value, count in sorted((r[col], r["count"]) for r in band.groupBy(col).count().collect()):
        take = min(count, rank)
        rank, below = rank - take, below + take * value
        if rank == 0:
            return value, below
    raise AssertionError("rank beyond the table")


def k_smallest_rows(df: DataFrame, col: str, k: int, tie: str) -> DataFrame:
    """The k rows with the smallest ``col``, of equal ones those with the
    smallest ``tie``: two order statistics and a filter, no sort."""
    with held(df.select(col, tie)) as t:
        kth, _ = k_smallest_summary(t, col, k)
        below, at = F.col(col) < F.lit(kth), F.col(col) == F.lit(kth)
        n_below = t.agg(F.count_if(below).alias("n")).first()["n"]
        last, _ = k_smallest_summary(t.where(at), tie, k - n_below)
    return df.where(below | (at & (F.col(tie) <= F.lit(last))))


def value_at_risk(trials: DataFrame, col: str = "ret") -> DataFrame:
    """(k, var, cvar): the largest of the lowest k = max(n / 20, 1) values,
    and their mean; no row for no trials. Three passes: count and range, one
    histogram, the rows of the bucket that holds rank k."""
    spark = trials.sparkSession
    schema = "k BIGINT, var DOUBLE, cvar DOUBLE"
    with held(trials.select(col)) as t:
        found = value_range(t, col)
        if found[0] == 0:
            return spark.createDataFrame([], schema)
        k = max(found[0] // 20, 1)
        kth, s = k_smallest_summary(t, col, k, given=found)
    return spark.createDataFrame([(int(k), kth, s / k)], schema)


# Poisson(1) inverse-CDF cut points: P(K <= j) for j = 0..15 (a rule, not a table).
POISSON1_CDF = [math.exp(-1.0) * sum(1.0 / math.factorial(i) for i in range(j + 1)) for j in range(16)]


def poisson1(u: Column) -> Column:
    """Poisson(1) count from a uniform: the number of CDF cut points <= u."""
    e = F.lit(0)
    for c in POISSON1_CDF:
        e = e + (u >= F.lit(c)).cast("int")
    return e


def bootstrap_weights(trials: DataFrame, seed: int, replicates: int, id_col: str = "trial_id") -> DataFrame:
    """(replicate, id, weight): Poisson(1) multiplicities per (row, replicate)
    -- resampling with replacement at fraction 1.0, one pass, no per-replicate
    job. Rows with weight 0 are dropped."""
    r = trials.select("*", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate"))
    r = r.withColumn("_u", fast_uniform(seed, id_col, "replicate"))
    # weight > 0 exactly when u >= P(K = 0); filtering on u keeps the pushed-
    # down predicate to one comparison instead of inlining all cut points
    r = r.where(F.col("_u") >= F.lit(POISSON1_CDF[0]))
    return r.withColumn("weight", poisson1(F.col("_u"))).drop("_u")


def tail_bands(df: DataFrame, col: str, tail: float) -> tuple[list[tuple[float, float, int]], tuple[float, float]]:
    """Bands (least, largest, rows) of the values from the lowest up, and the
    part of the first that surely holds most replicates' ranks (about the 3%
    to the 7% quantile). The first band holds the share ``tail`` of the rows
    at least, the next a quarter, the last the rest. From one histogram; it
    steers the work, never the law of the result."""
    n, lo, hi = value_range(df, col)
    if not n or lo == hi or tail >= 1:
        return ([(lo, hi, n)] if n else []), (lo or 0.0, hi or 0.0)
    bands, seen, count, fine, first, ends = [], 0, 0, [None, None], None, [tail, max(tail, 0.25), 2.0]
    rows = value_histogram(df, col, lo, hi, 4096)
    for b in rows:
        first = b["least"] if first is None else first
        seen, count = seen + b["n"], count + b["n"]
        if fine[0] is None and seen >= 0.03 * n:
            fine[0] = b["least"]
        if fine[1] is None and seen >= 0.07 * n:
            fine[1] = b["most"]
        if seen >= ends[len(bands)] * n or b is rows[-1]:
            bands.append((first, b["most"], count))
            first, count = None, 0
    return bands, (fine[0], fine[1])


def tail_of_weighted(draw, rows: DataFrame, totals: dict[int, int], fine: tuple[float, float], cuts: int = 200) -> list:
    """Rows (replicate, n, k, var, cvar) of the replicates whose rank k =
    max(n / 20, 1) lies in ``draw(rows)`` (replicate, _x, weight), which holds
    the lowest values of each; n is the replicate's size from ``totals``.

    Values are cut into ordered buckets, fine over the range ``fine``; one
    pass sums the weights per (replicate, bucket), a running sum over these
    few rows finds the bucket of rank k, and only the rows of such buckets
    are drawn again, summed per value (ties are one row) and ordered: no task
    holds more than one bucket. ``draw`` gives the same weights every time."""
    spark = rows.sparkSession
    start, end = fine
    step = F.floor((F.col("_x") - F.lit(start)) / F.lit((end - start) or 1.0) * cuts).cast("int")
    bucket = F.when(F.col("_x") < start, -1).when(F.col("_x") >= end, cuts).otherwise(F.least(step, F.lit(cuts - 1)))
    rows = rows.withColumn("_b", bucket)
    order = Window.partitionBy("replicate").orderBy("_b")
    sizes = F.broadcast(spark.createDataFrame([(r, int(n), max(int(n) // 20, 1)) for r, n in totals.items()], "replicate INT, n BIGINT, k BIGINT"))
    sums = draw(rows).groupBy("replicate", "_b").agg(F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("_x")).alias("s"))
    per = sums.join(sizes, "replicate").select("replicate", "n", "k", "_b", "w", (F.sum("w").over(order) - F.col("w")).alias("before"),
                                               (F.sum("s").over(order) - F.col("s")).alias("s_before"))
    hits = per.where((F.col("before") < F.col("k")) & (F.col("k") <= F.col("before") + F.col("w"))).drop("w")
    with held(hits) as hit:  # one row per replicate
        inner = rows.join(F.broadcast(hit.select("_b").distinct()), "_b", "left_semi")
        drawn = draw(inner).join(F.broadcast(hit), ["replicate", "_b"])
        keys = ["replicate", "n", "k", "before", "s_before"]
        drawn = drawn.groupBy(*keys, "_x").agg(F.sum("weight").alias("w"))
        prev = F.col("before") + F.sum("w").over(Window.partitionBy("replicate").orderBy("_x")) - F.col("w")
        drawn = drawn.withColumn("prev", prev).where("prev < k")
        take = F.least(F.col("w"), F.col("k") - F.col("prev"))
        out = drawn.groupBy(*keys).agg(F.max("_x").alias("var"), F.sum(take * F.col("_x")).alias("s"))
        out = out.select("replicate", "n", "k", "var", ((F.col("s_before") + F.col("s")) / F.col("k")).alias("cvar"))
        return [tuple(r) for r in out.collect()]  # as many rows as replicates


def spread_draws(rows: DataFrame, counts: dict[int, int], seed: int) -> DataFrame:
    """(replicate, _x, weight): per replicate ``counts`` draws with
    replacement among ``rows(_id, _x)`` -- the weights of the rows given
    their sum, which Poisson weights have as well."""
    spark = rows.sparkSession
    numbered = dense_index(rows.select(F.struct("_x", "_id").alias("_row")), "_row", "_at")
    size = numbered.agg((F.max("_at") + 1).alias("n")).first()["n"]
    picks = None
    for r, c in counts.items():
        at = F.floor(fast_uniform(seed, F.lit(r), F.col("id")) * F.lit(size)).cast("bigint")
        more = spark.range(int(c)).select(F.lit(r).cast("int").alias("replicate"), at.alias("_at"))
        picks = more if picks is None else picks.unionByName(more)
    drawn = picks.groupBy("replicate", "_at").agg(F.count(F.lit(1)).cast("int").alias("weight"))
    return drawn.join(numbered, "_at").select("replicate", F.col("_row._x").alias("_x"), "weight")


def bootstrap_tail_stats(trials: DataFrame, seed: int, replicates: int, col: str = "ret",
                         id_col: str = "trial_id", cuts: int = 200, tail: float = 0.07) -> DataFrame:
    """(replicate, n, k, var, cvar) of each bootstrap replicate.

    Per replicate, k = max(n_b / 20, 1) of the resampled multiset; VaR is its
    k-th smallest value, CVaR the mean of the k smallest. Each row's weight
    is Poisson(1); the sum of the weights of m rows is Poisson(m). So only
    the rows of the lowest band (``tail_bands``) are drawn singly; a higher
    band of m rows contributes one Poisson(m) draw per replicate to n_b. A
    replicate whose rank lies beyond the lowest band widens it: the next
    band's draw is spread over its rows, each equally likely, which is the law
    of Poisson weights given their sum. The joint law is that of single
    draws for all rows (``tail`` = 1 draws them so); an empty replicate
    (possible for a handful of rows only) has no row."""
    spark = trials.sparkSession
    base = trials.select(F.col(id_col).alias("_id"), F.col(col).cast("double").alias("_x"))
    found: list = []
    with held(base) as rows:  # the filter meets stored values
        rows = rows.where("_x is not null")
        bands, fine = tail_bands(rows, "_x", tail)
        higher = {r: [int(np.random.Generator(np.random.Philox(key=[seed, r * 8 + b])).poisson(m)) for b, (_, _, m) in enumerate(bands[1:])]
                  for r in range(replicates)}

        def draw(part):
            return bootstrap_weights(part, seed, replicates, "_id")

        if bands:
            low = rows.where(F.col("_x") <= F.lit(bands[0][1]))
            single = {r["replicate"]: r["w"] for r in draw(low).groupBy("replicate").agg(F.sum("weight").alias("w")).collect()}
            totals = {r: single.get(r, 0) + sum(higher[r]) for r in range(replicates)}
            totals = {r: n for r, n in totals.items() if n}
            found = tail_of_weighted(draw, low, totals, fine, cuts)
        weighted = None
        for b, (least, most, _) in enumerate(bands[1:]):
            open_ = {r: n for r, n in totals.items() if r not in {f[0] for f in found}}
            if not open_:
                break
            part = rows.where(F.col("_x").between(F.lit(least), F.lit(most)))
            more = spread_draws(part, {r: higher[r][b] for r in open_}, seed + 1 + b)
            before = draw(low).select("replicate", "_x", "weight") if weighted is None else weighted
            weighted = cut(before.where(F.col("replicate").isin(list(open_))).unionByName(more))
            found += tail_of_weighted(lambda t: t, weighted, open_, (least, most), cuts)
    return spark.createDataFrame(found, "replicate INT, n BIGINT, k BIGINT, var DOUBLE, cvar DOUBLE")


def bootstrap_interval(stats: DataFrame, stat: str, p: float, replicates: int) -> DataFrame:
    """(lower, upper): the sorted replicate statistics at 0-based indexes
    int(B*p/2 - 1) and ceil(B*(1 - p/2)), clamped to [0, B-1]."""
    lo = min(max(int(replicates * p / 2 - 1), 0), replicates - 1)
    hi = min(max(int(math.ceil(replicates * (1 - p / 2))), 0), replicates - 1)
    # one row per replicate: B rows, bounded by the replicate count
    r = stats.select(F.row_number().over(Window.orderBy(stat, "replicate")).alias("i"), stat)
    return r.agg(F.max(F.when(F.col("i") == lo + 1, F.col(stat))).alias("lower"),
                 F.max(F.when(F.col("i") == hi + 1, F.col(stat))).alias("upper"))


# ---------------------------------------------------------------- backtest
def count_failures(portfolio: DataFrame, ret: str, var_value: float) -> DataFrame:
    """(total, failures): dates whose portfolio return is below VaR."""
    return portfolio.agg(F.count(F.lit(1)).alias("total"),
                         F.sum((F.col(ret) < F.lit(var_value)).cast("long")).alias("failures"))


def _xlogy(x: Column, y: Column) -> Column:
    return F.when(x == 0, F.lit(0.0)).otherwise(x * F.ln(y))


# Coefficients of the published Chebyshev erfc approximation
# (fractional error below 1.2e-7), lowest order first.
ERFC_COEFFS = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
               0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]


def erfc(z: Column) -> Column:
    """Complementary error function for z >= 0."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * z)
    poly = F.lit(ERFC_COEFFS[-1])
    for c in reversed(ERFC_COEFFS[:-1]):
        poly = F.lit(c) + t * poly
    return t * F.exp(-z * z + poly)


def erfc_sql(z: str) -> str:
    """The same approximation as SQL text (for oracles)."""
    t = f"(1.0 / (1.0 + 0.5 * ({z})))"
    poly = repr(ERFC_COEFFS[-1])
    for c in reversed(ERFC_COEFFS[:-1]):
        poly = f"({c!r} + {t} * {poly})"
    return f"({t} * exp(-({z}) * ({z}) + {poly}))"


def kupiec_test(counts: DataFrame, confidence: float) -> DataFrame:
    """Kupiec proportion-of-failures test: LR statistic (1 degree of
    freedom) and p-value, with 0 * ln 0 = 0."""
    t, x = F.col("total").cast("double"), F.col("failures").cast("double")
    p = F.lit(confidence)
    ratio = x / t
    log_null = _xlogy(t - x, F.lit(1.0) - p) + _xlogy(x, p)
    log_alt = _xlogy(t - x, F.lit(1.0) - ratio) + _xlogy(x, ratio)
    lr = F.greatest(F.lit(-2.0) * (log_null - log_alt), F.lit(0.0))
    return counts.select("total", "failures", lr.alias("lr"),
                         erfc(F.sqrt(lr / 2.0)).alias("p_value"))


# ---------------------------------------------------------------- density
def sample_range_and_bandwidth(samples: DataFrame, col: str) -> tuple[float, float, float]:
    """(min, max, h) with Silverman's h = 1.06 * population stdev * n^(-1/5);
    one aggregate pass, three numbers to the driver, nulls for no samples."""
    r = samples.agg(F.min(col).alias("lo"), F.max(col).alias("hi"),
                    (F.lit(1.06) * F.stddev_pop(col) * F.pow(F.count(col), -0.2)).alias("h")).first()
    return r["lo"], r["hi"], r["h"]


def density_grid(lo: float, hi: float, steps: int = 100) -> Column:
    """ARRAY<DOUBLE>: lo + i * (hi - lo) / steps for i < steps, rounded to 5 places."""
    return F.transform(F.sequence(F.lit(0), F.lit(steps - 1)),
                       lambda i: F.round(F.lit(lo) + i * (F.lit(hi) - F.lit(lo)) / F.lit(float(steps)), 5))


KDE_BIN, KDE_ORDER = 0.125, 8   # bin width in bandwidths, highest power kept


def kde_error_bound(bandwidth: float, width: float = KDE_BIN, order: int = KDE_ORDER) -> float:
    """Largest difference of ``kde_density`` from the direct sum: the next
    Taylor term, with Cramer's bound 1.0865 sqrt(m!) / sqrt(2 pi) on the m-th
    derivative of the normal density."""
    m = order + 1
    return 1.0865 * (width / 2) ** m / math.sqrt(math.factorial(m)) / math.sqrt(2 * math.pi) / bandwidth


def hermite(m: int) -> list[int]:
    """Coefficients, lowest power first, of the m-th (probabilists')
    Hermite polynomial."""
    a, b = [1], [0, 1]
    for k in range(1, m + 1):
        a, b = b, [(b[j - 1] if j else 0) - (k * a[j] if j < len(a) else 0) for j in range(len(b) + 1)]
    return a


def kde_density(samples: DataFrame, col: str, points: Column, bandwidth: float, width: float = KDE_BIN,
                order: int = KDE_ORDER) -> DataFrame:
    """(pos, point, density): Gaussian kernel density at each point of the
    ``points`` array, from mergeable sums: samples fall into bins of ``width``
    bandwidths, a bin keeps the powers 0 .. ``order`` of the distances d of
    its samples from its centre, and the kernel of a sample t bandwidths from
    a point is phi(t) sum He_m(t) d^m / m!, exact but for the terms beyond
    ``order`` (``kde_error_bound``). So only bins meet points: their number
    depends on the range of the samples in bandwidths, not on their count.
    Null samples are left out."""
    h = float(bandwidth)
    at = F.floor(F.col(col) / F.lit(h * width))
    d = F.col(col) / F.lit(h) - (F.col("_bin") + 0.5) * F.lit(width)
    binned = samples.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias(col)).withColumn("_bin", at)
    power = binned.select("_bin", d.alias("_d"))
    sums = [F.count(F.lit(1)).cast("double").alias("p0"), *[F.sum(F.pow("_d", F.lit(float(m)))).alias(f"p{m}") for m in range(1, order + 1)]]
    bins = cut(power.groupBy("_bin").agg(*sums))
    # coefficients of the powers of t: sum over m of He_m's times p_m / m!
    poly = [[(F.col(f"p{m}") * F.lit(hermite(m)[j] / math.factorial(m))) for m in range(j, order + 1) if hermite(m)[j]] for j in range(order + 1)]
    coef = [sum(terms[1:], terms[0]) for terms in poly]
    centre = (F.col("_bin") + 0.5) * F.lit(h * width)
    each = bins.select(centre.alias("_c"), F.col("p0").alias("_n"), *[c.alias(f"c{j}") for j, c in enumerate(coef)], F.posexplode(points).alias("pos", "point"))
    each = each.withColumn("_t", (F.col("point") - F.col("_c")) / F.lit(h))
    value = F.col(f"c{order}")
    for j in range(order - 1, -1, -1):
        value = value * F.col("_t") + F.col(f"c{j}")
    kernel = F.lit(1.0 / math.sqrt(2.0 * math.pi) / h) * F.exp(F.lit(-0.5) * F.col("_t") * F.col("_t")) * value
    g = each.select("pos", "point", "_n", kernel.alias("_v")).groupBy("pos", "point").agg(F.sum("_v").alias("s"), F.sum("_n").alias("n"))
    return g.select("pos", "point", (F.col("s") / F.col("n")).alias("density"))
