"""Target trials, propensity, weights, matching, balance, standardization; regression and imputation they rest on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.timesem import seconds
from strandline.operators.sums import column_quantiles
from strandline.sources.tables import persisted


def ols(df: DataFrame, y: str, xs: list[str]) -> DataFrame:
    """term, coefficient, se, hc_se (HC1) of least squares over complete rows: two aggregates of p * p sums, solved on the driver."""
    return _ols(df, y, xs, None)


def cluster_robust(df: DataFrame, y: str, xs: list[str], cluster: str) -> DataFrame:
    """As ``ols``, hc_se from score sums by cluster."""
    return _ols(df, y, xs, cluster)


def _ols(df: DataFrame, y: str, xs: list[str], cluster: str | None) -> DataFrame:
    d = df.dropna(subset=[y, *xs])
    z = [F.lit(1.0), *[F.col(x).cast("double") for x in xs]]
    p = len(z)
    idx = [(i, j) for i in range(p) for j in range(i, p)]
    one = d.agg(F.count("*").alias("n"), F.sum(F.col(y) * F.col(y)).alias("yy"), *[F.sum(z[i] * z[j]).alias(f"q{i}_{j}") for i, j in idx], *[F.sum(z[i] * F.col(y)).alias(f"r{i}") for i in range(p)]).first()
    q = np.zeros((p, p))
    for i, j in idx:
        q[i, j] = q[j, i] = one[f"q{i}_{j}"]
    inv = np.linalg.inv(q)
    r = np.array([one[f"r{i}"] for i in range(p)], float)
    b = inv @ r
    n = one["n"]
    sigma2 = (one["yy"] - b @ r) / (n - p)
    e = F.col(y) - sum((z[i] * float(b[i]) for i in range(1, p)), F.lit(float(b[0])))
    scores = d.select(*([F.col(cluster).alias("_k")] if cluster else []), *[(e * z[i]).alias(f"s{i}") for i in range(p)])
    if cluster:
        scores = scores.groupBy("_k").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(p)])
    two = scores.agg(F.count("*").alias("g"), *[F.sum(F.col(f"s{i}") * F.col(f"s{j}")).alias(f"m{i}_{j}") for i, j in idx]).first()
    meat = np.zeros((p, p))
    for i, j in idx:
        meat[i, j] = meat[j, i] = two[f"m{i}_{j}"]
    g = two["g"]
    scale = g / (g - 1) * (n - 1) / (n - p) if cluster else n / (n - p)
    robust = np.sqrt(np.diag(inv @ meat @ inv) * scale)
    rows = [(t, float(c), float(s), float(h)) for t, c, s, h in zip(["(intercept)", *xs], b, np.sqrt(np.diag(inv) * max(sigma2, 0.0)), robust, strict=True)]
    return df.sparkSession.createDataFrame(rows, "term string, coefficient double, se double, hc_se double")


def glm(df: DataFrame, y: str, xs: list[str], family: str = "gaussian") -> DataFrame:
    """term, coefficient of a generalized linear model (gaussian, binomial, poisson, gamma)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    data = VectorAssembler(inputCols=xs, outputCol="features").transform(df.select(*[F.col(x).cast("double").alias(x) for x in xs], F.col(y).cast("double").alias("label")))
    m = GeneralizedLinearRegression(family=family).fit(data)
    return df.sparkSession.createDataFrame([("(intercept)", float(m.intercept)), *zip(xs, map(float, m.coefficients), strict=True)], "term string, coefficient double")


def rcs(x: Column, knots: list[float]) -> list[Column]:
    """Restricted cubic spline basis beyond x itself, scaled by the squared span of the knots."""
    cube = lambda k: F.pow(F.greatest(x - k, F.lit(0.0)), F.lit(3))
    a, z = knots[-2], knots[-1]
    return [(cube(k) - cube(a) * (z - k) / (z - a) + cube(z) * (a - k) / (z - a)) / (z - knots[0]) ** 2 for k in knots[:-2]]


def variance_components(df: DataFrame, cluster: str, col: str) -> DataFrame:
    """within, between, icc by the ANOVA estimator."""
    g = df.where(F.col(col).isNotNull()).groupBy(cluster).agg(F.count("*").cast("double").alias("n"), F.avg(col).alias("m"), F.var_pop(col).alias("v"))
    s = g.agg(F.count("*").alias("k"), F.sum("n").alias("N"), F.sum(F.col("n") * F.col("n")).alias("n2"), F.sum(F.col("n") * F.col("v")).alias("w"), F.sum(F.col("n") * F.col("m")).alias("s"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("q"))
    msw = F.col("w") / (F.col("N") - F.col("k"))
    msb = (F.col("q") - F.col("s") ** 2 / F.col("N")) / (F.col("k") - 1)
    n0 = (F.col("N") - F.col("n2") / F.col("N")) / (F.col("k") - 1)
    d = s.select(msw.alias("within"), F.greatest((msb - msw) / n0, F.lit(0.0)).alias("between"))
    return d.withColumn("icc", F.col("between") / (F.col("within") + F.col("between")))


def impute(df: DataFrame, cols: list[str], how: str = "median") -> DataFrame:
    """Fills each column and adds <column>__measured. median: the exact one, for numbers; mode: the commonest value, of equal ones the least, for any type; complete_case: no fill, rows without a value in any column go."""
    known = [F.col(c).isNotNull().alias(f"{c}__measured") for c in cols]
    if how == "complete_case":
        return df.dropna(subset=cols).select("*", *known)
    if how == "median":
        fill = {c: q[0] for c, q in column_quantiles(df, cols, [0.5]).items()}
    elif how == "mode":
        counts = {c: df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("_n")) for c in cols}
        fill = {c: row[0] for c, t in counts.items() if (row := t.agg(F.min_by(c, F.struct(-F.col("_n"), F.col(c)))).first()) is not None}  # one row a column
    else:
        raise ValueError(f"no way to impute by {how}")
    return df.select(*[F.coalesce(F.col(c), F.lit(fill.get(c))).alias(c) if c in cols else F.col(c) for c in df.columns], *known)


def rubin_pool(fits: DataFrame, term: str = "term") -> DataFrame:
    """term, estimate, within, between, total variance and fraction of missing information over imputations (coefficient, se)."""
    s = fits.groupBy(term).agg(F.count("*").alias("m"), F.avg("coefficient").alias("estimate"), F.avg(F.col("se") * F.col("se")).alias("within"), F.var_samp("coefficient").alias("between"))
    s = s.withColumn("total", F.col("within") + (1 + 1 / F.col("m")) * F.col("between"))
    return s.withColumn("fmi", F.try_divide((1 + 1 / F.col("m")) * F.col("between"), F.col("total")))


def sequential_trials(units: DataFrame, unit: str, start: str, stop: str, starts: DataFrame, started: str, every_hours: float, trials: int) -> DataFrame:
    """trial, unit, origin, arm (1 initiates in the trial's interval, 0 not), deviated_at: trial k begins k intervals after the unit's start, while it is followed and has not initiated.

    An arm-0 unit deviates when it initiates later. ``starts`` holds the units' initiations.
    """
    first = starts.groupBy(unit).agg(F.min(started).alias("_init"))
    h = every_hours * 3600
    g = units.join(first, unit, "left").withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(trials - 1))))
    o = seconds(start) + F.col("trial") * h
    init = seconds("_init")
    g = g.withColumn("_o", o).where((F.col("_o") < seconds(stop)) & (init.isNull() | (init >= F.col("_o"))))
    arm = F.coalesce(init < F.col("_o") + h, F.lit(False)).cast("int")
    return g.select("trial", unit, F.timestamp_micros((F.col("_o") * 1e6).cast("long")).cast("timestamp_ntz").alias("origin"), arm.alias("arm"), F.when(arm == 0, F.col("_init")).alias("deviated_at"))


def propensity(df: DataFrame, treated: str, xs: list[str]) -> DataFrame:
    """``df`` with ps, a logistic regression's probability of treatment."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    data = VectorAssembler(inputCols=xs, outputCol="_f").transform(df.withColumn("_y", F.col(treated).cast("double")))
    m = LogisticRegression(featuresCol="_f", labelCol="_y", probabilityCol="_pr", rawPredictionCol="_rw", predictionCol="_pd").fit(data)
    return m.transform(data).select(*df.columns, vector_to_array("_pr")[1].alias("ps"))


def weight(treated: Column, ps: Column, kind: str, low: float = 0.01, high: float = 0.99) -> Column:
    """ATE, ATT or ATO weight of a truncated propensity."""
    p = F.least(F.greatest(ps, F.lit(low)), F.lit(high))
    return {"ATE": F.when(treated, 1 / p).otherwise(1 / (1 - p)), "ATT": F.when(treated, 1.0).otherwise(p / (1 - p)), "ATO": F.when(treated, 1 - p).otherwise(p)}[kind]


def ess(df: DataFrame, by: str, w: str) -> DataFrame:
    return df.groupBy(by).agg((F.sum(w) ** 2 / F.sum(F.col(w) * F.col(w))).alias("ess"))


def balance(df: DataFrame, treated: Column, xs: list[str], w: Column) -> DataFrame:
    """variable, smd_raw, smd_weighted, variance_ratio_raw, variance_ratio_weighted (treated over others), flagged (difference over 0.1), from one aggregate."""
    aggs = []
    for i, x in enumerate(xs):
        for k, g in ((1, treated), (0, ~treated)):
            v, ww = F.when(g, F.col(x).cast("double")), F.when(g, w)
            aggs += [F.avg(v).alias(f"m{i}{k}"), F.var_samp(v).alias(f"v{i}{k}"), (F.sum(ww * v) / F.sum(ww)).alias(f"w{i}{k}"), (F.sum(ww * v * v) / F.sum(ww) - (F.sum(ww * v) / F.sum(ww)) ** 2).alias(f"s{i}{k}")]
    one = df.agg(*aggs)
    c = F.col
    rows = []
    for i, x in enumerate(xs):
        sd = F.sqrt((c(f"v{i}1") + c(f"v{i}0")) / 2)
        rows.append(F.struct(F.lit(x).alias("variable"), F.try_divide(c(f"m{i}1") - c(f"m{i}0"), sd).alias("smd_raw"), F.try_divide(c(f"w{i}1") - c(f"w{i}0"), sd).alias("smd_weighted"), F.try_divide(c(f"v{i}1"), c(f"v{i}0")).alias("variance_ratio_raw"), F.try_divide(c(f"s{i}1"), c(f"s{i}0")).alias("variance_ratio_weighted")))
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*").withColumn("flagged", F.abs("smd_weighted") > 0.1)


def aipw(df: DataFrame, y: Column, treated: Column, ps: Column, m1: Column, m0: Column) -> DataFrame:
    """Doubly robust mean difference with its standard error."""
    t = treated.cast("double")
    psi = m1 - m0 + t * (y - m1) / ps - (1 - t) * (y - m0) / (1 - ps)
    return df.select(psi.alias("p")).agg(F.avg("p").alias("ate"), (F.stddev_samp("p") / F.sqrt(F.count("p"))).alias("se"))


def e_value(rr: Column) -> Column:
    r = F.when(rr >= 1, rr).otherwise(1 / rr)
    return r + F.sqrt(r * (r - 1))


def informative_missing(df: DataFrame, col: str, xs: list[str]) -> DataFrame:
    """term, coefficient of a logistic model of whether ``col`` is missing."""
    return glm(df.withColumn("_missing", F.col(col).isNull().cast("double")), "_missing", xs, "binomial")


def hashed_normal(key: Column, seed: str) -> Column:
    """A standard normal number from key and seed alone."""
    from strandline.functions.timesem import md5_unit

    u, v = md5_unit(key, seed + "u"), md5_unit(key, seed + "v")
    return F.sqrt(-2 * F.log(F.greatest(u, F.lit(1e-12)))) * F.cos(2 * np.pi * v)


def mice(df: DataFrame, key: str, cols: list[str], xs: list[str], m: int = 5, rounds: int = 3, seed: str = "mice") -> DataFrame:
    """imp, and the columns of ``df`` with ``cols`` filled: m chains of linear regressions of each column on the others, with hashed normal noise, so chains repeat.

    Complete values are never changed. Each regression is one aggregate; each round's table is written.
    """
    from functools import reduce

    out = []
    for i in range(m):
        flags = [F.col(c).isNull().alias(f"_na_{c}") for c in cols]
        start = df.agg(*[F.avg(c).alias(f"_mean_{c}") for c in cols], *[F.coalesce(F.stddev_samp(c), F.lit(0.0)).alias(f"_sd_{c}") for c in cols])
        d = df.select("*", *flags).crossJoin(F.broadcast(start))  # one row of means and deviations
        d = d.select(*[F.coalesce(F.col(c).cast("double"), F.col(f"_mean_{c}") + F.col(f"_sd_{c}") * hashed_normal(F.col(key), f"{seed}{i}{c}")).alias(c) if c in cols else F.col(c) for c in df.columns], *[f"_na_{c}" for c in cols])
        d = persisted(d, "mice")
        for r in range(rounds):
            for c in cols:
                rest = [x for x in [*cols, *xs] if x != c]
                seen = d.where(~F.col(f"_na_{c}"))
                b = [row["coefficient"] for row in ols(seen, c, rest).collect()]  # one row a term
                fitted = sum((F.col(x).cast("double") * float(v) for x, v in zip(rest, b[1:], strict=True)), F.lit(float(b[0])))
                sd = seen.agg(F.stddev_samp(F.col(c) - fitted)).first()[0] or 0.0
                d = d.withColumn(c, F.when(F.col(f"_na_{c}"), fitted + float(sd) * hashed_normal(F.col(key), f"{seed}{i}{r}{c}")).otherwise(F.col(c)))
            d = persisted(d, "mice")
        out.append(d.select(F.lit(i).alias("imp"), *df.columns))
    return reduce(DataFrame.unionByName, out)
