"""Survival: product-limit, log-rank, cumulative incidence, mean cumulative function, Cox, Weibull, landmarks, censoring weights."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.phenotypes import Z95
from strandline.operators.sums import lookup, prefix_sums
from strandline.sources.tables import persisted


def risk_table(df: DataFrame, time: str, codes: dict[str, Column], group: str | None = None) -> DataFrame:
    """group, time, n, at_risk and the count of each code at every distinct time; times are summed by ranges, whatever share of them a group has."""
    keys = {"group": F.col(group).alias("group")} if group else {}
    t = df.groupBy(*keys.values(), F.col(time).alias("time")).agg(F.count("*").alias("n"), *[F.count_if(c).alias(n) for n, c in codes.items()])
    return prefix_sums(t, "time", ["n"], descending=True, keys=list(keys)).withColumnRenamed("cum_n", "at_risk")


def log_steps(gone: Column, at_risk: Column) -> list[Column]:
    """_step, the log of the share that is left, and _end, which is 1 where nobody is: sums of both give a product that may reach zero."""
    some = at_risk > gone
    return [F.when(some, F.log(F.when(some, 1 - gone / at_risk).otherwise(F.lit(1.0)))).otherwise(0.0).alias("_step"), (~some).cast("int").alias("_end")]


def km(df: DataFrame, time: str, event: Column, group: str | None = None) -> DataFrame:
    """group, time, at_risk, events, survival and its log-log bounds (null at 1 and 0) at the event times."""
    keys = ["group"] if group else []
    t = risk_table(df, time, {"events": event}, group).where("events > 0")
    at, d = F.col("at_risk"), F.col("events")
    t = t.select(*keys, "time", "at_risk", "events", *log_steps(d, at), F.coalesce(F.try_divide(d, at * (at - d)), F.lit(0.0)).alias("_v"))
    s = prefix_sums(t, "time", ["_step", "_end", "_v"], keys=keys).withColumn("survival", F.when(F.col("cum__end") > 0, 0.0).otherwise(F.exp("cum__step")))
    inside = (F.col("survival") > 0) & (F.col("survival") < 1)
    half = Z95 * F.sqrt("cum__v") / F.abs(F.log(F.when(inside, F.col("survival"))))
    return s.select(*keys, "time", "at_risk", "events", "survival", F.when(inside, F.pow("survival", F.exp(half))).alias("low"), F.when(inside, F.pow("survival", F.exp(-half))).alias("high"))


def survival_quantiles(curve: DataFrame, probs: list[float], group: str | None = "group") -> DataFrame:
    """group, prob, time, low, high: the first event time at which survival has fallen to 1 - prob or below, and those of its upper and lower bounds (the latter is the earlier); null where a curve doesn't fall so far. ``curve`` is what ``km`` gave."""
    fell = lambda c, p: F.min(F.when(F.coalesce(F.col(c), F.col("survival")) <= 1 - p + 1e-12, F.col("time")))
    rows = [F.struct(F.lit(float(p)).alias("prob"), fell("survival", p).alias("time"), fell("low", p).alias("low"), fell("high", p).alias("high")) for p in probs]
    return curve.groupBy(*([group] if group else [])).agg(F.array(*rows).alias("x")).select(*([group] if group else []), F.explode("x").alias("x")).select(*([group] if group else []), "x.*")


def logrank(df: DataFrame, time: str, event: Column, first: Column, stratum: str | None = None) -> DataFrame:
    """observed, expected, variance and chi2 of the group ``first`` against the others; with ``stratum`` each has its own sets at risk and the sums go over strata."""
    keys = ["group"] if stratum else []
    t = risk_table(df.withColumn("_g", first), time, {"d": event, "d1": event & F.col("_g"), "_c1": F.col("_g")}, stratum)
    t = prefix_sums(t, "time", ["_c1"], descending=True, keys=keys).withColumnRenamed("cum__c1", "n1").where("d > 0")
    n, d, n1 = (F.col(c).cast("double") for c in ("at_risk", "d", "n1"))
    e = d * n1 / n
    v = F.when(n > 1, e * (1 - n1 / n) * F.try_divide(n - d, n - 1)).otherwise(0.0)
    s = t.agg(F.sum("d1").alias("observed"), F.sum(e).alias("expected"), F.sum(v).alias("variance"))
    return s.withColumn("chi2", F.try_divide((F.col("observed") - F.col("expected")) ** 2, F.col("variance")))


def aalen_johansen(df: DataFrame, time: str, code: str, group: str | None = None) -> DataFrame:
    """group, time, at_risk, cif1, cif2, survival at event times; codes 1 and 2 compete, events at a time are before censorings there."""
    keys = ["group"] if group else []
    t = risk_table(df, time, {"d1": F.col(code) == 1, "d2": F.col(code) == 2}, group).where("d1 + d2 > 0")
    t = t.select(*keys, "time", "at_risk", "d1", "d2", *log_steps(F.col("d1") + F.col("d2"), F.col("at_risk")))
    s = prefix_sums(t, "time", ["_step", "_end"], keys=keys)
    left = lambda ends, steps: F.when(ends > 0, 0.0).otherwise(F.exp(steps))
    before = left(F.col("cum__end") - F.col("_end"), F.col("cum__step") - F.col("_step"))
    s = s.select(*keys, "time", "at_risk", left(F.col("cum__end"), F.col("cum__step")).alias("survival"), *[(before * F.col(d) / F.col("at_risk")).alias(c) for d, c in (("d1", "cif1"), ("d2", "cif2"))])
    return prefix_sums(s, "time", ["cif1", "cif2"], keys=keys).select(*keys, "time", "at_risk", F.col("cum_cif1").alias("cif1"), F.col("cum_cif2").alias("cif2"), "survival")


def mcf(rows: DataFrame, start: str, stop: str, event: str) -> DataFrame:
    """time, at_risk, events, mcf of recurrent events in counting-process rows: at risk is what has begun before less what has ended before."""
    t = rows.select(F.explode(F.array(F.struct(F.col(stop).alias("time"), F.lit(0).alias("b"), F.lit(1).alias("e"), F.col(event).cast("int").alias("d")), F.struct(F.col(start).alias("time"), F.lit(1).alias("b"), F.lit(0).alias("e"), F.lit(0).alias("d")))).alias("x")).select("x.*")
    c = prefix_sums(t.groupBy("time").agg(F.sum("b").alias("b"), F.sum("e").alias("e"), F.sum("d").alias("events")), "time", ["b", "e"])
    at = F.col("cum_b") - F.col("b") - (F.col("cum_e") - F.col("e"))
    r = c.select("time", at.alias("at_risk"), "events").where("events > 0").withColumn("_h", F.try_divide(F.col("events"), F.col("at_risk")))
    return prefix_sums(r, "time", ["_h"]).select("time", "at_risk", "events", F.col("cum__h").alias("mcf"))


def cox(df: DataFrame, time: str, event: Column, covariates: list[str], rounds: int = 30, tolerance: float = 1e-8) -> DataFrame:
    """covariate, beta, se: proportional hazards with Breslow ties by Newton's method.

    A round sums weights, weighted covariates and their products by distinct time, accumulates them from the latest time down, and hands on one row: gradient and information.
    Not settling in ``rounds`` raises.
    """
    p = len(covariates)
    x = [F.col(c).cast("double") for c in covariates]
    base = persisted(df.select(F.col(time).alias("t"), event.cast("int").alias("d"), *[c.alias(f"x{i}") for i, c in enumerate(x)]), "cox")
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    beta = np.zeros(p)
    for _ in range(rounds):
        eta = sum((F.col(f"x{i}") * float(b) for i, b in enumerate(beta)), F.lit(0.0))
        w = base.withColumn("w", F.exp(eta))
        sums = [F.sum("w").alias("s"), F.sum("d").alias("d"), *[F.sum(F.col("w") * F.col(f"x{i}")).alias(f"a{i}") for i in range(p)], *[F.sum(F.col("w") * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}_{j}") for i, j in pairs], *[F.sum(F.col("d") * F.col(f"x{i}")).alias(f"e{i}") for i in range(p)]]
        names = ["s", *[f"a{i}" for i in range(p)], *[f"q{i}_{j}" for i, j in pairs]]
        t = prefix_sums(w.groupBy("t").agg(*sums), "t", names, descending=True).where("d > 0")
        m = [F.col(f"cum_a{i}") / F.col("cum_s") for i in range(p)]
        g = [F.sum(F.col(f"e{i}") - F.col("d") * m[i]).alias(f"g{i}") for i in range(p)]
        h = [F.sum(F.col("d") * (F.col(f"cum_q{i}_{j}") / F.col("cum_s") - m[i] * m[j])).alias(f"h{i}_{j}") for i, j in pairs]
        one = t.agg(*g, *h).first()
        info = np.zeros((p, p))
        for i, j in pairs:
            info[i, j] = info[j, i] = one[f"h{i}_{j}"]
        step = np.linalg.solve(info, np.array([one[f"g{i}"] for i in range(p)]))
        beta = beta + step
        if np.abs(step).max() < tolerance:
            se = np.sqrt(np.diag(np.linalg.inv(info)))
            return df.sparkSession.createDataFrame([(c, float(b), float(s)) for c, b, s in zip(covariates, beta, se, strict=True)], "covariate string, beta double, se double")
    raise RuntimeError("the Cox model did not converge")


def aft_weibull(df: DataFrame, time: str, event: Column, covariates: list[str]) -> DataFrame:
    """term, coefficient of the accelerated failure time model, with the intercept and the scale. Times must be positive: others raise."""
    early = df.where(F.col(time) <= 0).count()
    if early:
        raise ValueError(f"{early} rows have no positive {time}")
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import AFTSurvivalRegression

    data = VectorAssembler(inputCols=covariates, outputCol="features").transform(df.where(F.col(time).isNotNull()).select(*covariates, F.col(time).cast("double").alias("label"), event.cast("double").alias("censor")))
    m = AFTSurvivalRegression().fit(data)
    rows = [("(intercept)", float(m.intercept)), *zip(covariates, map(float, m.coefficients), strict=True), ("(scale)", float(m.scale))]
    return df.sparkSession.createDataFrame(rows, "term string, coefficient double")


def landmark(df: DataFrame, time: str, at: float) -> DataFrame:
    """Rows still followed at the landmark, their clock restarted there."""
    return df.where(F.col(time) > at).withColumn(time, F.col(time) - at)


def uncensored(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """keys, time, n and minus the log of the probability of being uncensored just before that time, for rows (time, _e: had the event)."""
    t = risk_table(df, "time", {"_c": ~F.col("_e")}, *keys)
    some = F.col("at_risk") > F.col("_c")
    step = F.when(some, -F.log(F.when(some, 1 - F.col("_c") / F.col("at_risk")).otherwise(F.lit(1.0)))).otherwise(F.lit(700.0))
    return prefix_sums(t.select(*keys, "time", "n", step.alias("_l")), "time", ["_l"], keys=keys).select(*keys, "time", "n", (F.col("cum__l") - F.col("_l")).alias(name))


def ipcw(df: DataFrame, unit: str, time: str, event: Column, most: float = 20.0) -> DataFrame:
    """unit, weight: for rows with the event 1 / the probability of being uncensored just before it, at most ``most``; 0 for censored rows. Times that many rows share, such as the end of the study, meet a broadcast."""
    d = df.select(unit, F.col(time).alias("time"), event.alias("_e")).where("time is not null")
    return lookup(d, uncensored(d, [], "_before"), ["time"], "n").select(unit, F.when(F.col("_e"), F.least(F.exp("_before"), F.lit(most))).otherwise(0.0).alias("weight"))


def person_period(df: DataFrame, unit: str, time: str, code: str, step: float) -> DataFrame:
    """unit, period, outcome: one row for each begun period; the code in the last, 0 before."""
    n = F.greatest(F.ceil(F.col(time) / step), F.lit(1)).cast("int")
    e = df.withColumn("_n", n).withColumn("period", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    return e.select(unit, "period", F.when(F.col("period") == F.col("_n"), F.col(code)).otherwise(0).alias("outcome"))


def schoenfeld_test(df: DataFrame, time: str, event: Column, fit: DataFrame) -> DataFrame:
    """covariate, n, r, z: correlation of the Schoenfeld residuals at event times with time, and its normal score; ``fit`` is what ``cox`` gave."""
    beta = {r["covariate"]: r["beta"] for r in fit.collect()}  # one row a covariate
    names = list(beta)
    eta = sum((F.col(c).cast("double") * b for c, b in beta.items()), F.lit(0.0))
    w = df.select(F.col(time).alias("t"), event.cast("int").alias("d"), F.exp(eta).alias("w"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    sums = w.groupBy("t").agg(F.sum("w").alias("s"), F.sum("d").alias("d"), *[F.sum(F.col("w") * F.col(f"x{i}")).alias(f"a{i}") for i in range(len(names))], *[F.sum(F.col("d") * F.col(f"x{i}")).alias(f"e{i}") for i in range(len(names))])
    t = prefix_sums(sums, "t", ["s", *[f"a{i}" for i in range(len(names))]], descending=True).where("d > 0")
    means = [F.col(f"cum_a{i}") / F.col("cum_s") for i in range(len(names))]
    res = t.select("t", "d", *[(F.col(f"e{i}") / F.col("d") - means[i]).alias(f"r{i}") for i in range(len(names))])
    one = res.agg(F.count("*").alias("n"), *[F.corr(f"r{i}", "t").alias(f"c{i}") for i in range(len(names))])
    rows = [F.struct(F.lit(c).alias("covariate"), F.col("n"), F.col(f"c{i}").alias("r"), (F.atanh(F.col(f"c{i}")) * F.sqrt(F.greatest(F.col("n") - 3, F.lit(0)))).alias("z")) for i, c in enumerate(names)]
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def stabilized_ipcw(df: DataFrame, unit: str, time: str, event: Column, group: str, most: float = 20.0) -> DataFrame:
    """unit, group, weight: for rows with the event the overall over the group's probability of being uncensored just before it, at most ``most``; 0 for censored rows.

    Curves are over distinct times; ``causal.ess`` of the weights tells how many rows they are worth.
    """
    d = df.select(unit, F.col(time).alias("time"), event.alias("_e"), F.col(group).alias("group")).where("time is not null and group is not null")
    d = lookup(lookup(d, uncensored(d, [], "_k0"), ["time"], "n"), uncensored(d, ["group"], "_k1"), ["group", "time"], "n")
    return d.select(unit, "group", F.when(F.col("_e"), F.least(F.exp(F.col("_k1") - F.col("_k0")), F.lit(most))).otherwise(0.0).alias("weight"))
