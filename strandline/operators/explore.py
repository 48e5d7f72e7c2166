"""Exploratory aggregation: requests, 2-D bins, correlations, cross-tabs, rates, subgroups, table one, missingness, measurement."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions import distributions as dist
from strandline.operators.phenotypes import Z95
from strandline.operators.sums import quantiles_of, same_keys, with_quantiles
from strandline.sources.tables import persisted

BOUNDS = T.StructType([T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType())])
STATS = {"count": F.count, "count_distinct": F.countDistinct, "mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max}


def aggregate(df: DataFrame, groups: list[str | tuple[str, float]], stats: dict[str, tuple], filters: list[tuple] = (), cap: int = 10_000) -> DataFrame:
    """A validated request. groups: columns or (column, bin width); stats: name to (statistic, column) or ('quantile', column, q); filters: (column, 'in'|'range'|'eq'|'null', value). More than ``cap`` groups raise: none is left out."""
    for _, c, *_x in [(n, *s[1:]) for n, s in stats.items()] + [(None, f[0]) for f in filters]:
        if c not in df.columns:
            raise ValueError(f"no column {c}")
    for c, kind, *value in filters:
        x = F.col(c)
        test = {"in": lambda: x.isin(value[0]), "range": lambda: (x >= value[0][0]) & (x < value[0][1]), "eq": lambda: x == value[0], "null": lambda: x.isNull()}[kind]()  # noqa: B023
        df = df.where(test)
    keys = [F.col(g) if isinstance(g, str) else (F.floor(F.col(g[0]) / g[1]) * g[1]).alias(f"{g[0]}_bin") for g in groups]
    plain = {n: STATS[s[0]](s[1]).alias(n) for n, s in stats.items() if s[0] != "quantile"}
    found = persisted(df.groupBy(*keys).agg(F.count("*").alias("_rows"), *plain.values()), "aggregate")
    if found.limit(cap + 1).count() > cap:
        raise ValueError(f"over {cap} groups: filter, or use wider bins")
    names = [c for c in found.columns if c not in plain and c != "_rows"]
    asked: dict[str, list[str]] = {}
    for n, s in stats.items():
        if s[0] == "quantile":
            asked.setdefault(s[1], []).append(n)
    for k, (c, of) in enumerate(asked.items()):
        got = with_quantiles(found, df.select(*keys, F.col(c).alias("_value")), "_value", [stats[n][2] for n in of], names, f"_q{k}")
        found = got.select(*found.columns, *[F.col(f"_q{k}")[i].alias(n) for i, n in enumerate(of)])
    return found.select(*names, *stats)


def histogram2d(df: DataFrame, x: str, y: str, dx: float, dy: float) -> DataFrame:
    return df.groupBy((F.floor(F.col(x) / dx) * dx).alias("x"), (F.floor(F.col(y) / dy) * dy).alias("y")).agg(F.count("*").alias("n"))


def corr_matrix(df: DataFrame, cols: list[str], least: int = 11) -> DataFrame:
    """a, b, n, r of every pair of columns over their complete rows, from one aggregate; r hidden below ``least`` rows."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    aggs = []
    for k, (a, b) in enumerate(pairs):
        n = F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull())
        aggs.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), n.alias("n"), F.when(n >= least, F.corr(a, b)).alias("r")).alias(f"p{k}"))
    return df.agg(*aggs).select(F.explode(F.array(*[f"p{k}" for k in range(len(pairs))])).alias("x")).select("x.*")


def crosstab(df: DataFrame, row: str, col: str) -> DataFrame:
    """row, col, n, row and column shares; margins have NULL keys and are told by row_total and col_total."""
    t = df.cube(row, col).agg(F.count("*").alias("n"), F.grouping(row).alias("gr"), F.grouping(col).alias("gc"))
    both = (F.col("gr") == 0) & (F.col("gc") == 0)
    in_row = F.sum(F.when(both, F.col("n"))).over(Window.partitionBy(row, "gr"))
    in_col = F.sum(F.when(both, F.col("n"))).over(Window.partitionBy(col, "gc"))
    return t.select(row, col, "n", F.when(both, F.col("n") / in_row).alias("row_share"), F.when(both, F.col("n") / in_col).alias("col_share"), (F.col("gc") == 1).alias("row_total"), (F.col("gr") == 1).alias("col_total"))


def conditional_summary(df: DataFrame, by: str, y: str, quantiles: tuple[float, ...] = (0.05, 0.5, 0.95)) -> DataFrame:
    s = with_quantiles(df.groupBy(by).agg(F.count(y).alias("n"), F.avg(y).alias("mean")), df, y, quantiles, [by])
    return s.select(by, "n", "mean", *[F.col("q")[k].alias(f"p{round(100 * q):02d}") for k, q in enumerate(quantiles)])


def linked_brush(df: DataFrame, panels: dict[str, float], brush: Column) -> DataFrame:
    """panel, bin, in_brush, n: every panel binned by its width, within and outside the brush; one pass."""
    bins = F.explode(F.array(*[F.struct(F.lit(c).alias("panel"), (F.floor(F.col(c) / wd) * wd).cast("double").alias("bin")) for c, wd in panels.items()]))
    return df.select(brush.alias("in_brush"), bins.alias("b")).groupBy("b.panel", "b.bin", "in_brush").agg(F.count("*").alias("n"))


def rates(df: DataFrame, strata: list[str], event: str, prior: str, days: str) -> DataFrame:
    """strata, n, events, prevalence (prior or new), at_risk, incidence (new among those without prior), per 1000 person-days."""
    new = F.col(event) & ~F.col(prior)
    s = df.groupBy(*strata).agg(F.count("*").alias("n"), F.count_if(event).alias("events"), F.count_if(F.col(event) | F.col(prior)).alias("_ever"), F.count_if(~F.col(prior)).alias("at_risk"), F.count_if(new).alias("new"), F.sum(days).alias("person_days"))
    return s.select(*strata, "n", "events", (F.col("_ever") / F.col("n")).alias("prevalence"), "at_risk", F.try_divide(F.col("new"), F.col("at_risk")).alias("incidence"), F.try_divide(1000 * F.col("events"), F.col("person_days")).alias("per_1000_days"))


def ci_agresti_coull(x: Column, n: Column, z: float = Z95) -> tuple[Column, Column]:
    m = n + z * z
    p = (x + z * z / 2) / m
    half = z * F.sqrt(p * (1 - p) / m)
    return F.greatest(p - half, F.lit(0.0)), F.least(p + half, F.lit(1.0))


def subgroups(df: DataFrame, dims: list[str], outcome: str) -> DataFrame:
    """dim, level, n, events, share for every level of every dimension, and dim 'overall'; dims are unpivoted so the table is grouped once."""
    pairs = F.explode(F.array(F.struct(F.lit("overall").alias("dim"), F.lit("all").alias("level")), *[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("level")) for d in dims]))
    s = df.select(F.col(outcome).alias("_y"), pairs.alias("p")).groupBy("p.dim", "p.level").agg(F.count("*").alias("n"), F.count_if("_y").alias("events"))
    return s.withColumn("share", F.col("events") / F.col("n"))


def subgroup_means(df: DataFrame, dims: list[str], outcome: str) -> DataFrame:
    """dim, level, n, n_known, mean, sd, p25, median, p75 of a continuous outcome for every level of every dimension, and dim 'overall'. A null level is a level; values of a level are ranked by ranges."""
    pairs = F.explode(F.array(F.struct(F.lit("overall").alias("dim"), F.lit("all").alias("level")), *[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("level")) for d in dims]))
    each = df.select(F.col(outcome).cast("double").alias("_y"), pairs.alias("p")).groupBy("p.dim", "p.level", "_y").agg(F.count("*").alias("_n"))  # one pass over the rows
    each = persisted(each.withColumnRenamed("_y", "_v"), "levels")
    known, n, v = F.col("_v").isNotNull(), F.col("_n"), F.col("_v")
    m = F.when(known, n)
    s = each.groupBy("dim", "level").agg(F.sum(n).alias("n"), F.coalesce(F.sum(m), F.lit(0)).alias("n_known"), F.try_divide(F.sum(n * v), F.sum(m)).alias("mean"), F.sum(n * v).alias("_s"), F.sum(n * v * v).alias("_q"))
    sd = F.sqrt(F.greatest(F.try_divide(F.col("_q") - F.col("_s") * F.col("_s") / F.col("n_known"), F.col("n_known") - 1), F.lit(0.0)))
    q = quantiles_of(each.where(known), [0.25, 0.5, 0.75], ["dim", "level"])
    return s.join(q, same_keys(s, q, ["dim", "level"]), "left").select(s["dim"], s["level"], "n", "n_known", "mean", F.when(F.col("n_known") > 1, sd).alias("sd"), q["q"][0].alias("p25"), q["q"][1].alias("median"), q["q"][2].alias("p75"))


def table_groups(df: DataFrame, group: str, continuous: list[str], categorical: list[str]) -> DataFrame:
    """variable, level, group, n, share, mean, sd, p25, median, p75: table one for any number of groups. Continuous variables have no level and no share; levels of categorical ones have neither mean nor quantiles."""
    out = []
    for v in continuous:
        s = subgroup_means(df, [group], v).where("dim <> 'overall'")
        out.append(s.select(F.lit(v).alias("variable"), F.lit(None).cast("string").alias("level"), F.col("level").alias("group"), F.col("n_known").alias("n"), F.lit(None).cast("double").alias("share"), "mean", "sd", "p25", "median", "p75"))
    none = [F.lit(None).cast("double").alias(c) for c in ("mean", "sd", "p25", "median", "p75")]
    for v in categorical:
        n = df.groupBy(F.col(v).cast("string").alias("level"), F.col(group).cast("string").alias("group")).agg(F.count("*").alias("n"))
        share = F.col("n") / F.sum("n").over(Window.partitionBy("group"))  # a row a level
        out.append(n.select(F.lit(v).alias("variable"), "level", "group", "n", share.alias("share"), *none))
    return reduce(DataFrame.unionByName, out)


def overlap(df: DataFrame, flags: list[str]) -> DataFrame:
    """a, b, n of rows that have both flags, for a <= b in the given order."""
    pairs = [(a, b) for i, a in enumerate(flags) for b in flags[i:]]
    one = df.agg(*[F.count_if(F.col(a) & F.col(b)).alias(f"p{k}") for k, (a, b) in enumerate(pairs)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{k}").alias("n")) for k, (a, b) in enumerate(pairs)])).alias("x")).select("x.*")


def smd(mean_a: Column, var_a: Column, mean_b: Column, var_b: Column) -> Column:
    pooled = F.sqrt((var_a + var_b) / 2)
    return F.when(pooled > 0, (mean_a - mean_b) / pooled).otherwise(F.lit(0.0))


def table1(df: DataFrame, group: str, levels: tuple[str, str], continuous: list[str], categorical: list[str]) -> DataFrame:
    """variable, level, n_a, stat_a, n_b, stat_b, missing, smd for two groups: mean and standardized difference of continuous variables, share of each level of categorical ones."""
    a, b = (F.col(group) == x for x in levels)
    parts = []
    for v in continuous:
        m = lambda f, g: f(F.when(g, F.col(v)))  # noqa: E731, B023
        d = smd(m(F.avg, a), m(F.var_samp, a), m(F.avg, b), m(F.var_samp, b))
        parts.append(df.agg(m(F.count, a).alias("n_a"), m(F.avg, a).alias("stat_a"), m(F.count, b).alias("n_b"), m(F.avg, b).alias("stat_b"), F.count_if(F.col(v).isNull()).alias("missing"), d.alias("smd")).select(F.lit(v).alias("variable"), F.lit(None).cast("string").alias("level"), "*"))
    for v in categorical:
        n = df.where(a | b).groupBy(F.col(v).cast("string").alias("level")).agg(F.count_if(a).alias("n_a"), F.count_if(b).alias("n_b"))
        w = Window.partitionBy()
        pa, pb = F.try_divide(F.col("n_a"), F.sum("n_a").over(w)), F.try_divide(F.col("n_b"), F.sum("n_b").over(w))
        s = n.withColumn("stat_a", pa).withColumn("stat_b", pb).withColumn("smd", smd(F.col("stat_a"), F.col("stat_a") * (1 - F.col("stat_a")), F.col("stat_b"), F.col("stat_b") * (1 - F.col("stat_b"))))
        parts.append(s.select(F.lit(v).alias("variable"), "level", "n_a", "stat_a", "n_b", "stat_b", F.when(F.col("level").isNull(), F.col("n_a") + F.col("n_b")).otherwise(0).alias("missing"), "smd"))
    return reduce(DataFrame.unionByName, parts)


def missing_patterns(df: DataFrame, cols: list[str], k: int = 20) -> DataFrame:
    """pattern (1 measured, 0 missing, in column order), n, share: the k most frequent."""
    p = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in cols])
    s = df.groupBy(p.alias("pattern")).agg(F.count("*").alias("n"))
    return s.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy())).orderBy(F.desc("n"), "pattern").limit(k)


def co_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    """a, b, both, jaccard of the missing rows of each pair of columns."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    na = lambda c: F.col(c).isNull()
    aggs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.count_if(na(a) & na(b)).alias("both"), (F.count_if(na(a) & na(b)) / F.nullif(F.count_if(na(a) | na(b)), F.lit(0))).alias("jaccard")).alias(f"p{k}") for k, (a, b) in enumerate(pairs)]
    return df.agg(*aggs).select(F.explode(F.array(*[f"p{k}" for k in range(len(pairs))])).alias("x")).select("x.*")


def informative_presence(df: DataFrame, cols: list[str], outcome: Column) -> DataFrame:
    """column, rate where measured, rate where missing, and the log-rate ratio with its Wald interval."""
    out = []
    for k, c in enumerate(cols):
        m = F.col(c).isNotNull()
        x1, n1, x0, n0 = F.count_if(outcome & m), F.count_if(m), F.count_if(outcome & ~m), F.count_if(~m)
        r = F.log(F.try_divide(F.try_divide(x1, n1), F.try_divide(x0, n0)))
        inv = lambda v: F.try_divide(F.lit(1.0), v)
        se = F.sqrt(inv(x1) - inv(n1) + inv(x0) - inv(n0))
        out.append(F.struct(F.lit(c).alias("column"), F.try_divide(x1, n1).alias("rate_measured"), F.try_divide(x0, n0).alias("rate_missing"), F.exp(r).alias("ratio"), F.exp(r - Z95 * se).alias("low"), F.exp(r + Z95 * se).alias("high")).alias(f"c{k}"))
    return df.agg(*out).select(F.explode(F.array(*[f"c{k}" for k in range(len(cols))])).alias("x")).select("x.*")


def measurement_frequency(stays: DataFrame, key: list[str], length_hours: str, bins: DataFrame, last: int) -> DataFrame:
    """bin, at_risk, measured, share: stays that last into each hour bin, and those with a row of ``bins`` there."""
    grid = stays.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long")))).where(F.col("bin") <= F.col(length_hours)).select(*key, "bin")
    hit = bins.select(*key, "bin").distinct().withColumn("_m", F.lit(1))
    s = grid.join(hit, [*key, "bin"], "left").groupBy("bin").agg(F.count("*").alias("at_risk"), F.count("_m").alias("measured"))
    return s.withColumn("share", F.col("measured") / F.col("at_risk"))


def structural_absence(df: DataFrame, unit: str, era: str, measured: Column, least: int = 50) -> DataFrame:
    """unit, era, n, share, verdict: structural where nothing is measured in at least ``least`` stays, sparse below 5 percent, else present."""
    s = df.groupBy(unit, era).agg(F.count("*").alias("n"), F.avg(measured.cast("double")).alias("share"))
    return s.withColumn("verdict", F.when((F.col("share") == 0) & (F.col("n") >= least), "structural").when(F.col("share") < 0.05, "sparse").otherwise("present"))


def distinct_levels(df: DataFrame, col: str, cap: int = 50) -> DataFrame:
    """The first ``cap`` levels in order, and whether there are more."""
    top = df.select(col).distinct().orderBy(col).limit(cap + 1)
    w = Window.partitionBy()
    return top.withColumn("_r", F.row_number().over(Window.orderBy(col))).withColumn("truncated", F.count(F.lit(1)).over(w) > cap).where(F.col("_r") <= cap).drop("_r")


def top_per_group(df: DataFrame, by: str, order: list[Column], k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= k)


def missing_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """column, n, missing, share, n_distinct of each column, from one aggregate; distinct values by count_distinct."""
    aggs = [F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("n"), F.count_if(F.col(c).isNull()).alias("missing"), F.try_divide(F.count_if(F.col(c).isNull()), F.count(F.lit(1))).alias("share"), F.countDistinct(c).alias("n_distinct")).alias(f"c{k}") for k, c in enumerate(cols)]
    return df.agg(*aggs).select(F.explode(F.array(*[f"c{k}" for k in range(len(cols))])).alias("x")).select("x.*")


@F.pandas_udf(BOUNDS)
def ci_exact(x: pd.Series, n: pd.Series) -> pd.DataFrame:
    """Clopper-Pearson bounds of a proportion; for rows of an aggregate."""
    return pd.DataFrame([dist.binomial_exact(int(a), int(b)) for a, b in zip(x, n, strict=True)], columns=["low", "high"])


@F.pandas_udf(BOUNDS)
def ci_exact_count(x: pd.Series) -> pd.DataFrame:
    """Exact Poisson bounds of a count; for rows of an aggregate."""
    return pd.DataFrame([dist.poisson_exact(int(a)) for a in x], columns=["low", "high"])
