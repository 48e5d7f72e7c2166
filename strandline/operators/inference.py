"""Ranks without a global window, tests, adjusted p-values, resampling from cluster sums, agreement, drift."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions import distributions as dist
from strandline.operators.phenotypes import Z95, wilson
from strandline.operators.sums import lookup, prefix_sums
from strandline.sources.tables import persisted


def rank_table(df: DataFrame, col: str, by: Column | None = None) -> DataFrame:
    """value, n, avg_rank of every distinct value; with ``by`` (a boolean) also n_true."""
    flags = [] if by is None else [F.count_if(by).alias("n_true")]
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n"), *flags)
    return prefix_sums(counts, "value", ["n"]).withColumn("avg_rank", F.col("cum_n") - (F.col("n") - 1) / 2).drop("cum_n")


def avg_ranks(df: DataFrame, col: str) -> DataFrame:
    """``df`` with avg_rank: the rank of ``col`` among all rows, ties sharing their mean. Values that over 1/1000 of the rows tie on (1000 values at most) meet a broadcast, so no tie fills a task."""
    table = persisted(rank_table(df, col), "ranks")
    total = table.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * 1000 > total
    known = lambda t, name: t.select(F.col("value").alias(col), F.col("avg_rank").alias(name))
    met = df.join(F.broadcast(known(table.where(hot), "_hot")), col, "left")
    cold = met.where("_hot is null").drop("_hot").join(known(table.where(~hot), "avg_rank"), col, "left")
    return met.where("_hot is not null").withColumnRenamed("_hot", "avg_rank").unionByName(cold)


def mann_whitney(df: DataFrame, col: str, group: Column) -> DataFrame:
    """n1, n2, u, z (tie-corrected), cliff_delta of the rows of ``group`` against the others."""
    t = rank_table(df, col, group)
    n1, n = F.sum("n_true"), F.sum("n")
    s = t.agg(n1.alias("n1"), (n - n1).alias("n2"), F.sum(F.col("avg_rank") * F.col("n_true")).alias("_r"), F.sum(F.col("n").cast("double") ** 3 - F.col("n")).alias("_t"))
    a, b = F.col("n1").cast("double"), F.col("n2").cast("double")
    m = a + b
    sd = F.sqrt(a * b / 12 * ((m + 1) - F.try_divide(F.col("_t"), m * (m - 1))))
    s = s.withColumn("u", F.col("_r") - a * (a + 1) / 2)
    return s.select("n1", "n2", "u", F.try_divide(F.col("u") - a * b / 2, sd).alias("z"), (2 * F.try_divide(F.col("u"), a * b) - 1).alias("cliff_delta"))


def kruskal(df: DataFrame, col: str, group: str) -> DataFrame:
    """groups, n, h (tie-corrected)."""
    t = rank_table(df, col)
    r = df.where(F.col(col).isNotNull()).groupBy(group, F.col(col).alias("value")).agg(F.count("*").alias("m")).join(t, "value").groupBy(group).agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("avg_rank")).alias("r"))
    ties = t.agg(F.sum(F.col("n").cast("double") ** 3 - F.col("n")).alias("t"))
    one = r.agg(F.count("*").alias("groups"), F.sum("m").alias("n"), F.sum(F.col("r") * F.col("r") / F.col("m")).alias("s")).crossJoin(F.broadcast(ties))  # one row each
    n = F.col("n").cast("double")
    return one.select("groups", "n", F.try_divide(12 / (n * (n + 1)) * F.col("s") - 3 * (n + 1), 1 - F.col("t") / (n**3 - n)).alias("h"))


def compare_means(df: DataFrame, col: str, group: Column) -> DataFrame:
    """diff, Welch t and its degrees of freedom, pooled Cohen d, Hedges g."""
    m = lambda f, g: f(F.when(g, F.col(col)))
    s = df.agg(*[m(f, g).alias(f"{n}{k}") for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp)) for k, g in ((1, group), (2, ~group))])
    c = F.col
    a, b = c("v1") / c("n1"), c("v2") / c("n2")
    diff = c("m1") - c("m2")
    d = diff / F.sqrt(((c("n1") - 1) * c("v1") + (c("n2") - 1) * c("v2")) / (c("n1") + c("n2") - 2))
    return s.select(diff.alias("diff"), (diff / F.sqrt(a + b)).alias("t"), ((a + b) ** 2 / (a**2 / (c("n1") - 1) + b**2 / (c("n2") - 1))).alias("df"), d.alias("cohen_d"), (d * (1 - 3 / (4 * (c("n1") + c("n2")) - 9))).alias("hedges_g"))


@F.pandas_udf(T.DoubleType())
def t_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([dist.t_sf2(a, b) for a, b in zip(t, df, strict=True)])


@F.pandas_udf(T.DoubleType())
def chi2_p(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([dist.chi2_sf(a, b) for a, b in zip(x, df, strict=True)])


@F.pandas_udf(T.DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    return z.map(dist.normal_sf2)


def compare_props(df: DataFrame, event: Column, group: Column) -> DataFrame:
    """p1, p2, rd, rr, or_ with Wald bounds of the ratios and Newcombe's bounds of the difference."""
    s = df.agg(F.count_if(group).alias("n1"), F.count_if(~group).alias("n2"), F.count_if(event & group).alias("x1"), F.count_if(event & ~group).alias("x2"))
    c = F.col
    p1, p2 = F.try_divide(c("x1"), c("n1")), F.try_divide(c("x2"), c("n2"))
    inv = lambda x: F.try_divide(F.lit(1.0), x)
    rr, orr = F.log(F.try_divide(p1, p2)), F.log(F.try_divide(c("x1") * (c("n2") - c("x2")), c("x2") * (c("n1") - c("x1"))))
    se_r, se_o = F.sqrt(inv(c("x1")) - inv(c("n1")) + inv(c("x2")) - inv(c("n2"))), F.sqrt(inv(c("x1")) + inv(c("n1") - c("x1")) + inv(c("x2")) + inv(c("n2") - c("x2")))
    (l1, u1), (l2, u2) = wilson(c("x1"), c("n1")), wilson(c("x2"), c("n2"))
    low, high = p1 - p2 - F.sqrt((p1 - l1) ** 2 + (u2 - p2) ** 2), p1 - p2 + F.sqrt((u1 - p1) ** 2 + (p2 - l2) ** 2)
    return s.select(p1.alias("p1"), p2.alias("p2"), (p1 - p2).alias("rd"), low.alias("rd_low"), high.alias("rd_high"), F.exp(rr).alias("rr"), F.exp(rr - Z95 * se_r).alias("rr_low"), F.exp(rr + Z95 * se_r).alias("rr_high"), F.exp(orr).alias("or_"), F.exp(orr - Z95 * se_o).alias("or_low"), F.exp(orr + Z95 * se_o).alias("or_high"))


def chi_square(df: DataFrame, row: str, col: str) -> DataFrame:
    """chi2, df, n, cramer_v of the contingency table of two columns."""
    n = df.groupBy(row, col).agg(F.count("*").alias("n"))
    r, k = Window.partitionBy(row), Window.partitionBy(col)
    e = n.crossJoin(n.agg(F.sum("n").alias("_all"))).withColumn("_e", F.sum("n").over(r) * F.sum("n").over(k) / F.col("_all"))  # one row
    # cells that don't occur add their expected counts: sum(o^2 / e) - n covers them
    s = e.agg((F.sum(F.col("n") * F.col("n") / F.col("_e")) - F.sum("n")).alias("chi2"), F.countDistinct(row).alias("_r"), F.countDistinct(col).alias("_c"), F.sum("n").alias("n"))
    return s.select("chi2", ((F.col("_r") - 1) * (F.col("_c") - 1)).alias("df"), "n", F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * F.least(F.col("_r") - 1, F.col("_c") - 1))).alias("cramer_v"))


def mcnemar(df: DataFrame, a: Column, b: Column) -> DataFrame:
    s = df.agg(F.count_if(a & ~b).alias("only_a"), F.count_if(b & ~a).alias("only_b"))
    return s.withColumn("chi2", F.try_divide((F.col("only_a") - F.col("only_b")) ** 2, F.col("only_a") + F.col("only_b")))


def cmh(df: DataFrame, stratum: str, event: Column, group: Column) -> DataFrame:
    """Mantel-Haenszel odds ratio and the chi-square without continuity correction, over strata of at least two rows."""
    some = lambda test: F.count_if(test).cast("double")  # noqa: E731  products of four counts go over a long
    s = df.groupBy(stratum).agg(F.count("*").cast("double").alias("n"), some(event & group).alias("a"), some(~event & group).alias("b"), some(event & ~group).alias("c"), some(~event & ~group).alias("d")).where("n > 1")
    c = F.col
    e = (c("a") + c("b")) * (c("a") + c("c")) / c("n")
    v = (c("a") + c("b")) * (c("c") + c("d")) * (c("a") + c("c")) * (c("b") + c("d")) / (c("n") ** 2 * (c("n") - 1))
    return s.agg(F.try_divide(F.sum(c("a") * c("d") / c("n")), F.sum(c("b") * c("c") / c("n"))).alias("or_mh"), F.try_divide(F.sum(c("a") - e) ** 2, F.sum(v)).alias("chi2"))


def anova(df: DataFrame, col: str, group: str) -> DataFrame:
    """groups, n, ss_between, ss_within, f."""
    g = df.where(F.col(col).isNotNull()).groupBy(group).agg(F.count("*").alias("n"), F.avg(col).alias("m"), F.var_pop(col).alias("v"))
    s = g.agg(F.count("*").alias("groups"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("m")).alias("_s"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("_q"), F.sum(F.col("n") * F.col("v")).alias("ss_within"))
    s = s.withColumn("ss_between", F.col("_q") - F.col("_s") ** 2 / F.col("n"))
    return s.select("groups", "n", "ss_between", "ss_within", F.try_divide(F.col("ss_between") / (F.col("groups") - 1), F.col("ss_within") / (F.col("n") - F.col("groups"))).alias("f"))


def welch_anova(df: DataFrame, col: str, group: str) -> DataFrame:
    """groups, f, df1, df2: means of groups with variances of their own; a group of one row, or without variance, has no weight to give and raises nothing: f is null."""
    g = df.where(F.col(col).isNotNull()).groupBy(group).agg(F.count("*").cast("double").alias("n"), F.avg(col).alias("m"), F.var_samp(col).alias("v"))
    g = g.withColumn("w", F.try_divide(F.col("n"), F.col("v")))
    t = g.agg(F.count("*").alias("groups"), F.sum("w").alias("_w"), F.sum(F.col("w") * F.col("m")).alias("_wm"), F.count_if(F.col("w").isNull()).alias("_bad"))
    j = g.crossJoin(F.broadcast(t))  # one row
    mean, k = F.col("_wm") / F.col("_w"), F.col("groups").cast("double")
    lam = F.try_divide((1 - F.col("w") / F.col("_w")) ** 2, F.col("n") - 1)
    s = j.groupBy("groups", "_bad").agg(F.sum(F.col("w") * (F.col("m") - mean) ** 2).alias("_b"), F.sum(lam).alias("_l"))
    f = F.when(F.col("_bad") == 0, F.try_divide(F.col("_b") / (k - 1), 1 + 2 * (k - 2) / (k * k - 1) * F.col("_l")))
    return s.select("groups", f.alias("f"), (F.col("groups") - 1).alias("df1"), F.try_divide(k * k - 1, 3 * F.col("_l")).alias("df2"))


def signed_rank(df: DataFrame, difference: Column, exact: int = 50) -> DataFrame:
    """n (differences that aren't 0), w_plus, z, p (two-sided), exact. Up to ``exact`` differences the null distribution counts, for every sum of ranks, the signs that give it (ties have half ranks); beyond, the normal form with tie correction."""
    d = df.select(difference.cast("double").alias("_d")).where("_d is not null and _d <> 0").select(F.abs("_d").alias("_a"), (F.col("_d") > 0).alias("_up"))
    t = persisted(rank_table(d, "_a", F.col("_up")), "ranks")
    n, w, ties = t.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("avg_rank") * F.col("n_true")), F.lit(0.0)), F.coalesce(F.sum(F.col("n").cast("double") ** 3 - F.col("n")), F.lit(0.0))).first()
    mean, var = n * (n + 1) / 4, n * (n + 1) * (2 * n + 1) / 24 - ties / 48
    z = (w - mean) / var**0.5 if var > 0 else None
    p = None
    if n and n <= exact:
        ways = np.zeros(n * (n + 1) + 1)
        ways[0] = 1
        for r in t.collect():  # ``exact`` rows at most
            for _ in range(r["n"]):
                step = round(2 * r["avg_rank"])
                ways[step:] = ways[step:] + ways[:-step]
        at, total = round(2 * w), ways.sum()
        p = float(min(1.0, 2 * min(ways[: at + 1].sum(), ways[at:].sum()) / total))
    elif z is not None:
        p = float(dist.normal_sf2(z))
    return df.sparkSession.createDataFrame([(int(n), float(w), z if z is None else float(z), p, bool(n and n <= exact))], "n long, w_plus double, z double, p double, exact boolean")


def spearman_matrix(df: DataFrame, cols: list[str], least: int = 11) -> DataFrame:
    """a, b, n, rho of every pair of columns, ranks taken among the rows that are complete in that pair; rho hidden below ``least`` rows.

    Pairs of values are counted before anything is ranked; ranks are running counts by pair, and values that many rows share meet a broadcast.
    """
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    each = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")) for k, (a, b) in enumerate(pairs)])).alias("v")).select("v.*")
    each = persisted(each.where("x is not null and y is not null").groupBy("k", "x", "y").agg(F.count("*").alias("n")), "pairs")
    for c in ("x", "y"):
        one = each.groupBy("k", c).agg(F.sum("n").alias("m"), F.count("*").alias("_rows"))
        rank = prefix_sums(one, c, ["m"], keys=["k"]).select("k", c, "_rows", (F.col("cum_m") - (F.col("m") - 1) / 2).alias(f"r{c}"))
        each = lookup(each, rank, ["k", c], "_rows")
    n, x, y = F.col("n").cast("double"), F.col("rx"), F.col("ry")
    s = each.groupBy("k").agg(F.sum("n").alias("n"), F.sum(n * x).alias("sx"), F.sum(n * y).alias("sy"), F.sum(n * x * x).alias("xx"), F.sum(n * y * y).alias("yy"), F.sum(n * x * y).alias("xy"))
    c, m = F.col, F.col("n").cast("double")
    rho = F.try_divide(c("xy") - c("sx") * c("sy") / m, F.sqrt(c("xx") - c("sx") * c("sx") / m) * F.sqrt(c("yy") - c("sy") * c("sy") / m))
    names = df.sparkSession.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a string, b string")
    return F.broadcast(names).join(s, "k", "left").select("a", "b", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n") >= least, rho).alias("rho"))


def p_adjust(df: DataFrame, p: str, panel: list[str] = ()) -> DataFrame:
    """Adds bonferroni, holm, bh and by within each panel; the table is a panel of tests, small."""
    part = Window.partitionBy(*panel)
    up, n = part.orderBy(p), F.count(p).over(part)
    r = F.row_number().over(up)
    d = df.withColumn("_r", r).withColumn("_n", n).withColumn("_h", F.aggregate(F.sequence(F.lit(1), F.col("_n").cast("int")), F.lit(0.0), lambda a, x: a + 1.0 / x))
    one = lambda x: F.least(x, F.lit(1.0))
    rising = part.orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)
    falling = part.orderBy(F.desc("_r")).rowsBetween(Window.unboundedPreceding, 0)
    bh = F.min(F.col(p) * F.col("_n") / F.col("_r")).over(falling)
    return d.select(*df.columns, one(F.col(p) * F.col("_n")).alias("bonferroni"), one(F.max(F.col(p) * (F.col("_n") - F.col("_r") + 1)).over(rising)).alias("holm"), one(bh).alias("bh"), one(F.min(F.col(p) * F.col("_n") * F.col("_h") / F.col("_r")).over(falling)).alias("by"))


#: Draws that one task counts.
DRAWS = 1 << 20


def _picks(units: DataFrame, key: str, replicates: int, seed: int, carry: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rep, _i of every draw, dealt by _i into slices of about DRAWS) and the numbered units. Draws are numbers of a range, so that a task's share grows neither with units nor with replicates."""
    numbered = persisted(prefix_sums(units.select(key, *carry).withColumn("_one", F.lit(1)), key, ["_one"]).withColumn("_i", F.col("cum__one") - 1).select("_i", key, *carry), "units")
    n = numbered.count()
    slices = max(n * replicates // DRAWS, 1)
    grid = units.sparkSession.range(0, n * replicates, 1, slices).select(F.expr(f"int(id div {max(n, 1)})").alias("rep"), F.expr(f"id % {max(n, 1)}").alias("_j"))
    return grid.select("rep", F.pmod(F.xxhash64(F.lit(seed), "rep", "_j"), F.lit(n)).alias("_i")).withColumn("rep", F.col("rep").cast("long")).repartition(slices, "_i"), numbered


def draws(units: DataFrame, key: str, replicates: int, seed: int, carry: Sequence[str] = ()) -> DataFrame:
    """rep, key, carry, times: a bootstrap of units: each of the n draws of a replicate picks a unit by a hash, so results don't depend on the partitioning. ``units`` has a row a unit, whose columns ``carry`` go along."""
    picks, numbered = _picks(units, key, replicates, seed, carry)
    return picks.groupBy("rep", "_i").agg(F.count("*").alias("times")).join(numbered, "_i").select("rep", key, *carry, "times")


def drawn_in(units: DataFrame, key: str, replicates: int, seed: int) -> DataFrame:
    """key, reps: the draws of ``draws`` as one row a unit, with the replicates that pick it, each as often as it does; a unit that none picks has no row."""
    picks, numbered = _picks(units, key, replicates, seed, ())
    return picks.groupBy("_i").agg(F.collect_list(F.col("rep").cast("int")).alias("reps")).join(numbered, "_i").select(key, "reps")


def cluster_bootstrap(df: DataFrame, cluster: str, total: Column, count: Column, replicates: int = 200, seed: int = 1, level: float = 0.95) -> DataFrame:
    """estimate, low, high (percentile), se of sum(total) / sum(count): whole clusters are drawn, and only their two sums are replicated."""
    c = persisted(df.groupBy(cluster).agg(F.sum(total).alias("_x"), F.sum(count).alias("_n")), "clusters")
    r = draws(c, cluster, replicates, seed, ["_x", "_n"]).groupBy("rep").agg((F.sum(F.col("_x") * F.col("times")) / F.sum(F.col("_n") * F.col("times"))).alias("s"))
    a = (1 - level) / 2
    est = c.agg((F.sum("_x") / F.sum("_n")).alias("estimate"))
    return r.agg(F.percentile("s", a).alias("low"), F.percentile("s", 1 - a).alias("high"), F.stddev_samp("s").alias("se")).crossJoin(F.broadcast(est)).select("estimate", "low", "high", "se")


def permutation_test(df: DataFrame, cluster: str, col: str, group: Column, replicates: int = 200, seed: int = 1) -> DataFrame:
    """diff of means and p (+1 rule) when the group labels of clusters are shuffled by hashes; a cluster has the label of the majority of its rows.

    Clusters are ranked within slices of their hash, whose counts give the offsets: a replicate isn't one task.
    """
    c = persisted(df.groupBy(cluster).agg(F.sum(col).alias("_x"), F.count(col).alias("_n"), (F.avg(group.cast("double")) >= 0.5).alias("_g")), "clusters")
    k = c.where("_g").count()
    reps = c.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(replicates))))
    reps = persisted(reps.withColumn("_h", F.xxhash64(F.lit(seed), "rep", cluster)).withColumn("_slice", F.shiftright("_h", 54)), "replicates")
    before = Window.partitionBy("rep").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = reps.groupBy("rep", "_slice").agg(F.count("*").alias("_m"))  # 1024 slices a replicate
    reps = reps.join(sizes.select("rep", "_slice", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_o")), ["rep", "_slice"])
    order = Window.partitionBy("rep", "_slice").orderBy("_h", cluster)
    label = F.when(F.col("rep") == 0, F.col("_g")).otherwise(F.row_number().over(order) + F.col("_o") <= k)
    m = lambda g: F.sum(F.when(g, F.col("_x"))) / F.sum(F.when(g, F.col("_n")))
    s = reps.withColumn("_l", label).groupBy("rep").agg((m(F.col("_l")) - m(~F.col("_l"))).alias("d"))
    seen = F.max(F.when(F.col("rep") == 0, F.col("d"))).over(Window.partitionBy())
    return s.withColumn("seen", seen).agg(F.first("seen").alias("diff"), ((F.count_if((F.col("rep") > 0) & (F.abs("d") >= F.abs("seen"))) + 1) / (replicates + 1)).alias("p"))


def agreement_2x2(df: DataFrame, test: Column, truth: Column) -> DataFrame:
    s = df.agg(F.count_if(test & truth).alias("tp"), F.count_if(test & ~truth).alias("fp"), F.count_if(~test & truth).alias("fn"), F.count_if(~test & ~truth).alias("tn"))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    pe = ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n)
    r = F.try_divide
    return s.select("tp", "fp", "fn", "tn", r(tp, tp + fn).alias("sensitivity"), r(tn, tn + fp).alias("specificity"), r(tp, tp + fp).alias("ppv"), r(tn, tn + fn).alias("npv"), r((tp + tn) / n - pe, 1 - pe).alias("kappa"))


def fdr_screen(df: DataFrame, code: str, unit: str, units: DataFrame, outcome: str) -> DataFrame:
    """code, n, events, chi2 of each code's presence against the units' outcome, by one grouping."""
    base = units.agg(F.count("*").alias("_N1"), F.count_if(outcome).alias("_E1"))
    g = df.select(code, unit).distinct().join(units, unit).groupBy(code).agg(F.count("*").alias("n"), F.count_if(outcome).alias("events")).crossJoin(F.broadcast(base))
    n, e, nn, ee = (F.col(c).cast("double") for c in ("n", "events", "_N1", "_E1"))
    a, b, c, d = e, n - e, ee - e, nn - n - ee + e
    chi = F.try_divide(nn * (a * d - b * c) ** 2, (a + b) * (c + d) * (a + c) * (b + d))
    return g.select(code, "n", "events", chi.alias("chi2"))


def ks(df: DataFrame, col: str, group: Column) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance by cumulative counts of distinct values."""
    t = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count_if(group).alias("a"), F.count_if(~group).alias("b"))
    s = prefix_sums(t, "v", ["a", "b"]).crossJoin(F.broadcast(t.agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))))  # one row of totals
    return s.agg(F.max(F.abs(F.try_divide(F.col("cum_a"), F.col("na")) - F.try_divide(F.col("cum_b"), F.col("nb")))).alias("d"))


def psi(df: DataFrame, col: str, group: Column, cuts: list[float], floor: float = 1e-4) -> DataFrame:
    """Population stability index over bins by ``cuts``; empty shares count as ``floor``."""
    b = sum(((F.col(col) >= c).cast("int") for c in cuts[1:]), (F.col(col) >= cuts[0]).cast("int"))
    w = Window.partitionBy()
    s = df.groupBy(b.alias("bin")).agg(F.count_if(group).alias("a"), F.count_if(~group).alias("b"))
    p, q = F.greatest(F.col("a") / F.sum("a").over(w), F.lit(floor)), F.greatest(F.col("b") / F.sum("b").over(w), F.lit(floor))
    return s.select(p.alias("p"), q.alias("q")).agg(F.sum((F.col("p") - F.col("q")) * F.log(F.col("p") / F.col("q"))).alias("psi"))
