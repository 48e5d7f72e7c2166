"""Assessment of scores and models: concordance, clustered means and comparisons, calibration, learning curves, subgroups, errors, validation plans."""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.timesem import md5_unit
from strandline.operators.inference import draws, drawn_in
from strandline.operators.phenotypes import Z95
from strandline.operators.sums import prefix_sums, same_keys
from strandline.sources.tables import persisted


def c_index(df: DataFrame, time: str, event: Column, score: str) -> DataFrame:
    """pairs, concordant, tied, c: over all pairs of which the one with the event is known to be earlier, whether it has the higher score (a tie counts half). Exact, without forming a pair.

    Times get ranks (at equal times events before censorings; two events at one time aren't compared). Two ranks first differ at one binary digit: for each digit, rows that share the digits above
    meet in order of their score, and running counts tell how many with a one there score less than each event with a zero. The runs are dealt by range, so no group lies in one task.
    """
    at = F.struct(F.col(time).alias("t"), (~event).cast("int").alias("c"))
    cells = persisted(df.where(F.col(time).isNotNull() & F.col(score).isNotNull() & event.isNotNull()).groupBy(at.alias("k"), F.col(score).alias("s")).agg(F.count("*").alias("n")), "cells")
    ranks = persisted(prefix_sums(cells.select("k").distinct().withColumn("one", F.lit(1)), "k", ["one"]).select("k", (F.col("cum_one") - 1).alias("r")), "ranks")
    digits = max(int(ranks.agg(F.max("r")).first()[0] or 0).bit_length(), 1)
    each = cells.join(ranks, "k").select("s", "n", "k", "r", F.explode(F.sequence(F.lit(0), F.lit(digits - 1))).alias("d")).selectExpr("s", "n", "k.c as c", "d", "shiftright(r, d + 1) as g", "shiftright(r, d) & 1 as bit")
    count = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0)).cast("double")
    keyed = each.groupBy(F.struct("d", "g", "s").alias("key")).agg(count((F.col("bit") == 0) & (F.col("c") == 0)).alias("early"), count(F.col("bit") == 1).alias("late"))
    run = prefix_sums(keyed, "key", ["late"]).withColumn("below", F.col("cum_late") - F.col("late"))
    per = run.groupBy("key.d", "key.g").agg(F.sum(F.col("early") * F.col("below")).alias("a"), F.min("below").alias("base"), F.sum("early").alias("e"), F.sum("late").alias("l"), F.sum(F.col("early") * F.col("late")).alias("t"))
    s = per.agg(F.sum(F.col("e") * F.col("l")).alias("pairs"), F.sum(F.col("a") - F.col("base") * F.col("e")).alias("concordant"), F.sum("t").alias("tied"))
    whole = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return s.select(*map(whole, ("pairs", "concordant", "tied")), F.try_divide(F.col("concordant") + F.col("tied") / 2, F.col("pairs")).alias("c"))


def clustered_mean(df: DataFrame, x: Column, cluster: str) -> DataFrame:
    """clusters, n, mean, se, low, high, z of ``x``, its error from the clusters' sums."""
    per = persisted(df.where(x.isNotNull()).groupBy(cluster).agg(F.sum(x).alias("_s"), F.count("*").alias("_n")), "clusters")
    total = per.agg(F.count("*").alias("clusters"), F.sum("_n").alias("n"), (F.sum("_s") / F.sum("_n")).alias("mean"))
    d = per.crossJoin(F.broadcast(total))  # one row
    r = F.col("_s") - F.col("mean") * F.col("_n")
    s = d.groupBy("clusters", "n", "mean").agg(F.sum(r * r).alias("_q"))
    se = F.sqrt(F.try_divide(F.col("_q") * F.col("clusters"), F.col("clusters") - 1)) / F.col("n")
    return s.withColumn("se", se).select("clusters", "n", "mean", "se", (F.col("mean") - Z95 * F.col("se")).alias("low"), (F.col("mean") + Z95 * F.col("se")).alias("high"), F.try_divide(F.col("mean"), F.col("se")).alias("z"))


def compare_scores(df: DataFrame, label: Column, a: str, b: str, cluster: str) -> DataFrame:
    """``clustered_mean`` of the paired difference of two scores' squared errors: below 0, ``a`` is the better one."""
    y = label.cast("double")
    return clustered_mean(df, (F.col(a) - y) ** 2 - (F.col(b) - y) ** 2, cluster)


def calibration(df: DataFrame, p: str, label: Column) -> DataFrame:
    """slope and intercept of a logistic regression of the label on the score's log odds, and observed less predicted mean."""
    from strandline.operators.causal import glm

    q = F.least(F.greatest(F.col(p), F.lit(1e-9)), F.lit(1 - 1e-9))
    d = df.select(F.log(q / (1 - q)).alias("_odds"), label.cast("double").alias("_y"), F.col(p).alias("_p"))
    fit = {r["term"]: r["coefficient"] for r in glm(d, "_y", ["_odds"], "binomial").collect()}  # two rows
    return d.agg(F.lit(fit["_odds"]).alias("slope"), F.lit(fit["(intercept)"]).alias("intercept"), (F.avg("_y") - F.avg("_p")).alias("difference"))


def learning_curve(train: DataFrame, test: DataFrame, unit: str, xs: list[str], label: str, shares: list[float], seed: str = "curve") -> DataFrame:
    """share, n, auroc on ``test`` of a logistic regression on hashed shares of the training units; larger shares hold the smaller ones."""
    from strandline.operators.features import auroc
    from strandline.operators.models import fit_baseline

    rows = []
    for share in shares:
        part = train.where(md5_unit(F.col(unit), seed) < share)
        rows.append((float(share), part.count(), float(auroc(fit_baseline(part, test, xs, label), "p", F.col(label).cast("boolean")).first()["auroc"])))
    return test.sparkSession.createDataFrame(rows, "share double, n long, auroc double")


#: Cells (a score of a group by a replicate) that a task adds up before it hands them on.
CELLS = 1 << 20


def weighted_counts(rows: DataFrame, keys: list[str], replicates: int) -> DataFrame:
    """keys, rep, n, p: of ``rows`` (keys, n, p, reps) the sums of n and p over every replicate that drew them. Tasks add up before anything is shuffled, so few distinct keys give few rows; the sums of a key may come in several parts."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[tuple, int] = {}
        most = max(CELLS // replicates, 1)
        sums: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            n, p = (np.concatenate([x[k] for x in sums]).reshape(-1, replicates) for k in (0, 1))
            g, rep = np.nonzero(n)
            cols = list(zip(*at, strict=True))
            return pa.RecordBatch.from_arrays([*[pa.array(c, kinds[k]).take(pa.array(g)) for k, c in enumerate(cols)], pa.array(rep.astype(np.int64)), pa.array(n[g, rep]), pa.array(p[g, rep])], names=names)

        for b in batches:
            codes = np.zeros(b.num_rows, np.int64)
            for k in range(len(keys)):
                d = b.column(k).dictionary_encode(null_encoding="encode")
                codes = np.unique(codes * (len(d.dictionary) + 1) + d.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
            first, group = np.unique(codes, return_index=True, return_inverse=True)[1:]
            lists = b.column(len(keys) + 2)
            size = np.diff(lists.offsets.to_numpy())
            cell = np.repeat(group * replicates, size) + lists.flatten().to_numpy()
            width = len(first) * replicates
            new = [np.bincount(cell, np.repeat(b.column(len(keys) + k).to_numpy(), size), width).astype(np.int64).reshape(-1, replicates) for k in (0, 1)]
            mine = list(zip(*[b.column(k).take(pa.array(first)).to_pylist() for k in range(len(keys))], strict=True))
            fresh = [j for j, x in enumerate(mine) if x not in at]
            old = [j for j, x in enumerate(mine) if x in at]
            if old:
                if len(sums) > 1:
                    sums[:] = [tuple(np.concatenate([x[k] for x in sums]) for k in (0, 1))]
                where = [at[mine[j]] for j in old]
                for k in (0, 1):
                    sums[0][k][where] += new[k][old]
            if fresh:
                at.update(zip((mine[j] for j in fresh), range(len(at), len(at) + len(fresh)), strict=True))
                sums.append(tuple(x[fresh] for x in new))
            if len(at) >= most:
                yield out()
                at.clear(), sums.clear()
        if at:
            yield out()

    d = rows.select(*keys, F.col("n").cast("double"), F.col("p").cast("double"), "reps")
    kinds = [f.type for f in d.limit(0).select(*keys).toArrow().schema]
    names = [*keys, "rep", "n", "p"]
    return d.mapInArrow(add, ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in d.select(*keys).schema], "rep long", "n long", "p long"]))


def replicated_metrics(df: DataFrame, cluster: str, score: str, label: Column, replicates: int, seed: int = 1, by: list[str] = (), reps: DataFrame | None = None) -> DataFrame:
    """by, rep (-1: all rows once), n, auroc, auprc, brier. Clusters are drawn, not rows: the replicates that drew a cluster (``reps``, from ``drawn_in``, where several scores share them) weigh the table of scores by cluster, whose scores are then ranked within each replicate. No model is fitted again."""
    d = df.select(F.col(cluster).alias("_c"), *by, F.col(score).cast("double").alias("_s"), label.cast("int").alias("_y")).where("_s is not null and _y is not null and _c is not null")
    t = persisted(d.groupBy("_c", *by, "_s").agg(F.count("*").alias("n"), F.sum("_y").alias("p")), "scores")
    every = t.select(*by, "_s", F.lit(-1).cast("long").alias("rep"), "n", "p")
    if reps is None:
        reps = drawn_in(t.select("_c").distinct(), "_c", replicates, seed)
    drawn = weighted_counts(t.join(reps, "_c"), [*by, "_s"], replicates).select(*by, "_s", "rep", "n", "p")
    keys = [*by, "rep"]
    r = prefix_sums(every.unionByName(drawn).groupBy(*keys, "_s").agg(F.sum("n").alias("n"), F.sum("p").alias("p")), "_s", ["n", "p"], keys=keys, totals=True)
    n, p = F.col("n").cast("double"), F.col("p").cast("double")
    above = lambda c: F.col(f"all_{c}") - F.col(f"cum_{c}") + F.col(c)
    s = r.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("p").cast("double").alias("_p"), F.sum((F.col("cum_n") - (n - 1) / 2) * p).alias("_r"), F.sum(p * above("p") / above("n")).alias("_a"), F.sum(p * (1 - F.col("_s")) ** 2 + (n - p) * F.col("_s") ** 2).alias("_b"),
    )
    m, q = F.col("n").cast("double"), F.col("_p")
    return s.select(*keys, "n", F.try_divide(F.col("_r") - q * (q + 1) / 2, q * (m - q)).alias("auroc"), F.try_divide("_a", "_p").alias("auprc"), (F.col("_b") / m).alias("brier"))


METRICS = ("auroc", "auprc", "brier")


def _intervals(reps: DataFrame, by: list[str], level: float) -> DataFrame:
    a = (1 - level) / 2
    each = reps.select(*by, "rep", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in METRICS])).alias("x")).select(*by, "rep", "x.*")
    drawn, one = F.when(F.col("rep") >= 0, F.col("v")), F.when(F.col("rep") < 0, F.col("v"))
    q = F.percentile(drawn, F.array(F.lit(a), F.lit(1 - a)))  # as many values as replicates
    return each.groupBy(*by, "metric").agg(F.max(one).alias("estimate"), q.alias("_q"), F.stddev_samp(drawn).alias("se")).select(*by, "metric", "estimate", F.col("_q")[0].alias("low"), F.col("_q")[1].alias("high"), "se")


def metric_intervals(df: DataFrame, cluster: str, score: str, label: Column, replicates: int = 200, seed: int = 1, by: list[str] = (), level: float = 0.95) -> DataFrame:
    """by (such as fold or era), metric (auroc, auprc, brier), estimate, low, high (percentile), se over whole clusters."""
    return _intervals(replicated_metrics(df, cluster, score, label, replicates, seed, list(by)), list(by), level)


def paired_intervals(df: DataFrame, cluster: str, a: str, b: str, label: Column, replicates: int = 200, seed: int = 1, by: list[str] = (), level: float = 0.95) -> DataFrame:
    """by, metric, estimate of score ``a`` less score ``b``, low, high, se: both are measured on the same draws. Rows must have both scores; others are left out of both."""
    d = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    reps = persisted(drawn_in(d.where(label.isNotNull() & F.col(cluster).isNotNull()).select(F.col(cluster).alias("_c")).distinct(), "_c", replicates, seed), "draws")
    one, two = (replicated_metrics(d, cluster, s, label, replicates, seed, list(by), reps) for s in (a, b))
    keys = [*by, "rep"]
    two = persisted(two.select(*keys, *[F.col(m).alias(f"_{m}") for m in METRICS]), "metrics")
    one = persisted(one, "metrics")
    j = one.join(two, same_keys(one, two, keys)).select(*[one[k] for k in keys], *[(F.col(m) - F.col(f"_{m}")).alias(m) for m in METRICS])
    return _intervals(j, list(by), level)


def subgroup_auroc(df: DataFrame, dims: list[str], score: str, label: Column) -> DataFrame:
    """dim, level, n, positives, prevalence, mean_score, auroc of every level, over rows with a score; scores of a level are ranked by ranges, so no level is one task."""
    pairs = F.explode(F.array(F.struct(F.lit("all").alias("dim"), F.lit("all").alias("level")), *[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("level")) for d in dims]))
    t = df.select(F.col(score).alias("_s"), label.cast("int").alias("_y"), pairs.alias("x")).groupBy("x.dim", "x.level", "_s").agg(F.count("*").alias("n"), F.sum("_y").alias("p"))
    t = prefix_sums(t.where("_s is not null"), "_s", ["n"], keys=["dim", "level"])
    s = t.withColumn("_r", F.col("cum_n") - (F.col("n") - 1) / 2).groupBy("dim", "level").agg(F.sum("n").alias("n"), F.sum("p").alias("positives"), (F.sum(F.col("_s") * F.col("n")) / F.sum("n")).alias("mean_score"), F.sum(F.col("_r") * F.col("p")).alias("_t"))
    p, n = F.col("positives").cast("double"), F.col("n").cast("double")
    return s.select("dim", "level", "n", "positives", (p / n).alias("prevalence"), "mean_score", F.try_divide(F.col("_t") - p * (p + 1) / 2, p * (n - p)).alias("auroc"))


def error_profile(df: DataFrame, score: str, label: Column, cut: float, xs: list[str]) -> DataFrame:
    """outcome (tp, fp, fn, tn), n, mean score, and the mean of each variable there."""
    hit = F.col(score) >= cut
    kind = F.when(hit & label, "tp").when(hit, "fp").when(label, "fn").otherwise("tn")
    return df.groupBy(kind.alias("outcome")).agg(F.count("*").alias("n"), F.avg(score).alias("mean_score"), *[F.avg(x).alias(f"mean_{x}") for x in xs])


def era_split(era: Column, dev: int, gap: int = 0) -> Column:
    """train up to era ``dev``, purged for ``gap`` eras behind it, then test."""
    return F.when(era <= dev, "train").when(era <= dev + gap, "purged").when(era.isNotNull(), "test")


def temporal_folds(df: DataFrame, era: Column, first: int, last: int) -> DataFrame:
    """``df`` with fold and role, a row for each fold that it is in: fold e tests on era e, from ``first`` to ``last``, and trains on all eras before it."""
    d = df.withColumn("_e", era).where(F.col("_e").isNotNull() & (F.col("_e") <= last))
    d = d.withColumn("fold", F.explode(F.sequence(F.greatest(F.col("_e"), F.lit(first)).cast("int"), F.lit(last))))
    return d.withColumn("role", F.when(F.col("fold") == F.col("_e"), "test").otherwise("train")).drop("_e")


def nested_folds(df: DataFrame, subject: str, outer: int, inner: int, seed: str) -> DataFrame:
    """subject, fold, inner (null: the subject tests that outer fold): for every outer fold, the inner fold of the subjects that train it."""
    f = lambda s, k: F.floor(md5_unit(F.col(subject), s) * k).cast("int")
    u = df.select(subject).distinct().withColumn("_o", f(seed, outer)).withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(outer - 1))))
    return u.select(subject, "fold", F.when(F.col("_o") != F.col("fold"), f(f"{seed}:inner", inner)).alias("inner"))


def require_whole_subjects(df: DataFrame, subject: str, fold: str) -> DataFrame:
    """``df``; raises where a subject's rows lie in several folds."""
    split = df.groupBy(subject).agg(F.countDistinct(fold).alias("n")).where("n > 1").limit(1).count()
    if split:
        raise ValueError(f"rows of a {subject} lie in several folds: assign folds to whole subjects")
    return df


def bootstrap_intervals(df: DataFrame, cluster: str, total: Column, count: Column, replicates: int = 200, seed: int = 1, level: float = 0.95) -> DataFrame:
    """kind (percentile, basic, bca), estimate, low, high of sum(total) / sum(count) over whole clusters. Only the clusters' two sums are replicated; the acceleration comes from leaving each out once."""
    c = persisted(df.groupBy(cluster).agg(F.sum(total).alias("_x"), F.sum(count).alias("_n")), "clusters")
    reps = persisted(draws(c, cluster, replicates, seed, ["_x", "_n"]).groupBy("rep").agg((F.sum(F.col("_x") * F.col("times")) / F.sum(F.col("_n") * F.col("times"))).alias("s")), "replicates")
    all_x, all_n = c.agg(F.sum("_x"), F.sum("_n")).first()
    est = all_x / all_n
    left = c.select(F.try_divide(all_x - F.col("_x"), all_n - F.col("_n")).alias("j")).where("j is not null")
    mean = left.agg(F.avg("j")).first()[0] or 0.0
    d = F.lit(float(mean)) - F.col("j")
    cube, square = left.agg(F.sum(d * d * d), F.sum(d * d)).first()
    accel = cube / (6 * square**1.5) if square else 0.0
    normal = NormalDist()
    share = reps.agg(((F.count_if(F.col("s") < est) + F.count_if(F.col("s") == est) / 2) / F.count("*"))).first()[0]
    z0 = normal.inv_cdf(min(max(share, 0.5 / replicates), 1 - 0.5 / replicates))
    a = (1 - level) / 2
    shifted = [normal.cdf(z0 + (z0 + z) / (1 - accel * (z0 + z))) for z in (normal.inv_cdf(a), normal.inv_cdf(1 - a))]
    q = reps.agg(F.percentile("s", F.array(*map(F.lit, [a, 1 - a, *shifted])))).first()[0]
    rows = [("percentile", est, q[0], q[1]), ("basic", est, 2 * est - q[1], 2 * est - q[0]), ("bca", est, q[2], q[3])]
    return df.sparkSession.createDataFrame([(k, *map(float, v)) for k, *v in rows], "kind string, estimate double, low double, high double")
