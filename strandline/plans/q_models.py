"""Queries over fitted models (the rows of survey 2.15 to 2.20 that learn)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import models as m
from strandline.plans.q_features import SC, scored
from strandline.plans.q_timeline import rounded
from strandline.plans.registry import query
from strandline.sources.tables import load, scratch


def parts(spark, sf):
    o = load(spark, sf, "orders")
    d = o.select("o_orderkey", "o_custkey", (F.col("o_totalprice") / 1e5).alias("price"), (F.col("o_orderkey") % 7).cast("double").alias("k"), (F.col("o_totalprice") + F.col("o_orderkey") % 7 * 20000 > 300000).cast("int").alias("y"))
    return d.where("o_orderkey % 4 <> 0"), d.where("o_orderkey % 4 = 0")


@query("o3_multinomial")
def o3(spark, sf):
    return rounded(m.multinomial(parts(spark, sf)[0].withColumn("s", F.concat(F.lit("s"), F.col("o_orderkey") % 3)), "s", ["price", "k"]), "coefficient", to=3)


@query("o5_marginal_effect")
def o5(spark, sf):
    train, test = parts(spark, sf)
    return rounded(m.average_marginal_effect(test, lambda d: m.fit_baseline(train, d, ["price", "k"], "y"), "k"), "p1", "p0", "ame", to=3)


@query("o6_binned_residuals", f"WITH {SC} SELECT least(floor(p * 10), 9)::BIGINT AS bin, count(*) AS n, round(avg(y::INT), 6) AS observed, round(avg(p), 6) AS predicted, round(avg(y::INT) - avg(p), 6) AS residual FROM sc GROUP BY 1")
def o6(spark, sf):
    return rounded(m.binned_residuals(scored(spark, sf), F.col("y"), "p"), "observed", "predicted", "residual")


@query("r8_baselines")
def r8(spark, sf):
    train, test = parts(spark, sf)
    return m.fit_baseline(train, test, ["price", "k"], "y", "svm", 0.01).select("o_orderkey", F.round("p", 2).alias("p"))


@query("r9_trees")
def r9(spark, sf):
    return rounded(m.fit_trees(parts(spark, sf)[0], ["price", "k"], "y")[1], "importance", to=3)


@query("r9b_stack")
def r9b(spark, sf):
    d = parts(spark, sf)[0].withColumn("fold", F.pmod(F.col("o_custkey"), F.lit(3)))
    return m.out_of_fold(d, ["price", "k"], "y", "fold", 3).select("o_orderkey", "fold", F.round("p", 2).alias("p"))


@query("r10b_kmeans")
def r10b(spark, sf):
    return m.kmeans(load(spark, sf, "embeddings"), "embedding", 4).groupBy("cluster", "label").agg(F.count("*").alias("n"))


@query("r11_robust_z", "WITH a AS (SELECT quantile_cont(value, 0.5) AS m FROM events), d AS (SELECT quantile_cont(abs(value - m), 0.5) AS d FROM events, a) SELECT event_id, round((value - m) / (1.4826::DOUBLE * d), 6) AS z_value FROM events, a, d")
def r11(spark, sf):
    return rounded(m.robust_z(load(spark, sf, "events").select("event_id", "value"), ["value"]), "z_value").drop("value")


@query("r11b_mahalanobis", """WITH s AS (SELECT avg(l_quantity) AS a, avg(l_discount) AS b, var_samp(l_quantity) AS v, var_samp(l_discount) AS w, covar_samp(l_quantity, l_discount) AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, round(((l_quantity - a) * (l_quantity - a) * w - 2 * (l_quantity - a) * (l_discount - b) * c + (l_discount - b) * (l_discount - b) * v) / (v * w - c * c), 4) AS distance2 FROM lineitem, s""")
def r11b(spark, sf):
    return rounded(m.mahalanobis(load(spark, sf, "lineitem"), ["l_quantity", "l_discount"]), "distance2", to=4).select("l_orderkey", "l_linenumber", "distance2")


@query("r11c_flagged_by_era", """WITH s AS (SELECT avg(l_quantity) AS a, avg(l_discount) AS b, var_samp(l_quantity) AS v, var_samp(l_discount) AS w, covar_samp(l_quantity, l_discount) AS c FROM lineitem),
d AS (SELECT year(l_shipdate) AS yr, ((l_quantity - a) * (l_quantity - a) * w - (l_quantity - a) * (l_discount - b) * c) / (v * w - c * c) AS p, ((l_discount - b) * (l_discount - b) * v - (l_quantity - a) * (l_discount - b) * c) / (v * w - c * c) AS q FROM lineitem, s)
SELECT yr, count(*) AS n, count(*) FILTER (p + q > 4) AS flagged, count(*) FILTER (p + q > 4 AND p >= q) AS led_by_l_quantity, count(*) FILTER (p + q > 4 AND q >= p) AS led_by_l_discount, round(count(*) FILTER (p + q > 4) / count(*), 6) AS share FROM d GROUP BY 1""")
def r11c(spark, sf):
    d = m.mahalanobis(load(spark, sf, "lineitem").withColumn("yr", F.year("l_shipdate")), ["l_quantity", "l_discount"])
    return rounded(m.flagged_by_era(d, "yr", "distance2", 4.0, ["part_l_quantity", "part_l_discount"]), "share")


@query("r14_pca")
def r14(spark, sf):
    return m.pca(load(spark, sf, "embeddings"), "embedding", 3).select("component", F.round("explained", 4).alias("explained"))


@query("r15_stability_selection")
def r15(spark, sf):
    return m.stability_selection(parts(spark, sf)[0], "o_custkey", ["price", "k"], "y", 3)


@query("r16_latent_classes")
def r16(spark, sf):
    d = load(spark, sf, "lineitem").select((F.col("l_quantity") > 25).alias("a"), (F.col("l_extendedprice") > 40000).alias("b"), (F.col("l_discount") > 0.05).alias("c"), (F.col("l_tax") > 0.04).alias("d"))
    return rounded(m.latent_classes(d, ["a", "b", "c", "d"], 2), "share", "log_likelihood", "bic", to=2)


@query("r19_audit_robustness")
def r19(spark, sf):
    train, test = parts(spark, sf)
    return rounded(m.audit_robustness(train, test, "o_orderkey", ["price", "k"], "y"), "auroc_missing", "auroc_scaled", to=3)


@query("r20b_permutation_importance")
def r20b(spark, sf):
    train, test = parts(spark, sf)
    return rounded(m.permutation_importance(train, test, "o_orderkey", ["price", "k"], "y"), "drop", to=3)


@query("r20c_dependence_table", f"WITH {SC} SELECT floor(o_totalprice / 50000) * 50000 AS bin, count(*) AS n, round(avg(p), 6) AS mean FROM sc GROUP BY 1")
def r20c(spark, sf):
    return rounded(m.dependence_table(scored(spark, sf), "o_totalprice", "p", 50000), "mean")


@query("r21_ablation_grid")
def r21(spark, sf):
    train, test = parts(spark, sf)
    return rounded(m.ablation_grid(train, test, {"money": ["price"], "key": ["k"]}, "y"), "auroc", to=3)


@query("r21b_ablation_cells")
def r21b(spark, sf):
    train, test = parts(spark, sf)
    summer = train.join(load(spark, sf, "orders").where(F.month("o_orderdate").between(4, 9)).select("o_orderkey"), "o_orderkey", "left_semi")
    fits = {"logistic": m.fit_baseline, "ridge": lambda *a: m.fit_baseline(*a, reg=0.1)}
    return rounded(m.ablation_cells({"summer": (summer, test), "all": (train, test)}, {"money": ["price"], "key": ["k"]}, fits, "y", scratch(spark, "ablation")), "auroc", to=3)


T6 = """WITH q AS (SELECT vec_id AS query, embedding AS a, label AS l FROM embeddings WHERE vec_id % 20 = 0), e AS (SELECT label, count(*) / sum(count(*)) OVER () AS e FROM embeddings GROUP BY 1),
s AS (SELECT query, l, label, vec_id, list_sum(list_transform(list_zip(a, embedding), lambda p: p[1]::DOUBLE * p[2]::DOUBLE)) / (sqrt(list_sum(list_transform(a, lambda v: v::DOUBLE * v::DOUBLE))) * sqrt(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE)))) AS s FROM q JOIN embeddings ON vec_id <> query),
r AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY query ORDER BY s DESC, vec_id) <= 5) SELECT round(avg((r.label = r.l)::INT), 6) AS share, round(avg(e.e), 6) AS expected, round(avg((r.label = r.l)::INT) / avg(e.e), 6) AS lift FROM r JOIN e ON e.label = r.l"""


@query("t6_neighbour_agreement", T6)
@query("t6b_neighbour_agreement_all", T6)
def t6(spark, sf):
    e = load(spark, sf, "embeddings")
    return rounded(m.neighbour_agreement(e, e.where("vec_id % 20 = 0"), "vec_id", "embedding", "label", 5), "share", "expected", "lift")


@query("r14c_sparse_svd")
def r14c(spark, sf):
    """Orders by parts: which parts are ordered together, by the five largest singular values."""
    from strandline.operators.sparse import sparse_svd

    return rounded(sparse_svd(load(spark, sf, "lineitem"), "l_orderkey", "l_partkey", "l_quantity", 5)[0], "sigma", to=3).withColumn("share", F.round("share", 6))


@query("r22b_one_look")
def r22b(spark, sf):
    from strandline.operators.holdout import Protocol, one_look

    o = load(spark, sf, "orders")
    d = o.select("o_orderdate", (F.col("o_totalprice") / 1e5).alias("price"), (F.col("o_orderkey") % 7).cast("double").alias("k"), (F.col("o_totalprice") + F.col("o_orderkey") % 7 * 20000 > 300000).cast("int").alias("y"))
    p = Protocol("late orders", "o_orderdate", ("1995-01-01", "1998-01-01"), ("1998-01-01", "1999-01-01"), ("price", "k"), "y")
    return rounded(one_look(d, p, lambda dev: m.baseline(dev, list(p.features), p.label), scratch(spark, "ledger")), "auroc", to=4)
