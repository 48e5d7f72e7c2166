"""Operators that SQL can't express, against plain computations, known answers or invariants on small rows."""

import hashlib
import json
import math
import random
from pathlib import Path
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions import timesem as ts
from strandline.operators import assess, causal, explore, features, inference, models, regress, sums, survival, text
from strandline.operators import checks as ch
from strandline.sources import tables as src


@pytest.fixture(scope="module")
def noisy(spark):
    """y follows a logistic of 2 x - 1; z is noise; subject g has ten rows."""
    rng = random.Random(11)
    rows = []
    for n in range(1200):
        x, z = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((n, n // 10, x, z, int(rng.random() < 1 / (1 + math.exp(1 - 2 * x)))))
    return spark.createDataFrame(rows, "n long, g long, x double, z double, y int").repartition(3)


def table(rows, *names):
    return {r[names[0]]: r for r in rows.collect()}


def test_inventories(spark, sf, tmp_path):
    path = Path(sf) / "orders.parquet"
    inv = src.file_inventory(spark, str(path))
    one = inv.first()
    assert one["bytes"] == path.stat().st_size and one["n_rows"] == src.load(spark, sf, "orders").count()
    assert src.file_inventory(spark, str(path), inv).count() == 0
    want = hashlib.sha256(json.dumps([{"bytes": one["bytes"], "n_rows": one["n_rows"]}], separators=(",", ":")).encode()).hexdigest()
    few = inv.select("bytes", "n_rows")
    assert src.snapshot_id(few, ["bytes", "n_rows"]).first()[0] == want
    assert src.snapshot_id(few.withColumn("bytes", F.lit(None).cast("long")), ["bytes", "n_rows"]).first()[0] is None
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.csv").write_text("h,i\n" + "".join(f"{n},x\n" for n in range(50)))
    (tmp_path / "t" / "b.csv").write_text("i,h\n1,2\n")
    got = table(src.text_inventory(spark, str(tmp_path / "t"), "h,i"), "file")
    assert (got["a.csv"]["n_lines"], got["a.csv"]["header_ok"], got["b.csv"]["header_ok"]) == (51, True, False)
    (tmp_path / "t" / "b.csv").write_text("i,h\n1,3\n")
    after = table(src.text_inventory(spark, str(tmp_path / "t"), "h,i"), "file")
    assert after["a.csv"]["content_hash"] == got["a.csv"]["content_hash"] and after["b.csv"]["content_hash"] != got["b.csv"]["content_hash"]


def test_fingerprint_and_partition(spark):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    a = src.table_fingerprint(df, ["id", "v"]).first()
    assert a == src.table_fingerprint(df.orderBy(F.desc("id")).repartition(7), ["id", "v"]).first()
    assert a != src.table_fingerprint(df.where("id <> 5"), ["id", "v"]).first() and a["n_rows"] == 100
    fold = lambda d: {r["id"]: r["f"] for r in d.select("id", ts.hash_partition(F.col("id"), 7, 5).alias("f")).collect()}
    assert fold(df) == fold(df.repartition(3)) and set(fold(df).values()) == set(range(5))


def test_rejects_raise_beyond_the_limit(spark):
    spec = src.TableSpec("t", T.StructType.fromDDL("a int, b int"))
    raw = spark.createDataFrame([("1", "x"), ("y", "z"), ("2", "3")], "a string, b string")
    good, bad = src.split_rejects(raw, spec, 2)
    assert good.count() == 1 and {r["column"]: r["n"] for r in src.reject_report(bad).collect()} == {"a": 1, "b": 2}
    with pytest.raises(ValueError):
        src.split_rejects(raw, spec, 1)


def test_order_is_checked_by_runs(spark, tmp_path, monkeypatch):
    """a file's rows don't meet in one task; breaks within and between runs count once each, none between files."""
    monkeypatch.setattr(ch, "RUN", 3)
    monkeypatch.setattr(sums, "TASK", 32)
    for name, ks in (("a", [*range(7), 99, *range(8, 30), 3, None, *range(40, 200)]), ("b", [5, 4, 6])):
        spark.createDataFrame([(k,) for k in ks], "k int").coalesce(1).write.parquet(str(tmp_path / "runs" / name))
    got = ch.check_sorted(spark.read.parquet(str(tmp_path / "runs" / "*")), "t", ["k"]).first()
    assert (got["n_affected"], got["n_total"]) == (4, 195)  # 99 > 8 at a run's end, 29 > 3, 3 > null, 5 > 4
    assert ch.check_sorted(spark.read.parquet(str(tmp_path / "runs" / "a")).where("false"), "t", ["k"]).first()["n_total"] == 0


def test_schema_and_order_checks(spark, tmp_path):
    df = spark.createDataFrame([("1", 2), ("x", 3)], "a string, c int")
    got = table(ch.check_schema(df, src.TableSpec("t", T.StructType.fromDDL("a int, b int"))), "column")
    assert {k: r["n_affected"] for k, r in got.items()} == {"a": 1, "b": 2, "*": 1}
    spark.createDataFrame([(1,), (3,), (2,), (4,)], "k int").coalesce(1).write.parquet(str(tmp_path / "s"))
    assert ch.check_sorted(spark.read.parquet(str(tmp_path / "s")), "t", ["k"]).first()["n_affected"] == 1
    child = spark.createDataFrame([(1, 1), (1, 2)], "id int, p int")
    spec = src.TableSpec("c", child.schema, ("id",))
    seen = ch.validate_all({"c": child}, [spec], [], [ch.check_domain(child, "c", "late", F.col("p") > 5)])
    assert "fail" in {r["status"] for r in seen.collect()} and seen.where("check_id = 'domain'").count() == 0  # structure first


def test_small_probabilities(spark, sf):
    df = spark.createDataFrame([(0.0, "a"), (1.0, "a"), (2.0, "a"), (5.0, "b"), (6.0, "b"), (7.0, "b")], "v double, g string")
    r = inference.compare_means(df, "v", F.col("g") == "a").select("t", "df", inference.t_p("t", "df").alias("p")).first()
    assert math.isclose(r["t"], -5 / math.sqrt(2 / 3), rel_tol=1e-12) and math.isclose(r["df"], 4, rel_tol=1e-9) and math.isclose(r["p"], 0.003600, abs_tol=5e-5)
    e = src.load(spark, sf, "events")
    a, b = (inference.permutation_test(d, "user_id", "value", F.col("user_id") % 2 == 0, 40).first() for d in (e, e.repartition(5)))
    assert a["p"] == b["p"] and 0 < a["p"] <= 1
    n = spark.createDataFrame([(k, float(k), k < 10) for k in range(20)], "u int, v double, t boolean")
    far = inference.permutation_test(n, "u", "v", F.col("t"), 60).first()
    assert far["diff"] == -10 and far["p"] == 1 / 61


def test_exact_intervals(spark):
    df = spark.createDataFrame([(3, 10), (0, 5)], "x long, n long").coalesce(1)
    a, b = df.select(explore.ci_exact("x", "n").alias("b"), explore.ci_exact_count("x").alias("c")).collect()
    assert math.isclose(a["b"]["low"], 0.06673951117773447, rel_tol=1e-7) and b["b"]["low"] == 0
    assert math.isclose(b["c"]["high"], 3.688879454113936, rel_tol=1e-7)


def test_bootstrap_intervals(spark):
    rng = random.Random(3)
    rows = [(g, rng.expovariate(1)) for g in range(60) for _ in range(3)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = table(assess.bootstrap_intervals(df, "g", F.col("v"), F.lit(1), 400), "kind")
    mean = sum(v for _, v in rows) / len(rows)
    p = got["percentile"]
    assert all(math.isclose(r["estimate"], mean, rel_tol=1e-9) for r in got.values())
    assert math.isclose(got["basic"]["low"], 2 * mean - p["high"], rel_tol=1e-9) and p["low"] < mean < p["high"]
    assert got["bca"]["low"] < mean < got["bca"]["high"] and got["bca"]["low"] > p["low"] - 0.05  # skewed to the right: the interval moves up or stays
    assert NormalDist().inv_cdf(0.5) == 0


def test_regressions_against_numpy(spark, noisy):
    d = noisy.toPandas()
    x = np.column_stack([np.ones(len(d)), d.x, d.z])
    b = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ b))
        b = b + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x, x.T @ (d.y - p))
    got = table(causal.glm(noisy, "y", ["x", "z"], "binomial"), "term")
    assert [got[t]["coefficient"] for t in ("(intercept)", "x", "z")] == pytest.approx(b, abs=1e-4)
    y = (2 + 3 * d.x - d.z + np.sin(d.n)).to_numpy()
    inv = np.linalg.inv(x.T @ x)
    e = y - x @ (inv @ x.T @ y)
    s = np.array([(x[d.g == g] * e[d.g == g][:, None]).sum(axis=0) for g in d.g.unique()])
    k, n = len(s), len(d)
    want = np.sqrt(np.diag(inv @ s.T @ s @ inv) * k / (k - 1) * (n - 1) / (n - 3))
    rows = table(causal.cluster_robust(noisy.withColumn("w", 2 + 3 * F.col("x") - F.col("z") + F.sin("n")), "w", ["x", "z"], "g"), "term")
    assert [rows[t]["hc_se"] for t in ("(intercept)", "x", "z")] == pytest.approx(want, rel=1e-6)
    assert table(causal.informative_missing(noisy.withColumn("m", F.when(F.col("y") == 0, 1)), "m", ["x", "z"]), "term")["x"]["coefficient"] == pytest.approx(b[1], abs=1e-4)


def test_ordinal_and_count_models(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=4000)
    u = rng.logistic(size=4000) + 1.5 * x
    df = spark.createDataFrame([(float(a), int(c > -1) + int(c > 1), int(n)) for a, c, n in zip(x, u, rng.poisson(np.exp(0.5 + 0.7 * x) * rng.gamma(2, 0.5, 4000)))], "x double, y int, n int").repartition(3)
    got = {r["term"]: (r["coefficient"], r["se"]) for r in regress.ordinal_logit(df, "y", ["x"], 3).collect()}
    for term, true in (("cut_0", -1), ("cut_1", 1), ("x", 1.5)):
        assert abs(got[term][0] - true) < 4 * got[term][1] and got[term][1] < 0.1
    counts = {r["term"]: r["coefficient"] for r in regress.negative_binomial(df, "n", ["x"]).collect()}
    assert counts["(intercept)"] == pytest.approx(0.5, abs=0.1) and counts["x"] == pytest.approx(0.7, abs=0.1) and counts["(alpha)"] == pytest.approx(0.5, abs=0.2)
    names = spark.createDataFrame([(float(a), "abc"[int(c > -1) + int(c > 1)]) for a, c in zip(x[:600], u[:600])], "x double, s string")
    m = {(r["level"], r["term"]): r["coefficient"] for r in models.multinomial(names, "s", ["x"]).collect()}
    assert m["a", "x"] < m["b", "x"] < m["c", "x"]


def test_cox_counting_against_loops(spark):
    rng = random.Random(9)
    rows = []
    for u in range(40):
        t = 0
        for _ in range(rng.randint(1, 3)):
            z = t + rng.randint(1, 6)
            rows.append((u, u % 2, t, z, rng.random() < 0.5, rng.random(), float(rng.randint(0, 1))))
            t = z
    df = spark.createDataFrame(rows, "u int, st int, a int, z int, e boolean, x double, w double").repartition(3)
    got = regress.cox_counting(df, "a", "z", F.col("e"), ["x", "w"], "st", "u").collect()
    cov = np.array([[r[5], r[6]] for r in rows])
    st, a, z, e = (np.array([r[k] for r in rows]) for k in (1, 2, 3, 4))
    b = np.zeros(2)
    for _ in range(30):
        g, h, w = np.zeros(2), np.zeros((2, 2)), np.exp(cov @ b)
        for i in np.flatnonzero(e):
            at = (st == st[i]) & (a < z[i]) & (z >= z[i])
            m = (w[at, None] * cov[at]).sum(0) / w[at].sum()
            g += cov[i] - m
            h += (w[at, None, None] * cov[at, :, None] * cov[at, None, :]).sum(0) / w[at].sum() - np.outer(m, m)
        b = b + np.linalg.solve(h, g)
    w, res = np.exp(cov @ b), np.zeros_like(cov)
    for i in np.flatnonzero(e):
        at = (st == st[i]) & (a < z[i]) & (z >= z[i])
        m = (w[at, None] * cov[at]).sum(0) / w[at].sum()
        res[i] += cov[i] - m
        res[at] -= w[at, None] * (cov[at] - m) / w[at].sum()
    s = np.array([res[[k for k, r in enumerate(rows) if r[0] == u]].sum(0) for u in range(40)])
    inv = np.linalg.inv(h)
    assert [r["beta"] for r in got] == pytest.approx(b, abs=1e-6)
    assert [r["se"] for r in got] == pytest.approx(np.sqrt(np.diag(inv)), rel=1e-5)
    assert [r["robust_se"] for r in got] == pytest.approx(np.sqrt(np.diag(inv @ s.T @ s @ inv)), rel=1e-5)


def test_survival_models(spark):
    rng = np.random.default_rng(2)
    g = np.arange(1500) % 2
    t = np.exp(1 + 0.8 * g) * rng.weibull(2, 1500)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(t, g)], "t double, g int")
    fit = {r["term"]: r["coefficient"] for r in survival.aft_weibull(df, "t", F.lit(True), ["g"]).collect()}
    assert fit["(intercept)"] == pytest.approx(1, abs=0.1) and fit["g"] == pytest.approx(0.8, abs=0.1) and fit["(scale)"] == pytest.approx(0.5, abs=0.06)
    small = df.limit(200).where("t > 0")
    cox = survival.cox(small, "t", F.lit(True), ["g"])
    r = survival.schoenfeld_test(small, "t", F.lit(True), cox).first()
    d, beta = small.toPandas().sort_values("t"), cox.first()["beta"]
    w = np.exp(beta * d.g.to_numpy())
    mean = np.array([(w[k:] * d.g.to_numpy()[k:]).sum() / w[k:].sum() for k in range(len(d))])
    assert r["r"] == pytest.approx(np.corrcoef(d.g.to_numpy() - mean, d.t)[0, 1], abs=1e-6) and r["n"] == len(d)


def test_c_index_against_pairs(spark):
    rng = random.Random(4)
    for n, times in ((1, 3), (60, 5), (150, 90)):
        rows = [(float(rng.randint(0, times)), rng.random() < 0.6, rng.randint(0, 9)) for _ in range(n)] + [(None, True, 1), (1.0, True, None)]
        known = [r for r in rows if None not in r]
        pairs = [(i, j) for i in known for j in known if i[1] and (i[0] < j[0] or i[0] == j[0] and not j[1])]
        got = assess.c_index(spark.createDataFrame(rows, "t double, e boolean, s int"), "t", F.col("e"), "s").first()
        assert (got["pairs"], got["concordant"], got["tied"]) == (len(pairs), sum(i[2] > j[2] for i, j in pairs), sum(i[2] == j[2] for i, j in pairs))


def test_propensity_and_baselines(spark, noisy):
    p = causal.propensity(noisy, "y", ["x"]).toPandas()
    assert ((p.ps > 0) & (p.ps < 1)).all() and np.corrcoef(p.ps, 1 / (1 + np.exp(1 - 2 * p.x)))[0, 1] > 0.99
    assert p.ps.mean() == pytest.approx(p.y.mean(), abs=1e-3)  # the score equation of the intercept
    train, test = noisy.where("g % 3 <> 0"), noisy.where("g % 3 = 0")
    auc = lambda d: features.auroc(d, "p", F.col("y").cast("boolean")).first()["auroc"]
    whole = auc(models.fit_baseline(train, test, ["x", "z"], "y"))
    assert whole > 0.8 and auc(models.fit_baseline(train, test, ["x"], "y", "svm", 0.01)) > 0.8
    folded = models.out_of_fold(noisy.withColumn("f", F.col("g") % 3), ["x"], "y", "f", 3)
    one = models.fit_baseline(noisy.where("g % 3 <> 1"), noisy.where("g % 3 = 1"), ["x"], "y")
    assert folded.count() == noisy.count() and {(r["n"], round(r["p"], 6)) for r in one.collect()} <= {(r["n"], round(r["p"], 6)) for r in folded.collect()}
    gain = table(models.fit_trees(train, ["x", "z"], "y")[1], "feature")
    assert gain["x"]["importance"] > 0.7 and sum(r["importance"] for r in gain.values()) == pytest.approx(1)
    kept = table(models.stability_selection(noisy, "g", ["x", "z"], "y", 3), "feature")
    assert (kept["x"]["frequency"], kept["z"]["frequency"]) == (1.0, 0.0)
    drop = table(models.permutation_importance(train, test, "n", ["x", "z"], "y"), "feature")
    assert drop["x"]["drop"] > 0.2 and abs(drop["z"]["drop"]) < 0.03
    grid = table(models.ablation_grid(train, test, {"a": ["x"], "b": ["z"]}, "y"), "group")
    assert grid["(none)"]["auroc"] == pytest.approx(whole) and grid["a"]["auroc"] < 0.6 < 0.8 < grid["b"]["auroc"]
    worse = table(models.audit_robustness(train, test, "n", ["x", "z"], "y"), "feature")
    assert worse["x"]["auroc_missing"] < whole - 0.02 and worse["z"]["auroc_missing"] == pytest.approx(whole, abs=0.02)
    mean = lambda v: models.fit_baseline(train, test.withColumn("x", F.lit(v)), ["x", "z"], "y").agg(F.avg("p")).first()[0]
    ame = models.average_marginal_effect(test, lambda d: models.fit_baseline(train, d, ["x", "z"], "y"), "x").first()
    assert (ame["p1"], ame["p0"], ame["ame"]) == pytest.approx((mean(1.0), mean(0.0), mean(1.0) - mean(0.0)))
    curve = assess.learning_curve(train, test, "n", ["x", "z"], "y", [0.05, 1.0]).orderBy("share").collect()
    assert curve[0]["n"] < curve[1]["n"] == train.count() and curve[1]["auroc"] == pytest.approx(whole)
    true = noisy.withColumn("p", 1 / (1 + F.exp(1 - 2 * F.col("x"))))
    c = assess.calibration(true, "p", F.col("y")).first()
    assert c["slope"] == pytest.approx(1, abs=0.2) and abs(c["intercept"]) < 0.25 and abs(c["difference"]) < 0.05
    assert models.era_classifier(noisy, ["x", "z"], F.col("n") % 2 == 0, "g").first()["auroc"] == pytest.approx(0.5, abs=0.08)
    assert models.era_classifier(noisy.withColumn("x", F.col("x") + 5 * (F.col("n") % 2)), ["x", "z"], F.col("n") % 2 == 0, "g").first()["auroc"] > 0.95


def test_ablation_goes_on_where_it_stopped(spark, noisy, tmp_path):
    sides = noisy.where("g % 3 <> 0"), noisy.where("g % 3 = 0")
    at, fitted = str(tmp_path / "cells"), []

    def fit(train, test, xs, label):
        if len(fitted) == 2:
            raise RuntimeError("stopped")
        fitted.append(tuple(xs))
        return models.fit_baseline(train, test, xs, label)

    ask = lambda: models.ablation_cells({"w": sides}, {"a": ["x"], "b": ["z"]}, {"m": fit}, "y", at)
    with pytest.raises(RuntimeError):
        ask()
    assert fitted == [("x", "z"), ("z",)]
    fitted[:] = [()]
    got = {r["group"]: r["auroc"] for r in ask().collect()}
    assert fitted == [(), ("x",)]  # only what was missing
    plain = {r["group"]: r["auroc"] for r in models.ablation_grid(*sides, {"a": ["x"], "b": ["z"]}, "y").collect()}
    assert got == pytest.approx(plain)


def test_ablation_makes_its_sides_once(noisy, tmp_path):
    """a window's join isn't done again for every cell."""
    seen = []
    fit = lambda train, test, xs, label: seen.append(train._jdf.queryExecution().toString()) or test.withColumn("p", F.col("x"))
    sides = noisy.join(noisy.select("n").where("n % 2 = 0"), "n", "left_semi"), noisy
    got = models.ablation_cells({"w": sides}, {"a": ["x"], "b": ["z"]}, {"m": fit}, "y", str(tmp_path / "cells"))
    assert got.count() == 3 and len(seen) == 3 and not any("Join" in s for s in seen)


def test_clusters_and_components(spark):
    rng = np.random.default_rng(8)
    pts = np.vstack([rng.normal(c, 0.2, (40, 2)) for c in ((0, 0), (5, 0), (0, 5))])
    df = spark.createDataFrame([(k, k // 40, [float(v) for v in p]) for k, p in enumerate(pts)], "i int, true int, v array<double>").repartition(3)
    for found in (models.kmeans(df, "v", 3), models.bisecting(df, "v", 3), models.mixture(df, "v", 3)):
        assert features.adjusted_rand(found, "true", "cluster").first()["ari"] > (0.5 if "probability" in found.columns else 0.99)
    far = ((pts[:, None] - pts[None]) ** 2).sum(-1)
    lab = np.arange(120) // 40
    a = np.array([far[k, lab == lab[k]].sum() / 39 for k in range(120)])
    b = np.array([min(far[k, lab == c].mean() for c in set(lab) - {lab[k]}) for k in range(120)])
    assert models.silhouette(df, "v", "true").first()[0] == pytest.approx(float(((b - a) / np.maximum(a, b)).mean()))
    got = models.svd(df, "v", 2).orderBy("component").collect()
    _, s, vt = np.linalg.svd(pts, full_matrices=False)
    assert [r["singular"] for r in got] == pytest.approx(s) and abs(np.dot(got[0]["direction"], vt[0])) == pytest.approx(1)
    cov = np.linalg.eigvalsh(np.cov(pts.T))[::-1]
    assert [r["explained"] for r in models.pca(df, "v", 2).orderBy("component").collect()] == pytest.approx(cov / cov.sum())


def test_latent_classes(spark):
    rng = random.Random(1)
    rows = [tuple(rng.random() < (0.9 if k % 4 == 0 else 0.1) for _ in range(4)) for k in range(2000)]
    got = models.latent_classes(spark.createDataFrame(rows, "a boolean, b boolean, c boolean, d boolean"), ["a", "b", "c", "d"], 2).orderBy("class").collect()
    assert got[0]["share"] == pytest.approx(0.75, abs=0.05) and got[0]["p_a"] == pytest.approx(0.1, abs=0.05) and got[1]["p_a"] == pytest.approx(0.9, abs=0.07)
    p = np.array([[r[f"p_{c}"] for c in "abcd"] for r in got])
    w, x = np.array([r["share"] for r in got]), np.array(rows, float)
    like = np.log(sum(w[k] * np.prod(np.where(x > 0, p[k], 1 - p[k]), axis=1) for k in range(2))).sum()
    assert got[0]["log_likelihood"] == pytest.approx(like, abs=0.01)


def test_text_models(spark):
    rng = random.Random(6)
    words = {0: "sun moon star sky comet".split(), 1: "goal ball team kick match".split()}
    rows = [(n, n % 2, " ".join(rng.choice(words[n % 2]) for _ in range(12))) for n in range(120)]
    df = spark.createDataFrame(rows, "d int, y int, t string")
    p = text.classify_text(df.where("d < 80"), df.where("d >= 80"), "t", "y").collect()
    assert len(p) == 40 and all((r["p"] > 0.5) == (r["y"] == 1) for r in p)
    topics = text.topic_clusters(df.unionByName(spark.createDataFrame([(500, 0, None)], df.schema)), "d", "t", 2)
    assert topics.count() == 121 and features.adjusted_rand(topics.join(df, "d"), "y", "topic").first()["ari"] > 0.95


def test_topics_read_texts_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(t):
        read.add(1)
        return t

    df = spark.createDataFrame([(n, "sun moon star" if n % 2 else "goal ball team") for n in range(40)], "d int, t string").withColumn("t", F.udf(seen, "string")("t"))
    assert text.topic_clusters(df, "d", "t", 2).groupBy("topic").count().count() == 2
    assert read.value == 40


def test_plans_refuse_split_subjects(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "s int, f int")
    with pytest.raises(ValueError):
        assess.require_whole_subjects(df, "s", "f")
    assert assess.require_whole_subjects(df.where("f = 0"), "s", "f").count() == 2


def test_caps_raise(spark):
    from strandline.operators import disclosure

    df = spark.range(200).withColumn("k", F.col("id") % 20)
    assert explore.aggregate(df, ["k"], {"n": ("count", "id")}, cap=20).count() == 20
    with pytest.raises(ValueError):
        explore.aggregate(df, ["k"], {"n": ("count", "id")}, cap=19)
    assert disclosure.safe_aggregate(df, ["k"], {}, ("id",), k=2, most_rows=20).count() == 20
    with pytest.raises(ValueError):
        disclosure.safe_aggregate(df, ["k"], {}, ("id",), k=2, most_rows=19)


def test_hot_ties(spark):
    rows = [(n, 0.0 if n % 3 else float(n)) for n in range(3000)] + [(9000, None)]
    df = spark.createDataFrame(rows, "i int, v double")
    got = {r["i"]: r["avg_rank"] for r in inference.avg_ranks(df, "v").collect()}
    order = sorted((v for _, v in rows if v is not None))
    first, last = {}, {}
    for k, v in enumerate(order, 1):
        first.setdefault(v, k)
        last[v] = k
    assert got == {i: None if v is None else (first[v] + last[v]) / 2 for i, v in rows}
