"""One look, sparse singular values, maximum likelihood of dispersion, specification grids: against whole computations."""

import math
import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import causal, holdout, models, regress, sparse


def test_holdout_is_seen_once(spark, tmp_path):
    rng = np.random.default_rng(1)
    path = str(tmp_path / "d")
    rows = [(f"20{10 + k % 6}-01-01", float(x), int(x + rng.normal() > 0)) for k, x in enumerate(rng.normal(size=600))]
    spark.createDataFrame(rows, "at string, x double, y int").withColumn("at", F.to_date("at")).write.parquet(path)
    df = spark.read.parquet(path)
    p = holdout.Protocol("p", "at", ("2010-01-01", "2013-01-01"), ("2013-01-01", "2014-01-01"), ("x",), "y")
    fit = lambda dev: models.baseline(dev, ["x"], "y")
    out = {r["part"]: r for r in holdout.one_look(df, p, fit, str(tmp_path / "l"), "first").collect()}
    assert out["dev"]["n"] == 300 and out["holdout"]["n"] == 100 and out["holdout"]["auroc"] > 0.7
    with pytest.raises(holdout.HoldoutUsed) as again:
        holdout.one_look(df, p, fit, str(tmp_path / "l"), "second")
    assert again.value.run == "first"
    other = holdout.Protocol("q", "at", p.dev, p.holdout, ("x",), "y")
    assert holdout.one_look(df, other, fit, str(tmp_path / "l")).count() == 2
    assert spark.read.json(str(tmp_path / "l/results")).select("run").distinct().count() == 2
    plan = holdout.during(df, "at", p.holdout)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at,2013-01-01)" in plan and "LessThan(at,2014-01-01)" in plan
    got = []
    runs = [threading.Thread(target=lambda k=k: got.append(holdout.claim(spark, str(tmp_path / "c"), "one", {"run": k}))) for k in range(16)]
    [t.start() for t in runs], [t.join() for t in runs]
    assert sum(x is None for x in got) == 1
    far = f"file:{tmp_path}/far"
    assert holdout.claim(spark, far, "one", {"run": 1}) is None and '"run": 1' in holdout.claim(spark, far, "one", {"run": 2})


def test_sparse_singular_values(spark):
    rng = np.random.default_rng(2)
    a = rng.random((120, 60)) * (rng.random((120, 60)) < 0.15)
    a[:, :3] += np.outer(rng.random(120) * 4, [1, 0.5, 0.2])
    rows = [(int(i), f"c{j:02}", float(a[i, j] / 2)) for i, j in zip(*np.nonzero(a)) for _ in range(2)] + [(1, None, 2.0), (None, "c01", 1.0), (2, "c01", None)]
    df = spark.createDataFrame(rows, "r long, c string, v double").repartition(5)
    one, two = sparse.sparse_svd(df, "r", "c", "v", 5)
    want = np.linalg.svd(a)
    assert [r["sigma"] for r in one.orderBy("component").collect()] == pytest.approx(want[1][:5], rel=1e-6)
    first = {r["code"]: r["loading"] for r in two.where("component = 0").collect()}
    assert [first[f"c{j:02}"] for j in range(60)] == pytest.approx(np.abs(want[2][0]) if (want[2][0] <= 1e-9).all() or (want[2][0] >= -1e-9).all() else want[2][0] * np.sign(want[2][0][np.abs(want[2][0]).argmax()]), abs=1e-6)
    assert sparse.sparse_svd(df.where("false"), "r", "c", "v", 3)[0].count() == 0
    wide = spark.range(60_000).selectExpr("id % 3000 as r", "id * 7 % 20000 as c", "1.0D + id % 5 as v")
    values = [r["sigma"] for r in sparse.sparse_svd(wide, "r", "c", "v", 3, steps=2)[0].orderBy("component").collect()]
    assert len(values) == 3 and values == sorted(values, reverse=True)


def test_sparse_singular_values_in_tiles_and_parts(spark, monkeypatch):
    for name, n in (("BASIS", 100), ("TILE", 16), ("PART", 40), ("DEAL", 2)):
        monkeypatch.setattr(sparse, name, n, raising=False)
    rng = np.random.default_rng(5)
    a = rng.random((90, 70)) * (rng.random((90, 70)) < 0.1)
    a[[7, 50], :] = rng.random((2, 70)) + 0.5  # over 40 codes: no part holds them
    a[:, 5] = 0.3
    df = spark.createDataFrame([(int(i), f"c{j:02}", float(a[i, j])) for i, j in zip(*np.nonzero(a))], "r long, c string, v double").repartition(3)
    one, two = sparse.sparse_svd(df, "r", "c", "v", 5)
    _, s, vt = np.linalg.svd(a)
    got = one.orderBy("component").collect()
    assert [r["sigma"] for r in got] == pytest.approx(s[:5], rel=1e-6) and [r["share"] for r in got] == pytest.approx(s[:5] ** 2 / (s**2).sum(), rel=1e-6)
    v = np.zeros((70, 5))
    for r in two.collect():
        v[int(r["code"][1:]), r["component"]] = r["loading"]
    want = vt[:5].T * np.sign(vt[:5].T[np.abs(vt[:5]).argmax(axis=1), np.arange(5)])
    assert v == pytest.approx(want, abs=1e-5)
    few = spark.createDataFrame([(1, "a", 3.0), (2, "b", 4.0)], "r long, c string, v double")
    assert [r["sigma"] for r in sparse.sparse_svd(few, "r", "c", "v", 5)[0].orderBy("component").collect()] == pytest.approx([4, 3])


def test_sparse_blocks_are_written_once_and_shuffles_go(spark, monkeypatch):
    from pathlib import Path

    kept, real, name = [], sparse.checkpointed, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    monkeypatch.setattr(sparse, "checkpointed", lambda df: kept.append(df.columns) or real(df))
    folders = [Path(d.toString()) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffled = lambda: {x.name for d in folders for x in d.rglob("shuffle_*.data")}
    rng = np.random.default_rng(8)
    a = rng.random((80, 50)) * (rng.random((80, 50)) < 0.2)
    rows = [(-0.0 if not i and n % 2 else float(i), f"c{j:02}", float(a[i, j])) for n, (i, j) in enumerate(zip(*np.nonzero(a)))]
    df = spark.createDataFrame(rows, "r double, c string, v double").repartition(3)
    before, was = shuffled(), spark.conf.get(name)
    one = sorted(sparse.sparse_svd(df, "r", "c", "v", 3, steps=3, extra=2)[0].collect())
    for _ in range(50):
        if not (left := shuffled() - before):
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(name) == was
    assert kept.count(["tile", "m"]) == 5  # the start and four products, not the vectors made of them
    s = np.linalg.svd(a)[1]
    assert one[0]["sigma"] == pytest.approx(s[0], rel=1e-4)
    for names in ({"MOVE": 1, "PART": 60}, {"HOLD": 100}, {"ONCE": 7}):  # vectors in turns, a part's rows in turns
        with monkeypatch.context() as m:
            for x, n in names.items():
                m.setattr(sparse, x, n)
            again = sorted(sparse.sparse_svd(df, "r", "c", "v", 3, steps=3, extra=2)[0].collect())
        assert [r["sigma"] for r in again] == pytest.approx([r["sigma"] for r in one], rel=1e-9)


def test_dispersion_by_maximum_likelihood(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=1500)
    mu = np.exp(0.5 + 0.4 * x)
    y = rng.poisson(mu * rng.gamma(1 / 0.7, 0.7, 1500))
    got = {r["term"]: r for r in regress.negative_binomial_ml(spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, x)], "y long, x double").repartition(3), "y", ["x"]).collect()}

    def ll(b0, b1, alpha):
        r = 1 / alpha
        m = np.exp(b0 + b1 * x)
        return sum(math.lgamma(k + r) - math.lgamma(r) - math.lgamma(k + 1) for k in y) + (r * np.log(r / (r + m)) + y * np.log(m / (r + m))).sum()

    best = [got[t]["coefficient"] for t in ("(intercept)", "x", "(alpha)")]
    top = ll(*best)
    for k in range(3):
        for step in (-1e-3, 1e-3):
            moved = list(best)
            moved[k] += step
            assert ll(*moved) < top
    h = 1e-3
    curve = (ll(best[0], best[1], best[2] + h) - 2 * top + ll(best[0], best[1], best[2] - h)) / h**2
    assert got["(alpha)"]["se"] == pytest.approx((-1 / curve) ** 0.5, rel=0.05) and abs(best[2] - 0.7) < 0.15
    a = np.array([0.01, 0.5, 1.0, 3.3, 40.0])
    assert regress.gammas(a)[0] == pytest.approx([math.lgamma(v) for v in a], abs=1e-10)
    assert regress.gammas(a)[1] == pytest.approx([(math.lgamma(v + 1e-5 * v) - math.lgamma(v - 1e-5 * v)) / (2e-5 * v) for v in a], rel=1e-5)
    with pytest.raises((ValueError, RuntimeError, np.linalg.LinAlgError)):
        regress.negative_binomial_ml(spark.createDataFrame([(2, 0.1), (2, 0.2), (2, 0.3), (2, 0.5)], "y long, x double"), "y", ["x"])


def test_every_cell_is_its_own_run(spark, tmp_path):
    rng = np.random.default_rng(4)
    x, z = rng.normal(size=400), rng.normal(size=400)
    t = rng.random(400) < 1 / (1 + np.exp(-x))
    df = spark.createDataFrame([(float(a), float(b), bool(c), float(a + b + c)) for a, b, c in zip(x, z, t)], "x double, z double, t boolean, y double")
    fit = causal.propensity(df.withColumn("t", F.col("t").cast("int")), "t", ["x", "z"]).withColumn("t", F.col("t") == 1)
    specs = [{"estimand": "ATE"}, {"estimand": "ATT", "trim": (0.2, 0.8)}, {"estimand": "ATO", "truncate": (0.1, 0.9)}]
    got = {r["spec"]: r for r in regress.specification_grid(fit, "y", F.col("t"), "ps", specs).collect()}
    for k, s in enumerate(specs):
        alone = fit.where(F.col("ps").between(*s["trim"])) if "trim" in s else fit
        w = causal.weight(F.col("t"), F.col("ps"), s["estimand"], *s.get("truncate", (0.0, 1.0)))
        d = alone.select("y", "t", w.alias("w")).toPandas()
        m = [np.average(d.y[d.t == v], weights=d.w[d.t == v]) for v in (True, False)]
        assert (got[k]["n"], got[k]["difference"]) == (len(d), pytest.approx(m[0] - m[1]))
    ledger = str(tmp_path / "ledger")
    one = sorted(map(tuple, regress.leave_one_out(df.withColumn("t", F.col("t").cast("int")), "y", "t", ["x", "z"], "ATE", ledger).collect()))
    assert [r[0] for r in one] == ["(none)", "x", "z"]
    assert sorted(map(tuple, regress.leave_one_out(df.where("false"), "y", "t", ["x", "z"], "ATE", ledger).collect())) == one
    late = df.select(F.lit(1).alias("ends"), F.lit(2).alias("index"))
    assert regress.refuse_late_outcomes(late, "ends", "index").count() == 400
    with pytest.raises(ValueError):
        regress.refuse_late_outcomes(late, "index", "ends")
