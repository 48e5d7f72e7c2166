"""Baselines, trees, clusters, components, latent classes, importance, robustness and diagnostics over Spark's model library."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.timesem import md5_unit
from strandline.operators.features import auroc, grouped_auroc
from strandline.operators.inference import draws
from strandline.operators.sums import column_quantiles
from strandline.sources.tables import append_ledger, persisted


def _vectors(df: DataFrame, xs: list[str], label: str | None = None) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    d = df.select("*", *[F.col(x).cast("double").alias(f"_x{k}") for k, x in enumerate(xs)], *([F.col(label).cast("double").alias("_y")] if label else []))
    return VectorAssembler(inputCols=[f"_x{k}" for k in range(len(xs))], outputCol="_f").transform(d).drop(*[f"_x{k}" for k in range(len(xs))])


def baseline(train: DataFrame, xs: list[str], label: str, kind: str = "logistic", reg: float = 0.0, elastic: float = 0.0) -> Callable[[DataFrame], DataFrame]:
    """Fits once and gives a function that adds p to any rows: a logistic regression's probability, or a linear SVM's margin through a logistic."""
    from pyspark.ml.classification import LinearSVC, LogisticRegression
    from pyspark.ml.functions import vector_to_array

    names = {"featuresCol": "_f", "labelCol": "_y", "rawPredictionCol": "_r", "predictionCol": "_d"}
    m = LogisticRegression(regParam=reg, elasticNetParam=elastic, probabilityCol="_p", **names) if kind == "logistic" else LinearSVC(regParam=reg, **names)
    fitted = m.fit(_vectors(train, xs, label))
    p = vector_to_array("_p")[1] if kind == "logistic" else 1 / (1 + F.exp(-vector_to_array("_r")[1]))
    return lambda rows: fitted.transform(_vectors(rows, xs)).select(*rows.columns, p.alias("p"))


def fit_baseline(train: DataFrame, test: DataFrame, xs: list[str], label: str, kind: str = "logistic", reg: float = 0.0, elastic: float = 0.0) -> DataFrame:
    """``test`` with p by a baseline fitted on ``train``."""
    return baseline(train, xs, label, kind, reg, elastic)(test)


def fit_trees(train: DataFrame, xs: list[str], label: str, kind: str = "forest", seed: int = 1) -> tuple[object, DataFrame]:
    """(model, table of feature importances) of a decision tree, a random forest or boosted trees."""
    from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier

    m = {"tree": DecisionTreeClassifier, "forest": RandomForestClassifier, "boosted": GBTClassifier}[kind](featuresCol="_f", labelCol="_y", seed=seed)
    m = m.fit(_vectors(train, xs, label))
    return m, train.sparkSession.createDataFrame(list(zip(xs, map(float, m.featureImportances.toArray()), strict=True)), "feature string, importance double")


def out_of_fold(df: DataFrame, xs: list[str], label: str, fold: str, k: int) -> DataFrame:
    """``df`` with p predicted by a logistic regression fitted on the other folds, for stacking."""
    return reduce(DataFrame.unionByName, [fit_baseline(df.where(F.col(fold) != i), df.where(F.col(fold) == i), xs, label) for i in range(k)])


def multinomial(df: DataFrame, y: str, xs: list[str]) -> DataFrame:
    """level, term, coefficient of a multinomial logistic regression; levels in order of their names."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StringIndexer

    ix = StringIndexer(inputCol=y, outputCol="_l", stringOrderType="alphabetAsc").fit(df)
    m = LogisticRegression(featuresCol="_f", labelCol="_l", family="multinomial").fit(_vectors(ix.transform(df), xs))
    rows = [(v, t, float(c)) for v, line, b in zip(ix.labels, m.coefficientMatrix.toArray(), m.interceptVector, strict=True) for t, c in [("(intercept)", b), *zip(xs, line, strict=True)]]
    return df.sparkSession.createDataFrame(rows, "level string, term string, coefficient double")


def kmeans(df: DataFrame, vector: str, k: int, seed: int = 1) -> DataFrame:
    """``df`` (vector: an array of numbers) with cluster."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    d = df.withColumn("_f", array_to_vector(F.col(vector).cast("array<double>")))
    return KMeans(k=k, seed=seed, featuresCol="_f", predictionCol="cluster").fit(d).transform(d).drop("_f")


def _arrays(df: DataFrame, vector: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return df.withColumn("_f", array_to_vector(F.col(vector).cast("array<double>")))


def bisecting(df: DataFrame, vector: str, k: int, seed: int = 1) -> DataFrame:
    """``df`` with cluster, by splitting clusters in two."""
    from pyspark.ml.clustering import BisectingKMeans

    d = _arrays(df, vector)
    return BisectingKMeans(k=k, seed=seed, featuresCol="_f", predictionCol="cluster").fit(d).transform(d).drop("_f")


def mixture(df: DataFrame, vector: str, k: int, seed: int = 1) -> DataFrame:
    """``df`` with cluster and probability, by a mixture of normal distributions."""
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.functions import vector_to_array

    d = _arrays(df, vector)
    m = GaussianMixture(k=k, seed=seed, featuresCol="_f", predictionCol="cluster", probabilityCol="_p").fit(d)
    return m.transform(d).withColumn("probability", F.array_max(vector_to_array("_p"))).drop("_f", "_p")


def silhouette(df: DataFrame, vector: str, cluster: str) -> DataFrame:
    """One row: the mean silhouette by squared distance, which needs sums by cluster and no pairs; a cluster of one row gives 0."""
    d = df.select(F.col(cluster).alias("c"), F.col(vector).cast("array<double>").alias("v")).withColumn("q", F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    parts = d.select("c", "q", F.posexplode("v").alias("i", "x")).groupBy("c", "i").agg(F.sum("x").alias("x"))
    sums = parts.groupBy("c").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"]).alias("s"))
    known = d.groupBy("c").agg(F.count("*").alias("n"), F.sum("q").alias("sq")).join(sums, "c")  # a row a cluster
    other = F.broadcast(known.groupBy().agg(F.collect_list(F.struct("c", "n", "sq", "s")).alias("k")))  # one row of all clusters
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    total = lambda k: k["n"] * F.col("q") + k["sq"] - 2 * dot(F.col("v"), k["s"])
    m = d.crossJoin(other)
    own = F.filter("k", lambda k: k["c"] == F.col("c"))[0]
    a = F.try_divide(total(own), own["n"] - 1)
    b = F.array_min(F.transform(F.filter("k", lambda k: k["c"] != F.col("c")), lambda k: total(k) / k["n"]))
    return m.agg(F.avg(F.coalesce(F.when(own["n"] > 1, F.try_divide(b - a, F.greatest(a, b))), F.lit(0.0))).alias("silhouette"))


def svd(df: DataFrame, vector: str, k: int) -> DataFrame:
    """component, singular, direction: the k largest singular values of the rows and their right vectors. Tasks hand on sums of products of columns; the square of the width reaches the driver."""
    rows = df.select(F.col(vector).cast("array<double>").alias("v")).where("v is not null")

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "v"])

    got = rows.mapInArrow(products, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    n = int(np.sqrt(got.num_rows))
    gram = np.zeros((n, n))
    gram[got.column("i").to_numpy(), got.column("j").to_numpy()] = got.column("v").to_numpy()
    values, vectors = np.linalg.eigh(gram)
    out = [(c, float(np.sqrt(max(values[-1 - c], 0.0))), [float(x) for x in vectors[:, -1 - c]]) for c in range(min(k, n))]
    return df.sparkSession.createDataFrame(out, "component int, singular double, direction array<double>")


def pca(df: DataFrame, vector: str, k: int) -> DataFrame:
    """component, explained, loadings."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector

    m = PCA(k=k, inputCol="_f", outputCol="_o").fit(df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("_f")))
    rows = [(i, float(e), [float(x) for x in v]) for i, (e, v) in enumerate(zip(m.explainedVariance, m.pc.toArray().T, strict=True))]
    return df.sparkSession.createDataFrame(rows, "component int, explained double, loadings array<double>")


def robust_z(df: DataFrame, cols: list[str]) -> DataFrame:
    """Adds z_<column>: distance from the median in scaled median absolute deviations; a column without deviation gives 0."""
    mid = {c: q[0] for c, q in column_quantiles(df, cols, [0.5]).items()}
    off = {c: F.abs(F.col(c) - F.lit(mid.get(c))) for c in cols}
    mad = {c: q[0] for c, q in column_quantiles(df.select(*[x.alias(c) for c, x in off.items()]), cols, [0.5]).items()}
    return df.select("*", *[F.coalesce(F.try_divide(F.col(c) - F.lit(mid.get(c)), F.lit(1.4826 * mad.get(c, 0.0))), F.lit(0.0)).alias(f"z_{c}") for c in cols])


def mahalanobis(df: DataFrame, cols: list[str]) -> DataFrame:
    """Adds distance2 from the mean under the sample covariance, whose few sums come from one aggregate, and part_<column>, what each column adds to it: the parts sum up to the distance."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.covar_samp(a, b).alias(f"c_{a}_{b}") for a, b in pairs]).first()
    cov = np.zeros((len(cols), len(cols)))
    for a, b in pairs:
        i, j = cols.index(a), cols.index(b)
        cov[i, j] = cov[j, i] = one[f"c_{a}_{b}"]
    inv = np.linalg.inv(cov)
    x = [F.col(c) - float(one[f"m_{c}"]) for c in cols]
    part = [x[i] * sum((x[j] * float(inv[i, j]) for j in range(len(cols))), F.lit(0.0)) for i in range(len(cols))]
    return df.select("*", sum(part, F.lit(0.0)).alias("distance2"), *[p.alias(f"part_{c}") for c, p in zip(cols, part, strict=True)])


def flagged_by_era(scored: DataFrame, era: str, distance: str, cut: float, parts: list[str] = ()) -> DataFrame:
    """era, n, flagged (distance over ``cut``), share, and for each column of ``parts`` the flagged rows to whose distance it adds most."""
    over = F.coalesce(F.col(distance) > cut, F.lit(False))
    top = F.greatest(*parts) if len(parts) > 1 else F.col(parts[0]) if parts else None
    led = [F.count_if(over & (F.col(p) == top)).alias(f"led_by_{p.removeprefix('part_')}") for p in parts]
    return scored.groupBy(era).agg(F.count("*").alias("n"), F.count_if(over).alias("flagged"), *led).withColumn("share", F.col("flagged") / F.col("n"))


def latent_classes(df: DataFrame, flags: list[str], k: int, rounds: int = 20_000, tolerance: float = 1e-9) -> DataFrame:
    """class, share, p_<flag>, log_likelihood, bic of a mixture of independent indicators by EM.

    Rows count only through their pattern of flags (2 to the number of flags at most), so EM runs on pattern counts on the driver. Not settling in ``rounds`` raises.
    """
    if len(flags) > 16:
        raise ValueError("at most 16 indicators")
    pat = df.groupBy(*[F.col(f).cast("int").alias(f) for f in flags]).agg(F.count("*").alias("n")).orderBy(*flags).collect()
    x = np.array([[r[f] for f in flags] for r in pat], float)
    n = np.array([r["n"] for r in pat], float)
    rng = np.random.default_rng(1)
    w, p = np.full(k, 1 / k), rng.uniform(0.25, 0.75, (k, len(flags)))
    last = -np.inf
    for _ in range(rounds):
        like = np.log(w) + x @ np.log(p).T + (1 - x) @ np.log(1 - p).T
        top = like.max(axis=1, keepdims=True)
        total = top[:, 0] + np.log(np.exp(like - top).sum(axis=1))
        ll = float(n @ total)
        if ll < last - 1e-6 * abs(last):
            raise RuntimeError("the likelihood fell")
        done = ll - last < tolerance * abs(ll)
        last = ll
        r = np.exp(like - total[:, None]) * n[:, None]
        w = r.sum(axis=0) / n.sum()
        p = np.clip((r.T @ x) / r.sum(axis=0)[:, None], 1e-6, 1 - 1e-6)
        if done:
            bic = (k * (len(flags) + 1) - 1) * np.log(n.sum()) - 2 * ll
            order = np.argsort(-w)
            rows = [(i, float(w[c]), *map(float, p[c]), ll, float(bic)) for i, c in enumerate(order)]
            return df.sparkSession.createDataFrame(rows, "class int, share double, " + ", ".join(f"p_{f} double" for f in flags) + ", log_likelihood double, bic double")
    raise RuntimeError("EM did not converge")


def stability_selection(df: DataFrame, subject: str, xs: list[str], label: str, replicates: int = 10, reg: float = 0.05, seed: int = 1) -> DataFrame:
    """feature, frequency with which an L1 logistic regression keeps it over bootstraps of subjects, drawn as weights."""
    from pyspark.ml.classification import LogisticRegression

    d = persisted(df, "stability")
    times = persisted(draws(d.select(subject).distinct(), subject, replicates, seed), "draws")
    kept = np.zeros(len(xs))
    for r in range(replicates):
        rows = d.join(times.where(F.col("rep") == r), subject).withColumn("_w", F.col("times").cast("double"))
        m = LogisticRegression(featuresCol="_f", labelCol="_y", weightCol="_w", regParam=reg, elasticNetParam=1.0).fit(_vectors(rows, xs, label))
        kept += np.abs(m.coefficients.toArray()) > 1e-8
    return df.sparkSession.createDataFrame([(x, float(c / replicates)) for x, c in zip(xs, kept, strict=True)], "feature string, frequency double")


def shuffled(df: DataFrame, unit: str, col: str, seed: str) -> DataFrame:
    """``df`` (a row a unit) with ``col`` dealt anew: the values in order of one hash go to the units in order of another, rank by rank within hash slices."""
    w = lambda s: Window.partitionBy("_c").orderBy(md5_unit(F.col(unit), s), unit)
    d = df.withColumn("_c", F.floor(md5_unit(F.col(unit), seed) * 64))
    a = d.withColumn("_r", F.row_number().over(w(seed + "a"))).drop(col)
    b = d.select("_c", F.row_number().over(w(seed + "b")).alias("_r"), col)
    return a.join(b, ["_c", "_r"]).select(*df.columns)


def permutation_importance(train: DataFrame, test: DataFrame, unit: str, xs: list[str], label: str, seed: str = "p") -> DataFrame:
    """feature, drop of the test AUROC of a logistic regression when the feature is shuffled between units."""
    base, predict = persisted(test, "importance"), baseline(train, xs, label)
    scored = [predict(t).select(F.lit(x).alias("feature"), "p", F.col(label).cast("boolean").alias("_y")) for x, t in [("", base), *((x, shuffled(base, unit, x, f"{seed}:{x}")) for x in xs)]]
    each = grouped_auroc(reduce(DataFrame.unionByName, scored), ["feature"], "p", F.col("_y"))
    whole = each.where("feature = ''").select(F.col("auroc").alias("_whole"))
    return each.where("feature <> ''").crossJoin(F.broadcast(whole)).select("feature", (F.col("_whole") - F.col("auroc")).alias("drop"))  # one row


def dependence_table(df: DataFrame, x: str, p: str, width: float) -> DataFrame:
    """bin, n, mean prediction."""
    return df.groupBy((F.floor(F.col(x) / width) * width).cast("double").alias("bin")).agg(F.count("*").alias("n"), F.avg(p).alias("mean"))


def binned_residuals(df: DataFrame, y: Column, p: str, bins: int = 10) -> DataFrame:
    """bin, n, observed, predicted, residual over equal bins of the prediction."""
    b = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).alias("bin")
    s = df.groupBy(b).agg(F.count("*").alias("n"), F.avg(y.cast("double")).alias("observed"), F.avg(p).alias("predicted"))
    return s.withColumn("residual", F.col("observed") - F.col("predicted"))


def average_marginal_effect(df: DataFrame, predict, treated: str) -> DataFrame:
    """Mean of predict(row with treated = 1) - predict(row with treated = 0) over all rows; ``predict`` maps a DataFrame to one with p."""
    one, nil = predict(df.withColumn(treated, F.lit(1))), predict(df.withColumn(treated, F.lit(0)))
    return one.agg(F.avg("p").alias("p1")).crossJoin(nil.agg(F.avg("p").alias("p0"))).withColumn("ame", F.col("p1") - F.col("p0"))  # one row each


def audit_robustness(train: DataFrame, test: DataFrame, unit: str, xs: list[str], label: str, share: float = 0.2, seed: str = "m") -> DataFrame:
    """feature, auroc of the model when a hashed share of the feature's test values is replaced by 0, and when all are scaled tenfold."""
    base, predict = persisted(test, "robustness"), baseline(train, xs, label)
    scored = []
    for x in xs:
        lost = base.withColumn(x, F.when(md5_unit(F.col(unit), f"{seed}:{x}") < share, 0.0).otherwise(F.col(x)))
        for kind, rows in (("missing", lost), ("scaled", base.withColumn(x, F.col(x) * 10))):
            scored.append(predict(rows).select(F.lit(x).alias("feature"), F.lit(kind).alias("kind"), "p", F.col(label).cast("boolean").alias("_y")))
    each = grouped_auroc(reduce(DataFrame.unionByName, scored), ["feature", "kind"], "p", F.col("_y"))
    of = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("auroc")))
    return each.groupBy("feature").agg(of("missing").alias("auroc_missing"), of("scaled").alias("auroc_scaled"))


def ablation_grid(train: DataFrame, test: DataFrame, groups: dict[str, list[str]], label: str) -> DataFrame:
    """group, auroc without that group of features; group '(none)' has all."""
    every = [x for xs in groups.values() for x in xs]
    cells = [("(none)", every), *[(g, [x for x in every if x not in xs]) for g, xs in groups.items()]]
    rows = [(g, float(auroc(fit_baseline(train, test, xs, label), "p", F.col(label).cast("boolean")).first()["auroc"])) for g, xs in cells if xs]
    return test.sparkSession.createDataFrame(rows, "group string, auroc double")


def ablation_cells(windows: dict[str, tuple[DataFrame, DataFrame]], groups: dict[str, list[str]], fits: dict[str, Callable[..., DataFrame]], label: str, ledger: str) -> DataFrame:
    """window, group, model, n, auroc of every window (its training and test rows) without every group of features ('(none)' has all) by every model.

    ``fits`` give the test rows with p from (train, test, features, label). A cell is added to the ``ledger`` folder as soon as it is known, and cells found there aren't fitted again, so a broken run goes on where it stopped.
    """
    spark = next(iter(windows.values()))[0].sparkSession
    kind = "window string, group string, model string, n long, auroc double"
    append_ledger(spark.createDataFrame([], kind), ledger)
    known = spark.read.schema(kind).json(ledger)
    done = {(r["window"], r["group"], r["model"]) for r in known.collect()}  # a row a cell
    every = [x for xs in groups.values() for x in xs]
    cells = {"(none)": every, **{g: [x for x in every if x not in left_out] for g, left_out in groups.items()}}
    for window, sides in windows.items():
        known_sides = None
        for group, xs in cells.items():
            for model, fit in fits.items():
                if xs and (window, group, model) not in done:
                    train, test = known_sides = known_sides or tuple(persisted(d, "window") for d in sides)  # each cell reads them several times
                    a = auroc(fit(train, test, xs, label), "p", F.col(label).cast("boolean"))
                    append_ledger(a.select(F.lit(window).alias("window"), F.lit(group).alias("group"), F.lit(model).alias("model"), "n", "auroc"), ledger)
    return spark.read.schema(kind).json(ledger)


def embedding_search(base: DataFrame, queries: DataFrame, unit: str, vector: str, k: int) -> DataFrame:
    """query, rank, unit, similarity: of every query the k other units with the highest cosine, ties to smaller units."""
    from strandline.operators.features import nearest

    return nearest(base, queries, unit, vector, F.lit(0), k).select("query", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("_s"), "_u")).alias("rank"), F.col("_u").alias(unit), F.col("_s").alias("similarity"))


def era_classifier(df: DataFrame, xs: list[str], later: Column, subject: str, seed: str = "era") -> DataFrame:
    """n, auroc of telling later from earlier rows by their features, on a hashed half of the subjects that didn't train it; near 0.5 where nothing has drifted."""
    d = persisted(df.withColumn("_later", later.cast("int")), "eras")
    half = md5_unit(F.col(subject), seed) < 0.5
    return auroc(fit_baseline(d.where(half), d.where(~half), xs, "_later"), "p", F.col("_later").cast("boolean")).select("n", "auroc")


def era_refits(df: DataFrame, xs: list[str], label: str, era: str, subject: str, seed: str = "refit") -> DataFrame:
    """era, n, positives, auroc_own, auroc_others, auroc_mixed on each era's hashed test half of the subjects: of a model fitted on the era's own training half, on the training halves of all other eras, and on those of all eras. A fall from own to others says that what was learned doesn't carry over. 2 E + 1 fits over a table written once; an era whose training half, or whose others, hold one class alone gives a null there. Rows without era or label are left out. Eras are few (years, protocols): more than 50 raise."""
    d = persisted(df.where(F.col(era).isNotNull() & F.col(label).isNotNull()).withColumn("_train", md5_unit(F.col(subject), seed) < 0.5), "refits")
    n = {(r["e"], r["t"]): (r["n"], r["k"]) for r in d.groupBy(F.col(era).alias("e"), F.col("_train").alias("t")).agg(F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("k")).collect()}
    eras = sorted({e for e, _ in n})
    if len(eras) > 50:
        raise ValueError(f"{len(eras)} eras")
    two = lambda names: 0 < (k := sum(n.get((e, True), (0, 0))[1] for e in names)) < sum(n.get((e, True), (0, 0))[0] for e in names)
    mixed = baseline(d.where("_train"), xs, label) if two(eras) else None
    out = []
    for e in eras:
        test = d.where(~F.col("_train") & (F.col(era) == e))
        others = [x for x in eras if x != e]
        fits = {"own": baseline(d.where(F.col("_train") & (F.col(era) == e)), xs, label) if two([e]) else None, "others": baseline(d.where(F.col("_train") & (F.col(era) != e)), xs, label) if two(others) else None, "mixed": mixed}
        got = {k: auroc(f(test), "p", F.col(label).cast("boolean")).first()["auroc"] if f and (e, False) in n else None for k, f in fits.items()}
        size, positives = n.get((e, False), (0, 0))
        out.append((e, size, positives, got["own"], got["others"], got["mixed"]))
    kind = df.schema[era].dataType.simpleString()
    return d.sparkSession.createDataFrame(out, f"era {kind}, n long, positives long, auroc_own double, auroc_others double, auroc_mixed double")


def neighbour_agreement(base: DataFrame, queries: DataFrame, unit: str, vector: str, label: str, k: int) -> DataFrame:
    """share, expected, lift: how often a query's k nearest by cosine carry its label, against the label's overall share. All rows of ``queries`` count."""
    from strandline.operators.features import nearest

    shares = base.groupBy(F.col(label).alias("_l")).agg(F.count("*").alias("_n")).withColumn("_e", F.col("_n") / F.sum("_n").over(Window.partitionBy()))
    asked = queries.groupBy(F.col(unit).cast("long").alias("query")).agg(F.min(F.struct(vector, label))[label].alias("_l"))
    r = nearest(base, queries, unit, vector, F.col(label), k).join(asked, "query").join(F.broadcast(shares.select("_l", "_e")), "_l")
    return r.agg(F.avg((F.col("_v") == F.col("_l")).cast("double")).alias("share"), F.avg("_e").alias("expected")).withColumn("lift", F.col("share") / F.col("expected"))
