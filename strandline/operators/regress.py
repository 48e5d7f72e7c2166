"""Likelihood models and diagnostics from sums that tasks hand on: ordinal, negative-binomial, counting-process Cox; collinearity, dispersion, influence, standardization, sensitivity."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.causal import ols, propensity, weight
from strandline.operators.phenotypes import Z95
from strandline.operators.sums import lookup, prefix_sums
from strandline.sources.tables import append_ledger, persisted

Sums = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[float, np.ndarray, np.ndarray]]


def summed(df: DataFrame, y: str, xs: list[str], of: Sums, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log likelihood, score and information over all rows: each task hands on one row of p + p * p + 1 numbers."""
    rows = df.select(F.col(y).cast("double").alias("y"), F.array(*[F.col(x).cast("double") for x in xs]).alias("x"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | None = None
        for b in batches:
            if b.num_rows:
                x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                ll, g, h = of(b.column(0).to_numpy(zero_copy_only=False), x, beta)
                part = np.concatenate([[ll], g, h.ravel()])
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["k", "v"])

    got = rows.mapInArrow(add, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    v = np.array([r["v"] for r in sorted(got, key=lambda r: r["k"])])
    p = len(beta)
    return v[0], v[1 : p + 1], v[p + 1 :].reshape(p, p)


def newton(df: DataFrame, y: str, xs: list[str], of: Sums, beta: np.ndarray, rounds: int = 60, tolerance: float = 1e-8) -> tuple[np.ndarray, np.ndarray, float]:
    """(estimate, its covariance, log likelihood); steps are halved while the likelihood falls. Not settling raises."""
    ll, g, h = summed(df, y, xs, of, beta)
    for _ in range(rounds):
        step = np.linalg.solve(h if np.diag(h).min() > 0 else h + np.diag(np.maximum(0, np.abs(g) - np.diag(h))), g)  # far from the maximum an observed information may be negative
        for _ in range(20):
            new = summed(df, y, xs, of, beta + step)
            if np.isfinite(new[0]) and new[0] >= ll - 1e-9 * abs(ll):
                break
            step = step / 2
        beta, gain = beta + step, abs(new[0] - ll)
        ll, g, h = new
        if np.abs(step).max() < tolerance or gain < 1e-12 * abs(ll):
            return beta, np.linalg.inv(h), ll
    raise RuntimeError("the model did not converge")


def ordinal_logit(df: DataFrame, y: str, xs: list[str], levels: int) -> DataFrame:
    """term, coefficient, se of proportional odds: P(y <= k) = logistic(cut_k - x b) for y from 0 to levels - 1. The information is that of the outer products of scores."""
    cuts = levels - 1

    def of(y: np.ndarray, x: np.ndarray, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        edges = np.r_[-np.inf, beta[:cuts], np.inf]
        if (np.diff(beta[:cuts]) <= 0).any():
            return -np.inf, np.zeros(len(beta)), np.eye(len(beta))
        k, eta = y.astype(int), x @ beta[cuts:]
        with np.errstate(over="ignore"):
            hi, lo = (1 / (1 + np.exp(-(e - eta))) for e in (edges[k + 1], edges[k]))
        p = np.maximum(hi - lo, 1e-300)
        dh, dl = hi * (1 - hi) / p, lo * (1 - lo) / p
        s = np.zeros((len(y), len(beta)))
        at = np.arange(len(y))
        s[at[k < cuts], k[k < cuts]] += dh[k < cuts]
        s[at[k > 0], k[k > 0] - 1] -= dl[k > 0]
        s[:, cuts:] = -x * (dh - dl)[:, None]
        return float(np.log(p).sum()), s.sum(axis=0), s.T @ s

    n = [r["count"] for r in df.groupBy(y).count().orderBy(y).collect()]  # a row a level
    if len(n) != levels:
        raise ValueError(f"{y} has {len(n)} levels, not {levels}")
    share = np.cumsum(n)[:-1] / sum(n)
    beta, cov, _ = newton(df, y, xs, of, np.r_[np.log(share / (1 - share)), np.zeros(len(xs))])
    names = [*(f"cut_{k}" for k in range(cuts)), *xs]
    return df.sparkSession.createDataFrame([(t, float(b), float(s)) for t, b, s in zip(names, beta, np.sqrt(np.diag(cov)), strict=True)], "term string, coefficient double, se double")


def negative_binomial(df: DataFrame, y: str, xs: list[str], rounds: int = 50) -> DataFrame:
    """term, coefficient, se of a log-linear model of counts with variance mu + alpha mu^2; term (alpha) by moments, in turns with the coefficients until it settles."""

    def of_alpha(alpha: float) -> Sums:
        def of(y: np.ndarray, z: np.ndarray, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
            x = np.column_stack([np.ones(len(y)), z])
            mu = np.exp(np.clip(x @ beta, -30, 30))
            # quasi likelihood: the mean's part of the log likelihood
            ll = y * np.log(mu / (1 + alpha * mu)) - (np.log1p(alpha * mu) / alpha if alpha > 1e-9 else mu)
            return float(ll.sum()), x.T @ ((y - mu) / (1 + alpha * mu)), (x * (mu / (1 + alpha * mu))[:, None]).T @ x

        return of

    base = persisted(df.select(y, *xs), "counts")
    mean = base.agg(F.avg(y)).first()[0]
    beta, alpha = np.r_[np.log(max(mean, 1e-9)), np.zeros(len(xs))], 0.0
    for _ in range(rounds):
        beta, cov, _ = newton(base, y, xs, of_alpha(alpha), beta)
        mu = F.exp(sum((F.col(x) * float(b) for x, b in zip(xs, beta[1:], strict=True)), F.lit(float(beta[0]))))
        extra, square = base.agg(F.sum((F.col(y) - mu) ** 2 - mu), F.sum(mu * mu)).first()
        after = max(extra / square, 0.0)
        if abs(after - alpha) < 1e-6 * (1 + alpha):
            rows = [(t, float(b), float(s)) for t, b, s in zip(["(intercept)", *xs], beta, np.sqrt(np.diag(cov)), strict=True)]
            return df.sparkSession.createDataFrame([*rows, ("(alpha)", float(after), None)], "term string, coefficient double, se double")
        alpha = after
    raise RuntimeError("the dispersion did not settle")


def gammas(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log gamma, digamma and trigamma of positive numbers: the series at x + 8, brought down by the recurrence."""
    low = [x + i for i in range(8)]
    z = x + 8
    i, s = 1 / z, 1 / (z * z)
    log = (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + i * (1 / 12 - s * (1 / 360 - s * (1 / 1260 - s / 1680)))
    first = np.log(z) - i / 2 - s * (1 / 12 - s * (1 / 120 - s * (1 / 252 - s / 240)))
    second = i + s / 2 + i * s * (1 / 6 - s * (1 / 30 - s * (1 / 42 - s / 30)))
    return log - sum(np.log(t) for t in low), first - sum(1 / t for t in low), second + sum(1 / (t * t) for t in low)


def negative_binomial_ml(df: DataFrame, y: str, xs: list[str]) -> DataFrame:
    """term, coefficient, se of a log-linear model of counts with variance mu + alpha mu^2, coefficients and (alpha) by maximum likelihood together. Counts without more spread than Poisson, before or behind the covariates, have no maximum in alpha > 0 and raise."""

    def of(y: np.ndarray, z: np.ndarray, theta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        x = np.column_stack([np.ones(len(y)), z])
        mu, r = np.exp(np.clip(x @ theta[:-1], -30, 30)), np.exp(-np.clip(theta[-1], -30, 30))
        (l1, d1, t1), (l0, d0, t0), (lf, _, _) = gammas(y + r), gammas(np.array([r])), gammas(y + 1)
        ll = l1 - l0 - lf + r * np.log(r / (r + mu)) + y * np.log(mu / (r + mu))
        g = d1 - d0 + np.log(r / (r + mu)) + 1 - (r + y) / (r + mu)
        gg = t1 - t0 + 1 / r - 2 / (r + mu) + (r + y) / (r + mu) ** 2
        w = mu * r / (r + mu)
        score = np.r_[x.T @ ((y - mu) * r / (r + mu)), -r * g.sum()]
        info = np.zeros((len(theta), len(theta)))
        info[:-1, :-1] = (x * w[:, None]).T @ x
        info[-1, -1] = -(r * r * gg + r * g).sum()
        return float(ll.sum()), score, info

    base = persisted(df.select(y, *xs).dropna(), "counts")

    def poisson(y: np.ndarray, z: np.ndarray, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        x = np.column_stack([np.ones(len(y)), z])
        mu = np.exp(np.clip(x @ beta, -30, 30))
        return float((y * (x @ beta) - mu).sum()), x.T @ (y - mu), (x * mu[:, None]).T @ x

    mean = base.agg(F.avg(y)).first()[0]
    beta = newton(base, y, xs, poisson, np.r_[np.log(max(mean or 0.0, 1e-9)), np.zeros(len(xs))])[0]
    mu = F.exp(sum((F.col(x) * float(b) for x, b in zip(xs, beta[1:], strict=True)), F.lit(float(beta[0]))))
    extra, square = base.agg(F.sum((F.col(y) - mu) ** 2 - F.col(y)), F.sum(mu * mu)).first()
    if extra <= 0:  # the score of alpha at 0
        raise ValueError("the counts have no more spread than Poisson")
    start = np.r_[beta, np.log(max(extra / square, 1e-6))]
    theta, cov, _ = newton(base, y, xs, of, start)
    alpha = float(np.exp(theta[-1]))
    if alpha < 1e-6:
        raise ValueError("the counts have no more spread than Poisson")
    se = np.sqrt(np.diag(cov))
    rows = [(t, float(b), float(e)) for t, b, e in zip(["(intercept)", *xs], theta, se, strict=False)]
    return df.sparkSession.createDataFrame([*rows, ("(alpha)", alpha, alpha * float(se[-1]))], "term string, coefficient double, se double")


def working(family: str, eta: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log likelihood, residual and weight of each row at its linear predictor."""
    if family == "gaussian":
        return -0.5 * (y - eta) ** 2, y - eta, np.ones_like(eta)
    if family == "binomial":
        mu = 1 / (1 + np.exp(-np.clip(eta, -35, 35)))
        return y * eta - np.logaddexp(0, eta), y - mu, np.maximum(mu * (1 - mu), 1e-9)
    if family == "poisson":
        mu = np.exp(np.clip(eta, -35, 35))
        return y * eta - mu, y - mu, np.maximum(mu, 1e-9)
    raise ValueError(f"no family {family}")


def descended(gram: np.ndarray, right: np.ndarray, beta: np.ndarray, lasso: float, ridge: float, rounds: int = 10_000, tolerance: float = 1e-11) -> np.ndarray:
    """Coordinate descent on b'Gb / 2 - r'b + lasso |b| + ridge b'b / 2, the intercept (first) free."""
    b = beta.copy()
    for _ in range(rounds):
        most = 0.0
        for j in range(len(b)):
            z = right[j] - gram[j] @ b + gram[j, j] * b[j]
            new = z / gram[j, j] if j == 0 else np.sign(z) * max(abs(z) - lasso, 0.0) / (gram[j, j] + ridge)
            most, b[j] = max(most, abs(new - b[j])), new
        if most < tolerance * max(1.0, np.abs(b).max()):
            break
    return b


def elastic_net(df: DataFrame, y: str, xs: list[str], family: str, penalties: list[float], mix: float = 1.0, offset: str | None = None, weight: str | None = None, rounds: int = 60, tolerance: float = 1e-9) -> DataFrame:
    """penalty, term, coefficient: for each penalty the b that minimises - sum(w loglik) / sum(w) + penalty (mix |b|_1 + (1 - mix) |b|^2 / 2), the intercept free; gaussian, binomial (logit) or poisson (log), the
    offset added to the linear predictor. mix 1 is the lasso, 0 the ridge.

    Proximal Newton: a pass adds up weighted Gram matrices around the present coefficients of all penalties that haven't settled, the driver descends by coordinates on those few numbers; a step that doesn't lower the
    objective is halved. For the gaussian family one pass serves the whole path. Rows with a null in any column used are left out. Not settling in ``rounds`` passes raises.
    """
    p = len(xs) + 1
    cols = [F.col(c).cast("double").alias(f"_{k}") for k, c in enumerate([y, *xs])]
    base = persisted(df.select(*cols, (F.col(offset).cast("double") if offset else F.lit(0.0)).alias("_o"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_w")).dropna(), "net")

    def sums(betas: np.ndarray) -> np.ndarray:
        """[penalty, 1 + 1 + p + p * p]: sum of weights, log likelihood, gradient and Gram matrix at each of the coefficients."""

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((len(betas), 2 + p + p * p))
            for b in batches:
                z = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns])
                x, o, w = np.column_stack([np.ones(len(z)), z[:, 1:p]]), z[:, p], z[:, p + 1]
                for k, beta in enumerate(betas):
                    ll, res, h = working(family, x @ beta + o, z[:, 0])
                    out[k] += np.r_[w.sum(), w @ ll, x.T @ (w * res), ((x * (w * h)[:, None]).T @ x).ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(out.size)), pa.array(out.ravel())], names=["k", "v"])

        got = base.mapInArrow(add, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()  # a fixed number of sums
        out = np.zeros(len(betas) * (2 + p + p * p))
        out[got["k"].to_numpy()] = got["v"].to_numpy()
        return out.reshape(len(betas), -1)

    def objective(row: np.ndarray, beta: np.ndarray, penalty: float) -> float:
        return -row[1] / row[0] + penalty * (mix * np.abs(beta[1:]).sum() + (1 - mix) * (beta[1:] ** 2).sum() / 2)

    def proposed(row: np.ndarray, beta: np.ndarray, penalty: float) -> np.ndarray:
        gram = row[2 + p :].reshape(p, p) / row[0]
        return descended(gram, row[2 : 2 + p] / row[0] + gram @ beta, beta, penalty * mix, penalty * (1 - mix))

    beta = np.zeros((len(penalties), p))
    row = sums(beta[:1])[0]
    if family == "gaussian":
        for k, penalty in enumerate(penalties):
            beta[k] = proposed(row, beta[0] * 0, penalty)
    else:
        rows = np.tile(row, (len(penalties), 1))
        value = np.array([objective(rows[k], beta[k], pen) for k, pen in enumerate(penalties)])
        step = np.array([proposed(rows[k], beta[k], pen) for k, pen in enumerate(penalties)]) - beta
        open_ = list(range(len(penalties)))
        for _ in range(rounds):
            got = sums(beta[open_] + step[open_])
            still = []
            for i, k in enumerate(open_):
                new = beta[k] + step[k]
                after = objective(got[i], new, penalties[k])
                if not np.isfinite(after) or after > value[k] + 1e-12 * abs(value[k]):
                    step[k] /= 2
                    still += [k] if np.abs(step[k]).max() > tolerance else []
                    continue
                moved = np.abs(step[k]).max()
                beta[k], value[k] = new, after
                step[k] = proposed(got[i], new, penalties[k]) - new
                still += [k] if max(moved, np.abs(step[k]).max()) > tolerance * max(1.0, np.abs(new).max()) else []
            open_ = still
            if not open_:
                break
        else:
            raise RuntimeError("the elastic net did not converge")
    rows = [(float(pen), t, float(b)) for k, pen in enumerate(penalties) for t, b in zip(["(intercept)", *xs], beta[k], strict=True)]
    return df.sparkSession.createDataFrame(rows, "penalty double, term string, coefficient double")


def cox_counting(df: DataFrame, start: str, stop: str, event: Column, xs: list[str], stratum: str | None = None, cluster: str | None = None, rounds: int = 30, tolerance: float = 1e-8) -> DataFrame:
    """covariate, beta, se, robust_se: proportional hazards over rows at risk in (start, stop], each stratum with a baseline of its own, Breslow ties; robust errors from score residuals by cluster (else by row).

    A row enters at its start and leaves at its stop; running sums from the latest time down over a stratum's distinct times give the sets at risk. Not settling in ``rounds`` raises.
    """
    p = len(xs)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    k = F.col(stratum) if stratum else F.lit(0)
    own = F.col(cluster) if cluster else F.monotonically_increasing_id()
    base = persisted(df.select(F.col(start).cast("double").alias("a"), F.col(stop).cast("double").alias("z"), event.cast("int").alias("d"), k.alias("k"), own.alias("g"), *[F.col(x).cast("double").alias(f"x{i}") for i, x in enumerate(xs)]).where("z > a"), "cox")
    names = ["s", *[f"a{i}" for i in range(p)], *[f"q{i}_{j}" for i, j in pairs]]

    def sets(beta: np.ndarray) -> DataFrame:
        w = F.exp(sum((F.col(f"x{i}") * float(b) for i, b in enumerate(beta)), F.lit(0.0)))
        sides = F.explode(F.array(F.struct(F.col("z").alias("t"), F.lit(1.0).alias("sign")), F.struct(F.col("a").alias("t"), F.lit(-1.0).alias("sign"))))
        e = base.withColumn("_w", w).withColumn("_e", sides).withColumn("w", F.col("_w") * F.col("_e.sign")).withColumn("d", F.when(F.col("_e.sign") > 0, F.col("d")).otherwise(0))
        sums = [F.sum("w").alias("s"), *[F.sum(F.col("w") * F.col(f"x{i}")).alias(f"a{i}") for i in range(p)], *[F.sum(F.col("w") * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}_{j}") for i, j in pairs]]
        t = e.groupBy("k", F.col("_e.t").alias("t")).agg(F.sum("d").alias("d"), *sums, *[F.sum(F.col("d") * F.col(f"x{i}")).alias(f"e{i}") for i in range(p)])
        run = prefix_sums(t, "t", names, descending=True, keys=["k"])
        return run.select("k", "t", "d", *[f"e{i}" for i in range(p)], *[F.col(f"cum_{n}").alias(n) for n in names])

    beta = np.zeros(p)
    for _ in range(rounds):
        t = sets(beta).where("d > 0")
        m = [F.col(f"a{i}") / F.col("s") for i in range(p)]
        one = t.agg(*[F.sum(F.col(f"e{i}") - F.col("d") * m[i]).alias(f"g{i}") for i in range(p)], *[F.sum(F.col("d") * (F.col(f"q{i}_{j}") / F.col("s") - m[i] * m[j])).alias(f"h{i}_{j}") for i, j in pairs]).first()
        info = np.zeros((p, p))
        for i, j in pairs:
            info[i, j] = info[j, i] = one[f"h{i}_{j}"]
        step = np.linalg.solve(info, np.array([one[f"g{i}"] for i in range(p)]))
        beta = beta + step
        if np.abs(step).max() < tolerance:
            break
    else:
        raise RuntimeError("the Cox model did not converge")
    hazard = F.when(F.col("d") > 0, F.col("d") / F.col("s")).otherwise(0.0)
    share = [F.when(F.col("d") > 0, F.col(f"a{i}") / F.col("s")).otherwise(0.0) for i in range(p)]
    steps = sets(beta).select("k", "t", hazard.alias("h"), *[(hazard * share[i]).alias(f"m{i}") for i in range(p)], *[share[i].alias(f"b{i}") for i in range(p)])
    sums = ["h", *[f"m{i}" for i in range(p)]]
    run = prefix_sums(steps, "t", sums, keys=["k"])

    def at(c: str, rows: DataFrame) -> DataFrame:
        """The sums at each row's time ``c``; times that many rows share meet a broadcast."""
        told = run.select("k", F.col("t").alias(c), *[F.col(f"cum_{n}").alias(f"{c}{n}") for n in sums], *[F.col(f"b{i}").alias(f"{c}b{i}") for i in range(p)])
        return lookup(rows, base.groupBy("k", c).agg(F.count("*").alias("_n")).join(told, ["k", c]), ["k", c], "_n")

    w = F.exp(sum((F.col(f"x{i}") * float(b) for i, b in enumerate(beta)), F.lit(0.0)))
    res = [F.col("d") * (F.col(f"x{i}") - F.col(f"zb{i}")) - w * (F.col(f"x{i}") * (F.col("zh") - F.col("ah")) - (F.col(f"zm{i}") - F.col(f"am{i}"))) for i in range(p)]
    scores = at("a", at("z", base)).groupBy("g").agg(*[F.sum(r).alias(f"r{i}") for i, r in enumerate(res)])
    two = scores.agg(*[F.sum(F.col(f"r{i}") * F.col(f"r{j}")).alias(f"v{i}_{j}") for i, j in pairs]).first()
    meat = np.zeros((p, p))
    for i, j in pairs:
        meat[i, j] = meat[j, i] = two[f"v{i}_{j}"]
    inv = np.linalg.inv(info)
    robust = np.sqrt(np.diag(inv @ meat @ inv))
    return df.sparkSession.createDataFrame([(x, float(b), float(s), float(r)) for x, b, s, r in zip(xs, beta, np.sqrt(np.diag(inv)), robust, strict=True)], "covariate string, beta double, se double, robust_se double")


def vif(df: DataFrame, xs: list[str]) -> DataFrame:
    """variable, vif: the diagonal of the inverse correlation matrix, from one aggregate over complete rows."""
    pairs = [(i, j) for i in range(len(xs)) for j in range(i + 1, len(xs))]
    one = df.dropna(subset=xs).agg(*[F.corr(xs[i], xs[j]).alias(f"r{i}_{j}") for i, j in pairs]).first()
    r = np.eye(len(xs))
    for i, j in pairs:
        r[i, j] = r[j, i] = one[f"r{i}_{j}"]
    return df.sparkSession.createDataFrame([(x, float(v)) for x, v in zip(xs, np.diag(np.linalg.inv(r)), strict=True)], "variable string, vif double")


def dispersion(df: DataFrame, y: Column, mu: Column, variance: Column, parameters: int) -> DataFrame:
    """n, pearson, ratio: the sum of squared Pearson residuals and that over the degrees of freedom."""
    s = df.agg(F.count("*").alias("n"), F.sum((y - mu) ** 2 / variance).alias("pearson"))
    return s.withColumn("ratio", F.try_divide(F.col("pearson"), F.col("n") - parameters))


def influence(df: DataFrame, y: str, xs: list[str], key: list[str]) -> DataFrame:
    """key, leverage, cook of least squares: the few sums are solved on the driver, distances are computed where the rows are."""
    d = df.dropna(subset=[y, *xs])
    z = [F.lit(1.0), *[F.col(x).cast("double") for x in xs]]
    p = len(z)
    idx = [(i, j) for i in range(p) for j in range(i, p)]
    one = d.agg(F.count("*").alias("n"), *[F.sum(z[i] * z[j]).alias(f"q{i}_{j}") for i, j in idx]).first()
    q = np.zeros((p, p))
    for i, j in idx:
        q[i, j] = q[j, i] = one[f"q{i}_{j}"]
    inv = np.linalg.inv(q)
    b = [r["coefficient"] for r in ols(d, y, xs).collect()]  # one row a term
    e = F.col(y) - sum((z[i] * float(b[i]) for i in range(1, p)), F.lit(float(b[0])))
    s2 = d.agg(F.sum(e * e)).first()[0] / (one["n"] - p)
    h = sum((z[i] * z[j] * float(inv[i, j]) for i in range(p) for j in range(p)), F.lit(0.0))
    return d.select(*key, h.alias("leverage"), e.alias("_e")).select(*key, "leverage", (F.col("_e") ** 2 * F.col("leverage") / (p * float(s2) * (1 - F.col("leverage")) ** 2)).alias("cook"))


def predict_curve(df: DataFrame, predict: Callable[[DataFrame], DataFrame], x: str, at: list[float]) -> DataFrame:
    """x, n, mean: the mean prediction over all rows with ``x`` set to each value; ``predict`` maps a DataFrame to one with p."""
    set_to = df.withColumn(x, F.explode(F.array(*[F.lit(float(v)) for v in at])))
    return predict(set_to).groupBy(F.col(x).alias("x")).agg(F.count("*").alias("n"), F.avg("p").alias("mean"))


def standardize(df: DataFrame, y: str, treated: Column, xs: list[str]) -> DataFrame:
    """mean1, mean0, difference over all rows of least-squares predictions, fitted on the treated and on the others."""
    fits = [[r["coefficient"] for r in ols(df.where(t), y, xs).collect()] for t in (treated, ~treated)]  # one row a term
    p = [F.avg(sum((F.col(x) * float(v) for x, v in zip(xs, b[1:], strict=True)), F.lit(float(b[0])))) for b in fits]
    return df.agg(p[0].alias("mean1"), p[1].alias("mean0")).withColumn("difference", F.col("mean1") - F.col("mean0"))


def negative_control(df: DataFrame, controls: list[str], treated: Column) -> DataFrame:
    """control, p1, p0, rd, its Wald bounds, flagged: an outcome that treatment can't change but that differs between arms, so that something else does."""
    out = []
    for k, c in enumerate(controls):
        y = F.col(c).cast("double")
        n1, n0, p1, p0 = F.count(F.when(treated, y)), F.count(F.when(~treated, y)), F.avg(F.when(treated, y)), F.avg(F.when(~treated, y))
        se = F.sqrt(p1 * (1 - p1) / n1 + p0 * (1 - p0) / n0)
        out.append(F.struct(F.lit(c).alias("control"), p1.alias("p1"), p0.alias("p0"), (p1 - p0).alias("rd"), (p1 - p0 - Z95 * se).alias("low"), (p1 - p0 + Z95 * se).alias("high")).alias(f"c{k}"))
    t = df.agg(*out).select(F.explode(F.array(*[f"c{k}" for k in range(len(controls))])).alias("x")).select("x.*")
    return t.withColumn("flagged", (F.col("low") > 0) | (F.col("high") < 0))


def refuse_late_outcomes(df: DataFrame, ends: str, index: str) -> DataFrame:
    """``df``; raises where the window of a control outcome, which must lie before treatment, ends after the index time."""
    late = df.where(F.col(ends) > F.col(index)).count()
    if late:
        raise ValueError(f"the outcome window of {late} rows ends after their index time")
    return df


def specification_grid(df: DataFrame, y: str, treated: Column, ps: str, specs: list[dict]) -> DataFrame:
    """spec, n, n_treated, mean1, mean0, difference, ess: every specification over one fit's propensities in one pass over the rows.

    A specification has estimand (ATE, ATT, ATO) and may have trim (low, high: rows outside leave) and truncate (low, high: weights use the nearest bound); its name is its place in the list. A row goes once to
    each specification that keeps it, and is added up before the shuffle.
    """
    p = F.col(ps)
    cells = []
    for k, s in enumerate(specs):
        low, high = s.get("truncate", (0.0, 1.0))
        w = weight(treated, p, s["estimand"], low, high)
        keep = p.between(*s["trim"]) if "trim" in s else F.lit(True)
        cells.append(F.when(keep & (p > 0) & (p < 1) if low == 0.0 or high == 1.0 else keep, F.struct(F.lit(k).alias("spec"), w.alias("w"))))
    each = df.where(F.col(y).isNotNull() & p.isNotNull()).select(F.col(y).cast("double").alias("_y"), treated.alias("_t"), F.explode(F.array_compact(F.array(*cells))).alias("x")).select("_y", "_t", "x.*")
    of = lambda t: F.sum(F.when(F.col("_t") == t, F.col("w") * F.col("_y"))) / F.sum(F.when(F.col("_t") == t, F.col("w")))
    s = each.groupBy("spec").agg(F.count("*").alias("n"), F.count_if("_t").alias("n_treated"), of(True).alias("mean1"), of(False).alias("mean0"), (F.sum("w") ** 2 / F.sum(F.col("w") ** 2)).alias("ess"))
    return s.select("spec", "n", "n_treated", "mean1", "mean0", (F.col("mean1") - F.col("mean0")).alias("difference"), "ess")


def leave_one_out(df: DataFrame, y: str, treated: str, xs: list[str], estimand: str, ledger: str) -> DataFrame:
    """left_out ('(none)': no covariate), difference, ess: the weighted difference with the propensity fitted without each covariate. A fit is added to the ``ledger`` folder as soon as it is known, and fits found there aren't made again."""
    spark = df.sparkSession
    kind = "left_out string, difference double, ess double"
    try:
        known = {r["left_out"]: r for r in spark.read.schema(kind).json(ledger).collect()}  # a row a covariate
    except Exception as missing:  # noqa: BLE001 no ledger yet
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        known = {}
    base = persisted(df, "grid")
    for out in ("(none)", *xs):
        if out not in known:
            fit = propensity(base, treated, [x for x in xs if x != out])
            one = specification_grid(fit, y, F.col(treated).cast("boolean"), "ps", [{"estimand": estimand, "truncate": (0.01, 0.99)}])
            append_ledger(one.select(F.lit(out).alias("left_out"), "difference", "ess"), ledger)
    return spark.read.schema(kind).json(ledger)


def sensitivity_grid(effects: DataFrame, rr: str, with_treatment: list[float], with_outcome: list[float]) -> DataFrame:
    """``effects`` with treatment_rr, outcome_rr, adjusted, explained: the ratio after the largest bias that a confounder of such strength can make, and whether none is left."""
    grid = F.explode(F.array(*[F.struct(F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b")) for a in with_treatment for b in with_outcome]))
    bias = F.col("_g.a") * F.col("_g.b") / (F.col("_g.a") + F.col("_g.b") - 1)
    d = effects.withColumn("_g", grid).withColumn("adjusted", F.when(F.col(rr) >= 1, F.col(rr) / bias).otherwise(F.col(rr) * bias))
    return d.select(*effects.columns, F.col("_g.a").alias("treatment_rr"), F.col("_g.b").alias("outcome_rr"), "adjusted", F.when(F.col(rr) >= 1, F.col("adjusted") <= 1).otherwise(F.col("adjusted") >= 1).alias("explained"))
