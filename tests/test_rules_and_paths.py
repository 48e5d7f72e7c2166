"""Phrase rules, segmentation and penalised paths against plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import pathways, phrases, regress

RULES = phrases.Rules(
    {"chest pain": "pain", "pain": "pain", "acute chest pain": "acute", "fever": "fever", "of fever": "fever phrase"},
    (phrases.Cue("no evidence of", "negated"), phrases.Cue("no", "negated", reach=3), phrases.Cue("was ruled out", "negated", "backward"), phrases.Cue("history of", "historical"), phrases.Cue("if", "hypothetical"), phrases.Cue("mother", "other subject", "both", 4)),
    ("but", "except for"),
)


def brute(text, rules):
    """All spans, all cues, by definition."""
    toks = phrases.words(text)
    w = [t for t, _, _ in toks]

    def taken(entries):
        out, at = [], 0
        entries = {tuple(t for t, _, _ in phrases.words(p)): v for p, v in entries.items()}
        while at < len(w):
            spans = [(at, z, entries[tuple(w[at:z])]) for z in range(at + 1, len(w) + 1) if tuple(w[at:z]) in entries]
            out += spans[-1:]
            at = spans[-1][1] if spans else at + 1
        return out

    cues, ends = taken({c.phrase: c for c in rules.cues}), [a for a, _, _ in taken({p: 1 for p in (*rules.ends, ".", "!", "?")})]
    out = []
    for a, z, concept in taken(rules.targets):
        near = []
        for ca, cz, c in cues:
            if cz <= a and c.direction in ("forward", "both") and a - cz < c.reach and not any(cz <= e < a for e in ends):
                near.append((a - cz, ca, c.assertion))
            elif ca >= z and c.direction in ("backward", "both") and ca - z < c.reach and not any(z <= e < ca for e in ends):
                near.append((ca - z, ca, c.assertion))
        out.append((toks[a][1], toks[z - 1][2], concept, min(near)[2] if near else "affirmed"))
    return out


def test_mentions_of_known_notes(spark):
    note = "No evidence of acute chest pain, but fever. Chest pain was ruled out! History of fever; mother had pain. If fever returns, no pain except for fever"
    df = spark.createDataFrame([(1, note), (2, None), (3, ""), (4, "nothing here")], "doc long, text string").withColumn("concept", F.lit("clash"))
    got = [(note[r["start"] : r["end"]].lower(), r["concept"], r["assertion"]) for r in phrases.extract_mentions(df, ["doc"], "text", RULES).orderBy("start").collect()]
    assert got == [
        ("acute chest pain", "acute", "negated"), ("fever", "fever", "affirmed"), ("chest pain", "pain", "negated"), ("of fever", "fever phrase", "other subject"), ("pain", "pain", "other subject"),
        ("fever", "fever", "hypothetical"), ("pain", "pain", "negated"), ("fever", "fever", "affirmed"),
    ]
    with pytest.raises(ValueError):
        phrases.Matcher(phrases.Rules({"--": "nothing"}))


def test_mentions_of_brute_force():
    rng = random.Random(1)
    vocab = "chest pain acute fever of no evidence history if mother was ruled out but except for . ! and then".split()
    m = phrases.Matcher(RULES)
    for _ in range(400):
        text = " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 40)))
        assert [x[:4] for x in m.of(text)] == brute(text, RULES)


def test_flags_and_offsets(spark):
    rows = [(1, "pain", "affirmed", "2024-01-02 00:00:00"), (1, "pain", "affirmed", "2024-01-01 12:00:00"), (1, "pain", "negated", "2024-01-01 00:00:00"), (2, "pain", "historical", "2024-01-01 00:00:00"), (3, "pain", "affirmed", "2023-12-31 23:00:00")]
    m = spark.createDataFrame(rows, "k long, concept string, assertion string, at string").withColumn("at", F.to_timestamp_ntz("at")).withColumn("a", F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")))
    got = {r["k"]: tuple(r)[2:] for r in phrases.assertion_flags(m, ["k"], F.col("a"), "at").collect()}
    assert got == {1: (2, 1, 0, 12.0), 2: (0, 0, 1, None), 3: (1, 0, 0, -1.0)}
    onset = m.where("k < 3").select("k", F.col("a").alias("o")).distinct()
    hist = {(r["concept"], r["bin"]): r["n"] for r in phrases.onset_offsets(m, onset, ["k"], "at", "o", 6).collect()}
    assert hist == {("pain", 2): 1, ("pain", None): 1, (None, None): 1}


def test_segmentation_is_the_loop(spark):
    rng = np.random.default_rng(3)
    series = {"a": np.r_[rng.normal(0, 1, 120), rng.normal(6, 1, 80), rng.normal(-3, 1, 150), rng.normal(0, 1, 40)], "b": rng.normal(2, 1, 60), "c": np.array([1.0, 1.0, 9.0, 9.0]), "d": np.array([5.0])}
    rows = [(k, i, float(v)) for k, x in series.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "k string, i long, v double").repartition(6)

    def split(x, start, bar, out, turn):
        best = None
        for n in range(2, len(x) - 1):
            g = round(x[:n].sum() ** 2 / n + x[n:].sum() ** 2 / (len(x) - n) - x.sum() ** 2 / len(x), 6)
            if g >= bar and g > 0 and (best is None or g > best[0]):
                best = (g, n)
        if best:
            out.append((start + best[1], turn))
            split(x[: best[1]], start, bar, out, turn + 1)
            split(x[best[1] :], start + best[1], bar, out, turn + 1)

    want = []
    for k, x in series.items():
        out = []
        split(x, 0, 3.0 * x.var(ddof=1) if len(x) > 1 else 0, out, 1)
        want += [(k, *o) for o in out]
    got = pathways.change_points(df, "k", ["i"], "v", 3.0).collect()
    assert sorted((r["k"], r["at"], r["round"]) for r in got) == sorted(want)
    assert {120, 200, 350} <= {r["at"] for r in got if r["k"] == "a"}
    first = {r["k"]: r["at"] for r in pathways.change_point(df, "k", ["i"], "v").collect()}
    assert all(first[r["k"]] == r["at"] for r in got if r["round"] == 1)


@pytest.mark.parametrize("family", ["gaussian", "binomial", "poisson"])
def test_elastic_net_minimises(spark, family):
    """Against proximal gradient descent on whole arrays, with weights and an offset."""
    rng = np.random.default_rng(4)
    n = 400
    x, o, w = rng.normal(size=(n, 4)) * [1, 2, 0.5, 1], rng.normal(size=n) * 0.3, rng.integers(1, 4, n).astype(float)
    eta = 0.4 + x @ [0.8, 0, -0.6, 0.1] + o
    y = {"gaussian": eta + rng.normal(size=n), "binomial": (rng.random(n) < 1 / (1 + np.exp(-eta))).astype(float), "poisson": rng.poisson(np.exp(np.clip(eta, -3, 3))).astype(float)}[family]
    df = spark.createDataFrame([(float(y[i]), *map(float, x[i]), float(o[i]), float(w[i])) for i in range(n)] + [(None, 1.0, 1.0, 1.0, 1.0, 0.0, 1.0)], "y double, a double, b double, c double, d double, o double, w double").repartition(3)
    penalties = [0.3, 0.05, 0.0]
    got = {}
    for r in regress.elastic_net(df, "y", ["a", "b", "c", "d"], family, penalties, 0.7, "o", "w").collect():
        got.setdefault(r["penalty"], []).append(r["coefficient"])
    z = np.column_stack([np.ones(n), x])
    for pen in penalties:
        b, rate = np.zeros(5), 0.02
        for _ in range(20_000):
            res = regress.working(family, z @ b + o, y)[1]
            step = b + rate * (z.T @ (w * res) / w.sum() - np.r_[0, pen * 0.3 * b[1:]])
            new = np.r_[step[0], np.sign(step[1:]) * np.maximum(np.abs(step[1:]) - rate * pen * 0.7, 0)]
            b, moved = new, np.abs(new - b).max()
            if moved < 1e-11:
                break
        assert got[pen] == pytest.approx(b, abs=1e-5)
    assert family == "poisson" or 0.0 in got[0.3]


def test_signed_rank_is_enumeration(spark):
    from itertools import product

    from strandline.operators import inference

    rng = random.Random(5)
    for n in (1, 4, 9, 13):
        d = [rng.choice([-3, -2, -1, 1, 2, 3, 4, 0.5]) for _ in range(n)]
        a = sorted(abs(x) for x in d)
        rank = {v: np.mean([k + 1 for k, x in enumerate(a) if x == v]) for v in a}
        w = sum(rank[abs(x)] for x in d if x > 0)
        sums = np.array([sum(r for r, s in zip((rank[abs(x)] for x in d), signs) if s) for signs in product((0, 1), repeat=n)])
        want = min(1, 2 * min((sums <= w + 1e-9).mean(), (sums >= w - 1e-9).mean()))
        got = inference.signed_rank(spark.createDataFrame([(float(x),) for x in [*d, 0.0]] + [(None,)], "d double"), F.col("d")).first()
        assert (got["n"], got["w_plus"], got["exact"]) == (n, pytest.approx(w), True) and got["p"] == pytest.approx(want)
    big = spark.range(60).select((F.col("id") - 20.5).alias("d"))
    got = inference.signed_rank(big, F.col("d")).first()
    assert not got["exact"] and got["p"] < 0.01 and inference.signed_rank(big.where("false"), F.col("d")).first()["p"] is None


def measures(y, s, w):
    """AUROC, AUPRC and Brier by loops over weighted rows."""
    pos, neg = w[y == 1].sum(), w[y == 0].sum()
    auc = sum(w[i] * w[j] * ((s[i] > s[j]) + 0.5 * (s[i] == s[j])) for i in np.flatnonzero(y == 1) for j in np.flatnonzero(y == 0)) / (pos * neg)
    ap = sum(w[(y == 1) & (s == v)].sum() * w[(y == 1) & (s >= v)].sum() / w[s >= v].sum() for v in set(s) if w[s >= v].sum()) / pos
    return auc, ap, (w * (s - y) ** 2).sum() / w.sum()


def test_intervals_of_fifty_replicates(spark):
    from strandline.operators import assess, inference

    rng = np.random.default_rng(6)
    c, y, era = rng.integers(0, 15, 120), rng.integers(0, 2, 120), rng.integers(0, 2, 120)
    p = np.round(np.clip(0.3 + 0.3 * y + rng.normal(0, 0.2, 120), 0, 1), 1)
    q = np.round(rng.random(120), 1)
    rows = [(int(c[i]), int(y[i]), int(era[i]), float(p[i]), float(q[i])) for i in range(120)]
    df = spark.createDataFrame(rows, "c long, y int, era int, p double, q double").repartition(4)
    times = np.zeros((50, 15))
    for r in inference.draws(df.select(F.col("c").alias("_c")).distinct(), "_c", 50, 3).collect():
        times[r["rep"], r["_c"]] = r["times"]
    got = {r["metric"]: r for r in assess.metric_intervals(df, "c", "p", F.col("y"), 50, 3).collect()}
    pair = {r["metric"]: r for r in assess.paired_intervals(df, "c", "p", "q", F.col("y"), 50, 3).collect()}
    own, other = (np.array([measures(y, s, t[c]) for t in times]) for s in (p, q))
    one, two = measures(y, p, np.ones(120)), measures(y, q, np.ones(120))
    for k, m in enumerate(("auroc", "auprc", "brier")):
        assert (got[m]["estimate"], got[m]["low"], got[m]["high"]) == pytest.approx((one[k], *np.quantile(own[:, k], [0.025, 0.975])))
        assert (pair[m]["estimate"], pair[m]["low"], pair[m]["high"]) == pytest.approx((one[k] - two[k], *np.quantile(own[:, k] - other[:, k], [0.025, 0.975])))
    by = {(r["era"], r["metric"]): r["estimate"] for r in assess.metric_intervals(df, "c", "p", F.col("y"), 5, 3, ["era"]).collect()}
    assert all(by[e, "auroc"] == pytest.approx(measures(y[era == e], p[era == e], np.ones((era == e).sum()))[0]) for e in (0, 1))


def test_sums_by_replicate_without_a_row_for_each(spark, monkeypatch):
    """tasks add up vectors of replicates, in parts where keys are many; keys may be null."""
    from strandline.operators import assess

    rng = np.random.default_rng(9)
    rows = [(None if k % 9 == 0 else f"e{k % 2}", float(k % 7), int(rng.integers(1, 4)), int(rng.integers(0, 2)), [int(x) for x in rng.integers(0, 10, rng.integers(0, 6))]) for k in range(300)]
    want = {}
    for e, s, n, p, reps in rows:
        for r in reps:
            a = want.setdefault((e, s, r), [0, 0])
            a[0], a[1] = a[0] + n, a[1] + p
    df = spark.createDataFrame(rows, "e string, s double, n long, p long, reps array<int>").repartition(2)
    for cells, most in ((1 << 20, 2 * len(want)), (50, len(rows) * 10)):
        monkeypatch.setattr(assess, "CELLS", cells)
        got = assess.weighted_counts(df, ["e", "s"], 10)
        assert got.count() <= most
        assert {(r["e"], r["s"], r["rep"]): [r["n"], r["p"]] for r in got.groupBy("e", "s", "rep").agg(F.sum("n").alias("n"), F.sum("p").alias("p")).collect()} == want


def test_spearman_of_complete_pairs(spark):
    from strandline.operators import inference

    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(200, 3)) + rng.normal(size=(200, 1)), 1)
    x[rng.random((200, 3)) < 0.2] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], "a double, b double, c double")
    mean_rank = lambda v: np.array([(v < t).sum() + ((v == t).sum() + 1) / 2 for t in v])
    for r in inference.spearman_matrix(df, ["a", "b", "c"]).collect():
        i, j = "abc".index(r["a"]), "abc".index(r["b"])
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert r["n"] == both.sum() and r["rho"] == pytest.approx(np.corrcoef(mean_rank(x[both, i]), mean_rank(x[both, j]))[0, 1])
    assert inference.spearman_matrix(df.limit(3), ["a", "b"]).first()["rho"] is None


def test_one_fit_serves_all_features(spark, monkeypatch):
    from strandline.operators import features, models

    rng = random.Random(3)
    rows = [(n, rng.gauss(0, 1), rng.gauss(0, 1), int(rng.random() < 0.5)) for n in range(400)]
    df = spark.createDataFrame([(n, x, z, int(x + rng.gauss(0, 0.5) > 0)) for n, x, z, _ in rows], "n long, x double, z double, y int")
    fits, real = [], models.baseline
    monkeypatch.setattr(models, "baseline", lambda *a, **k: fits.append(1) or real(*a, **k))
    drop = {r["feature"]: r["drop"] for r in models.permutation_importance(df, df, "n", ["x", "z"], "y").collect()}
    assert drop["x"] > 0.2 > abs(drop["z"]) and len(fits) == 1
    whole = features.auroc(real(df, ["x", "z"], "y")(df), "p", F.col("y").cast("boolean")).first()["auroc"]
    got = {r["feature"]: r for r in models.audit_robustness(df, df, "n", ["x", "z"], "y").collect()}
    assert got["x"]["auroc_missing"] < whole and len(fits) == 2
