"""Operators on hand-made rows with answers known on paper."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions import distributions as dist
from strandline.functions import timesem as ts
from strandline.operators import causal, cohorts, disclosure, features, inference, joins, matching, pathways, phenotypes, sums, survival, text, windows
from strandline.operators import checks as ch
from strandline.sources import tables as src


def at(spark, rows, cols, times):
    df = spark.createDataFrame(rows, cols)
    for t in times:
        df = df.withColumn(t, F.to_timestamp_ntz(F.lit("2020-01-01 00:00:00")) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col(t).cast("decimal(18,6)")))
    return df


def test_contract_reads_quotes_and_newlines(spark, tmp_path):
    spec = src.TableSpec("t", T.StructType.fromDDL("a int, b string"), multiline=True)
    (tmp_path / "x.csv").write_text('a,b\r\n1,"two\nlines ""quoted"""\r\n,plain\r\n', newline="")
    rows = src.read_contract(spark, spec, str(tmp_path / "x.csv")).collect()
    assert [tuple(r) for r in rows] == [(1, 'two\nlines "quoted"'), (None, "plain")]
    (tmp_path / "y.csv").write_text("b,a\nx,1\n")
    with pytest.raises(ValueError):
        src.read_contract(spark, spec, str(tmp_path / "y.csv"))


def test_column_map_refuses(spark):
    spec = src.TableSpec("t", T.StructType.fromDDL("a int, b string"))
    df = spark.createDataFrame([(1, 2)], "x int, y int")
    with pytest.raises(ValueError):
        src.apply_column_map(df, src.ColumnMap(rename={"x": "a", "y": "a"}), spec)
    with pytest.raises(ValueError):
        src.apply_column_map(df, src.ColumnMap(rename={"x": "a"}, drop=("y",)), spec)


def test_asof_ties_tolerance_and_nulls(spark):
    left = at(spark, [("k", 10.0, 1), ("k", 5.0, 2), ("q", 10.0, 3), (None, 10.0, 4)], "k string, t double, i int", ["t"])
    right = at(spark, [("k", 10.0, 7, 1), ("k", 10.0, 8, 2), ("k", 6.0, 9, 3)], "k string, r double, v int, n int", ["r"])
    got = {r["i"]: r["v"] for r in joins.asof_join(left, right, ["k"], "t", "r", ["v"], "n").collect()}
    assert got == {1: 8, 2: None, 3: None, 4: None}
    ahead = {r["i"]: r["v"] for r in joins.asof_join(left, right, ["k"], "t", "r", ["v"], "n", "forward", 1 / 3600).collect()}
    assert ahead == {1: 7, 2: 9, 3: None, 4: None}
    near = joins.asof_join(left, right, ["k"], "t", "r", ["v"], "n", "forward", 0.5 / 3600).where("i = 2").first()
    assert near["v"] is None


@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_asof_of_a_hot_key_is_that_of_one_task(spark, direction):
    rng = random.Random(8)
    side = lambda n: [(rng.choice(["hot"] * 9 + ["a", None]), float(rng.randint(0, 120)) if k % 40 else None, k) for k in range(n)]
    left, right = at(spark, side(500), "k string, t double, l int", ["t"]), at(spark, side(200), "k string, t double, r int", ["t"]).withColumnRenamed("t", "s")
    for tolerance in (None, 1 / 3600):
        one, cut = (joins.asof_join(left, right, ["k"], "t", "s", ["r"], "r", direction, tolerance, hot) for hot in (False, True))
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # a range stays a partition
        try:
            rows = sorted(cut.collect(), key=lambda r: r["l"])
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
        assert rows == sorted(one.collect(), key=lambda r: r["l"]) and len(rows) == 500


def test_interval_is_closed_then_open(spark):
    stays = at(spark, [("k", 0.0, 10.0, 1), ("k", 5.0, 20.0, 2)], "k string, s double, e double, stay int", ["s", "e"])
    pts = at(spark, [("k", 0.0, 1), ("k", 10.0, 2), ("k", 20.0, 3)], "k string, t double, p int", ["t"])
    got = {r["p"]: r["stay"] for r in joins.interval_join(pts, stays, ["k"], "t", "s", "e", "stay").collect()}
    assert got == {1: 1, 2: 2, 3: None}


def test_interval_join_of_a_hot_key_is_brute_force(spark):
    rng = random.Random(3)
    keys = ["hot"] * 6 + ["a", "b", None]
    stays = [(rng.choice(keys), s := float(rng.randint(0, 400)), rng.choice([s + rng.randint(-2, 40), None]) if n % 9 == 0 else s + rng.randint(0, 40), n) for n in range(300)]
    pts = [(rng.choice(keys), float(rng.randint(-5, 450)) if n % 50 else None, n) for n in range(600)]
    pairs = lambda k, t: [(s, e, i) for key, s, e, i in stays if key == k and None not in (k, t, e) and s <= t < e]
    want = {n: min(pairs(k, t), default=(0, 0, None))[2] for k, t, n in pts}
    intervals, points = spark.createDataFrame(stays, "k string, s double, e double, stay int"), spark.createDataFrame(pts, "k string, t double, p int")
    for adaptive in ("true", "false"):  # without it, a range stays a partition
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        try:
            got = joins.interval_join(points.union(points), intervals, ["k"], "t", "s", "e", "stay").collect()
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
        assert sorted((r["p"], r["stay"] or -1) for r in got) == sorted((n, i or -1) for n, i in want.items() for _ in range(2))  # a row for every row


def test_ewma_folds_long_and_short_series(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot"] * 8 + ["a", None]), n, rng.uniform(-5, 5)) for n in range(900)] + [("one", 1, 2.0), ("gap", 1, None), ("gap", 2, 3.0), ("gap", 3, None), ("none", 1, None)]
    want = {}
    for k, _, v in sorted(rows, key=lambda r: r[1]):
        n, x = want.get(k, (0, None))
        want[k] = n + 1, x if v is None else v if x is None else 0.3 * v + 0.7 * x
    got = {r["k"]: (r["n"], r["last_ewma"]) for r in pathways.ewma(spark.createDataFrame(rows, "k string, t int, v double").repartition(7), "k", ["t"], "v", 0.3).collect()}
    assert got.keys() == want.keys()
    assert all(got[k][0] == n and got[k][1] == (None if x is None else pytest.approx(x)) for k, (n, x) in want.items())


def test_gap_equal_to_the_threshold_does_not_break(spark):
    df = at(spark, [("k", 0.0, 1.0, 1), ("k", 3601.0, 3602.0, 2), ("k", 7203.0, 7203.0, 3)], "k string, s double, e double, i int", ["s", "e"])
    assert sorted(r["n"] for r in windows.merge_gaps(df, ["k"], "s", "e", 1, "i").collect()) == [1, 2]


def test_suppression(spark):
    cells = spark.createDataFrame([("a", "x", 5), ("a", "y", 20), ("b", "x", 30), ("b", "y", 40), ("c", "x", 0), ("c", "y", 50)], "r string, c string, n long")
    one = {(r["r"], r["c"]): r["n"] for r in disclosure.suppress(cells, ["n"]).collect()}
    assert one["a", "x"] is None and one["c", "x"] == 0 and one["a", "y"] == 20
    two = {(r["r"], r["c"]): r["n"] for r in disclosure.suppress_complementary(cells, "r", "c", "n").collect()}
    hidden = {k for k, v in two.items() if v is None}
    assert {("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")} <= hidden  # each margin with a hidden cell hides two
    for i in (0, 1):
        for m in {k[i] for k in two}:
            assert sum(k[i] == m for k in hidden) != 1
    chain = [(r["step"], r["shown"]) for r in disclosure.suppress_chain(spark.createDataFrame([(0, 1000), (1, 995), (2, 400)], "step int, n long"), "step", "n").orderBy("step").collect()]
    assert chain == [(0, "~1000"), (1, "~1000"), (2, "400")]
    with pytest.raises(ValueError):
        disclosure.safe_aggregate(cells, ["r"], {"m": ("mean", "n")}, ("r",))


def test_readmission_days(spark):
    df = at(spark, [(1, 0.0, 86400.0, 1), (1, 86400.0 * 31, 86400.0 * 32, 2), (1, 86400.0 * 63, 86400.0 * 64, 3)], "s int, a double, z double, i int", ["a", "z"])
    got = {r["i"]: r["readmitted"] for r in pathways.readmissions(df, "s", "a", "z", "i", 30).collect()}
    assert got == {1: True, 2: False, 3: False}


def test_product_limit_and_competing_risks(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 0), (2.0, 1), (3.0, 2), (4.0, 0)], "t double, c int").withColumn("g", F.lit("a"))
    km = [(r["time"], r["at_risk"], round(r["survival"], 6)) for r in survival.km(df, "t", F.col("c") == 1, "g").orderBy("time").collect()]
    assert km == [(1.0, 5, 0.8), (2.0, 4, 0.6)]
    aj = survival.aalen_johansen(df, "t", "c", "g").collect()
    assert all(abs(r["cif1"] + r["cif2"] + r["survival"] - 1) < 1e-12 for r in aj)


def test_cox_recovers_a_known_fit(spark):
    rows = [(float(t), t % 2) for t in range(1, 41)]
    df = spark.createDataFrame(rows, "t double, x int")
    r = survival.cox(df, "t", F.lit(True), ["x"]).first()
    import numpy as np

    b = 0.0
    for _ in range(50):  # plain Newton over the same partial likelihood
        g = h = 0.0
        for t, x in rows:
            risk = [(math.exp(b * xx), xx) for tt, xx in rows if tt >= t]
            s0, s1 = sum(w for w, _ in risk), sum(w * xx for w, xx in risk)
            g += x - s1 / s0
            h += s1 / s0 - (s1 / s0) ** 2
        b += g / h
    assert np.isclose(r["beta"], b, atol=1e-6)


def test_ranks_do_not_depend_on_partitions(spark, sf):
    e = src.load(spark, sf, "events")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    for n in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append(sorted((r["value"], r["avg_rank"]) for r in inference.rank_table(e, "value").select("value", "avg_rank").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1]


def test_resampling_repeats(spark, sf):
    e = src.load(spark, sf, "events")
    a = inference.cluster_bootstrap(e, "user_id", F.col("value"), F.lit(1), 50).first()
    b = inference.cluster_bootstrap(e.repartition(7), "user_id", F.col("value"), F.lit(1), 50).first()
    assert a["low"] <= a["estimate"] <= a["high"] and math.isclose(a["se"], b["se"], rel_tol=1e-9)


def test_draws_are_dealt_by_their_number(spark, monkeypatch):
    """The draws of few units lie in many tasks, and are those of a loop over xxhash64(seed, replicate, index)."""
    monkeypatch.setattr(inference, "DRAWS", 500)
    units = spark.range(30).select(F.concat(F.lit("u"), F.format_string("%02d", "id")).alias("u"), F.col("id").alias("x")).repartition(3)
    picks, _ = inference._picks(units, "u", 100, 7, ["x"])
    assert picks.rdd.getNumPartitions() == 6
    want = {(r["rep"], r["i"]): r["n"] for r in spark.sql("SELECT rep, pmod(xxhash64(7, rep, j), 30L) i, count(*) n FROM (SELECT int(a.id) rep, b.id j FROM range(100) a, range(30) b) GROUP BY 1, 2").collect()}
    got = inference.draws(units, "u", 100, 7, ["x"]).collect()
    assert {(r["rep"], r["x"]): r["times"] for r in got} == want and all(r["u"] == f"u{r['x']:02}" for r in got)
    assert {(k, int(r["u"][1:])): r["reps"].count(k) for r in inference.drawn_in(units, "u", 100, 7).collect() for k in r["reps"]} == want


def test_cmh_of_large_strata(spark):
    """the product of four margins of one stratum is over 2^63."""
    df = spark.range(400_000).select(F.lit(1).alias("s"), (F.col("id") % 2 == 0).alias("e"), (F.col("id") % 8 < 3).alias("g"))
    got = inference.cmh(df, "s", F.col("e"), F.col("g")).first()
    a, b, c, d, n = 100_000, 50_000, 100_000, 150_000, 400_000
    assert abs(got["or_mh"] - a * d / (b * c)) < 1e-9
    assert abs(got["chi2"] / ((a - (a + b) * (a + c) / n) ** 2 * n * n * (n - 1) / ((a + b) * (c + d) * (a + c) * (b + d))) - 1) < 1e-9


def test_matching_invariants(spark):
    df = spark.range(60).selectExpr("id", "id % 3 = 0 as t", "(id * 37 % 101) / 101.0D as s")
    pairs = matching.match(df, "id", "t", "s", 0.05).collect()
    assert pairs and all(p["distance"] <= 0.05 for p in pairs)
    assert len({p["treated_unit"] for p in pairs}) == len({p["control_unit"] for p in pairs}) == len(pairs)


def test_matching_takes_the_nearest_pair_left(spark):
    rng = random.Random(11)
    rows = [(n, rng.random() < 0.4, rng.random()) for n in range(150)] + [(200 + n, n < 40, 2 + n / 1000 + rng.random() / 1e5) for n in range(80)] + [(900, True, None), (901, None, 0.5)]
    left, want = [r for r in rows if None not in r], set()
    while left:
        d, t, c = min(((abs(a[2] - b[2]), a[0], b[0]) for a in left for b in left if a[1] and not b[1]), default=(1, 0, 0))
        if d > 0.05:
            break
        want.add((t, c))
        left = [r for r in left if r[0] not in (t, c)]
    df = spark.createDataFrame(rows, "id long, t boolean, s double")
    assert {(r["treated_unit"], r["control_unit"]) for r in matching.match(df, "id", "t", "s", 0.05).collect()} == want
    # a third of all rows on one score, and a long run of one group beside another: few rounds do
    tied = spark.range(3000).selectExpr("id", "id % 2 = 0 or id > 2900 as t", "case when id < 1000 then 0.5D else floor(id / 700) * 1.0D end as s")
    pairs = matching.match(tied, "id", "t", "s", 0.2, rounds=6).collect()
    n = {k: [r["n"] for r in tied.where(f"s = {k}").groupBy("t").agg(F.count("*").alias("n")).collect()] for k in (0.5, 1, 2, 3, 4)}
    assert len(pairs) == sum(min(x) for x in n.values() if len(x) == 2) and all(p["distance"] == 0 for p in pairs)
    assert len({p["treated_unit"] for p in pairs}) == len({p["control_unit"] for p in pairs}) == len(pairs)


def sequential(units, caliper):
    """(treated, control) by always taking the nearest two neighbours of what is left; units are (unit, treated, score)."""
    left, out = sorted(units, key=lambda r: (r[2], r[1], r[0])), []
    while True:
        near = [(*matching.key(a[2], b[2]), k) for k, (a, b) in enumerate(zip(left, left[1:])) if a[1] != b[1] and b[2] - a[2] <= caliper]
        if not near:
            return out
        k = min(near)[-1]
        a, b = left[k : k + 2]
        out.append((a[0], b[0]) if a[1] else (b[0], a[0]))
        del left[k : k + 2]


@pytest.mark.parametrize("block", [64])
def test_matching_in_blocks_is_sequential(spark, block):
    """Ties, equal gaps, growing gaps and runs of one group over the edges of small blocks."""
    rng = random.Random(block)
    for kind in range(4):
        score = [lambda n: float(n), lambda n: rng.randint(0, 40) / 4, lambda n: n * n / 50, lambda n: rng.random()][kind]
        rows = [(n, n % 2 == 0 if kind in (0, 2) else rng.random() < 0.4, score(n)) for n in range(200)]
        df = spark.createDataFrame(rows, "id long, t boolean, s double")
        got = {(r["treated_unit"], r["control_unit"]) for r in matching.match(df, "id", "t", "s", 3.0, rounds=20, block=block).collect()}
        assert got == set(sequential(rows, 3.0))


def test_a_part_of_the_order_settles_what_nothing_outside_changes():
    """Whatever lies outside: pairs of a part are pairs of the whole."""
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(4, 40)
        kind = rng.choice([lambda k: rng.random(), lambda k: rng.randint(0, 9) / 2, lambda k: k * k / 9.0, lambda k: float(k)])
        units = sorted(((k, rng.random() < 0.5, kind(k)) for k in range(n)), key=lambda r: (r[2], r[1], r[0]))
        a, z = sorted(rng.sample(range(n + 1), 2))
        part = units[a:z]
        pairs, still = matching.settle([r[2] for r in part], [r[1] for r in part], *({g: f((r[2] for r in rest if r[1] == g), default=None) for g in (True, False)} for f, rest in ((max, units[:a]), (min, units[z:]))), 2.0)
        whole = {frozenset(p) for p in sequential(units, 2.0)}
        got = {frozenset((part[i][0], part[j][0])) for i, j in pairs}
        assert got <= whole
        known = {r[0] for r in part} - {part[k][0] for k in still}
        assert got == {p for p in whole if p & known}


def test_growing_gaps_settle_and_sets_have_k_controls(spark):
    df = spark.range(100_000).selectExpr("id", "id % 2 = 0 as t", "cast(id * id as double) as s")
    got = {(r[0], r[1]) for r in matching.match(df, "id", "t", "s", 1e12, rounds=9).select("treated_unit", "control_unit").collect()}
    assert got == {(k, k + 1) for k in range(0, 100_000, 2)}
    rng = random.Random(8)
    rows = [(n, rng.random() < 0.2, rng.random()) for n in range(300)]
    df = spark.createDataFrame(rows, "id long, t boolean, s double")
    left, want = rows, []
    for turn in (1, 2, 3):
        pairs = sequential(left, 0.05)
        want += [(t, c, turn) for t, c in pairs]
        left = [r for r in left if (r[0] in {t for t, _ in pairs}) == r[1] and r[0] not in {c for _, c in pairs}]
    got = matching.matched_sets(df, "id", "t", "s", 0.05, 3, block=64).collect()
    assert sorted((r["set_id"], r["unit"], r["turn"]) for r in got if not r["treated"]) == sorted(want)
    assert sorted(r["unit"] for r in got if r["treated"]) == sorted({t for t, _, _ in want})


@pytest.fixture
def thirteen(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_keyed_sums_and_quantiles_of_loops(spark, thirteen):
    """One key holds most rows and lies in many ranges; null keys are a key; totals are those of the key."""
    import numpy as np

    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 8 + ["b", None, "c", "solo"]), n, rng.choice([None, rng.random(), rng.randint(0, 3) / 2])) for n in range(3000)] + [("empty", 9000, None), ("one", 9001, 5.0)]
    df = spark.createDataFrame(rows, "k string, n long, v double")
    got = {(r["k"], r["n"]): (r["cum_v"], r["all_v"]) for r in sums.prefix_sums(df.fillna(0.0, ["v"]), "n", ["v"], descending=True, keys=["k"], totals=True).collect()}
    for k in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == k), key=lambda r: -r[1])
        run = 0.0
        for r in own:
            run += r[2] or 0
            assert got[k, r[1]] == (pytest.approx(run), pytest.approx(sum(x[2] or 0 for x in own)))
    assert df.repartitionByRange("k", "n").where("k = 'hot'").select(F.spark_partition_id()).distinct().count() > 5
    q = {r["k"]: r["q"] for r in sums.quantiles(df, "v", [0, 0.05, 0.5, 0.99, 1], ["k"]).collect()}
    for k in {r[0] for r in rows} - {"empty"}:
        assert q[k] == pytest.approx(np.quantile([r[2] for r in rows if r[0] == k and r[2] is not None], [0, 0.05, 0.5, 0.99, 1]))
    assert "empty" not in q and sums.quantiles(df, "v", [0.5]).first()["q"][0] == pytest.approx(np.median([r[2] for r in rows if r[2] is not None]))
    assert sums.with_quantiles(df.groupBy("k").count(), df, "v", [0.5], ["k"]).where("k = 'empty'").first()["q"] is None
    assert sums.quantiles(df.where("false"), "v", [0.5], ["k"]).count() == 0
    found = df.groupBy("k").agg(F.count("*").alias("m"), F.max("n").alias("top")).where("k is not null")
    assert sums.lookup(df.where("k is not null"), found, ["k"], "m").count() == sum(r[0] is not None for r in rows)


def test_curves_of_one_group_in_many_ranges(spark, thirteen):
    """Continuous times of one group: the loop's curve, bounds, incidences and log-rank by strata."""
    rng = random.Random(4)
    rows = [(rng.choice([rng.random() * 9, float(rng.randint(1, 9))]), rng.choice([0, 1, 1, 2]), "all", rng.randint(0, 1), rng.randint(0, 2)) for _ in range(1500)] + [(20.0, 1, "all", 0, 0)]
    df = spark.createDataFrame(rows, "t double, c int, g string, a int, st int")
    km = {r["time"]: r for r in survival.km(df, "t", F.col("c") == 1, "g").collect()}
    aj = {r["time"]: r for r in survival.aalen_johansen(df, "t", "c", "g").collect()}
    alive, v, s, c1, c2 = 1.0, 0.0, 1.0, 0.0, 0.0
    for t in sorted({r[0] for r in rows}):
        n, d1, d2 = sum(r[0] >= t for r in rows), sum(r[0] == t and r[1] == 1 for r in rows), sum(r[0] == t and r[1] == 2 for r in rows)
        c1, c2, s = c1 + s * d1 / n, c2 + s * d2 / n, s * (1 - (d1 + d2) / n)
        if d1 + d2:
            assert (aj[t]["cif1"], aj[t]["cif2"], aj[t]["survival"]) == pytest.approx((c1, c2, s), abs=1e-9)
        if d1:
            alive *= 1 - d1 / n
            v += d1 / (n * (n - d1)) if n > d1 else 0
            assert (km[t]["at_risk"], km[t]["events"], km[t]["survival"]) == (n, d1, pytest.approx(alive, abs=1e-9))
            if 0 < alive < 1:
                half = 1.959963984540054 * math.sqrt(v) / abs(math.log(alive))
                assert (km[t]["low"], km[t]["high"]) == pytest.approx((alive ** math.exp(half), alive ** math.exp(-half)))
    assert len(km) == len({r[0] for r in rows if r[1] == 1}) and km[20.0]["survival"] == 0 and km[20.0]["low"] is None
    median = survival.survival_quantiles(survival.km(df, "t", F.col("c") == 1, "g"), [0.5]).first()
    assert median["time"] == min(t for t, r in km.items() if r["survival"] <= 0.5) and median["low"] <= median["time"] <= median["high"]
    o = e = var = 0.0
    for st in range(3):
        own = [r for r in rows if r[4] == st]
        for t in {r[0] for r in own if r[1] == 1}:
            n, n1, d, d1 = sum(r[0] >= t for r in own), sum(r[0] >= t and r[3] == 1 for r in own), sum(r[0] == t and r[1] == 1 for r in own), sum(r[0] == t and r[1] == 1 and r[3] == 1 for r in own)
            o, e = o + d1, e + d * n1 / n
            var += d * n1 / n * (1 - n1 / n) * (n - d) / (n - 1) if n > 1 else 0
    got = survival.logrank(df, "t", F.col("c") == 1, F.col("a") == 1, "st").first()
    assert (got["observed"], got["expected"], got["variance"], got["chi2"]) == pytest.approx((o, e, var, (o - e) ** 2 / var))
    w = {r["k"]: r["weight"] for r in survival.ipcw(df.withColumn("k", F.monotonically_increasing_id()), "k", "t", F.col("c") == 1).collect()}
    assert len(w) == len(rows)
    with pytest.raises(ValueError):
        survival.aft_weibull(df.withColumn("t", F.col("t") - 5), "t", F.col("c") == 1, ["a"])


def test_fills(spark):
    df = spark.createDataFrame([(1.0, "b"), (4.0, "a"), (None, "b"), (10.0, None), (11.0, "a")], "x double, s string")
    assert sorted(r["x"] for r in causal.impute(df, ["x"]).collect()) == [1, 4, 7, 10, 11]
    assert [r["s"] for r in causal.impute(df, ["s"], "mode").where("not s__measured").collect()] == ["a"]
    assert causal.impute(df, ["x", "s"], "complete_case").count() == 3


def test_scores(spark):
    df = spark.createDataFrame([(0.1, False), (0.2, False), (0.8, True), (0.9, True)], "p double, y boolean")
    assert features.auroc(df, "p", F.col("y")).first()["auroc"] == 1.0
    assert features.auroc(df, "p", ~F.col("y")).first()["auroc"] == 0.0
    assert features.auroc(df.withColumn("p", F.lit(0.5)), "p", F.col("y")).first()["auroc"] == 0.5


def test_point_scores_ignore_unknowns(spark):
    df = spark.createDataFrame([(39.0, 95.0, 25.0, None), (37.0, 80.0, 15.0, 8.0)], "t double, h double, r double, w double")
    assert [r[0] for r in df.select(phenotypes.sirs(*map(F.col, "thrw"))).collect()] == [3, 0]


def test_assertion_window(spark):
    df = spark.createDataFrame([(1, "no a b c d e fever"), (2, "no a b c d e f fever"), (3, "Fever.")], "d int, t string")
    got = {r["d"]: r["assertion"] for r in text.extract_concepts(df, "d", "t", {"fever": "fever"}, {"no": "negated"}).collect()}
    assert got == {1: "negated", 2: "affirmed", 3: "affirmed"}


def test_sections_offsets(spark):
    doc = "intro <h1>Title</h1> body <h2>Next</h2> end"
    rows = text.sections(spark.createDataFrame([(1, doc)], "d int, t string"), "d", "t", r"<(h\d)>").orderBy("ordinal").collect()
    assert [(r["name"], r["char_start"]) for r in rows] == [("h1", doc.index("<h1>")), ("h2", doc.index("<h2>"))]
    assert rows[0]["char_end"] == rows[1]["char_start"] and rows[1]["char_end"] == len(doc)


def test_checks_find_planted_defects(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None), (3, None)], "id int, p int")
    parent = spark.createDataFrame([(1,)], "p int")
    assert ch.check_fk(child, "c", ["p"], parent, ["p"]).first()["n_affected"] == 1
    assert ch.check_unique(child, "c", ["id"]).first()["n_affected"] == 1
    assert ch.check_exactly_one(child, "c", ["p"], parent, ["p"]).first()["n_affected"] == 3


def test_materialized_definition_is_kept(spark, tmp_path):
    base = spark.createDataFrame([(1, 1, 5), (2, 1, 7)], "g int, s int, x int")
    spec = cohorts.CohortSpec("c", 1, "g", "s", [cohorts.Criterion("x", F.col("x") > 5)])
    cohorts.materialize_cohort(cohorts.compile_cohort(base, spec), spec, str(tmp_path / "c"))
    other = cohorts.CohortSpec("c", 1, "g", "s", [cohorts.Criterion("y", F.col("x") > 6)])
    with pytest.raises(ValueError):
        cohorts.materialize_cohort(base, other, str(tmp_path / "c"))


def test_distributions():
    assert math.isclose(dist.chi2_sf(3.841458820694124, 1), 0.05, rel_tol=1e-9)
    assert math.isclose(dist.t_sf2(2.2281388519649385, 10), 0.05, rel_tol=1e-9)
    low, high = dist.binomial_exact(3, 10)
    assert math.isclose(low, 0.06673951117773447, rel_tol=1e-8) and math.isclose(high, 0.6524528500599972, rel_tol=1e-8)
    assert math.isclose(dist.poisson_exact(0)[1], 3.688879454113936, rel_tol=1e-9)


def test_parse_value(spark):
    df = spark.createDataFrame([("<0.01",), ("1-2",), ("120/80",), ("7",), ("abc",), (None,)], "v string")
    got = [r[0] and (r[0]["kind"], r[0]["low"], r[0]["high"]) for r in df.select(ts.parse_value(F.col("v"))).collect()]
    assert got == [("bound", 0.01, 0.01), ("range", 1.0, 2.0), ("pair", 120.0, 80.0), ("number", 7.0, 7.0), ("text", None, None), None]


def test_chained_equations_keep_what_is_known(spark):
    df = spark.range(200).selectExpr("id", "if(id % 4 = 0, null, id * 2.0D + 1) as a", "cast(id as double) as x")
    got = causal.mice(df, "id", ["a"], ["x"], 2, 2).collect()
    assert len(got) == 400 and all(r["a"] is not None for r in got)
    assert all(abs(r["a"] - (2 * r["x"] + 1)) < 1e-6 for r in got)  # the relation is exact, so is the fill


def test_neighbour_searches_answer_every_query(spark, sf, duck):
    from conftest import same

    from strandline.plans import registry

    registry.load_all()
    for name in ("r13_similar_units", "r13b_similar_units_all", "t6_neighbour_agreement", "t6b_neighbour_agreement_all"):
        assert "vec_id % 20 = 0" in registry.oracle_sql()[name]
        same(registry.queries()[name](spark, sf).toPandas(), duck.sql(registry.oracle_sql()[name]).df())
    base = spark.createDataFrame([(n, [float(n % 7 + 1), float(n % 11), 1.0], n) for n in range(300)], "u long, x array<float>, y int").repartition(5)
    assert features.neighbour_profile(base, base, "u", "x", F.col("y"), 5).where("n = 5").count() == 300
    near = lambda per: {(r["query"], r["_u"], r["_s"]) for r in features.nearest(base, base, "u", "x", F.col("y"), 5, per).collect()}
    assert len(near(50)) == 1500 and near(50) == near(8192)
    odd = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 2), (3, None, 3), (4, [0.0, 0.0], 4), (5, [1.0], 5), (6, [0.6, 0.8], 6), (1, [1.0, 0.0], 7)], "u long, x array<double>, y int")
    got = [(r["_u"], r["_s"]) for r in features.nearest(odd, odd.where("u = 1"), "u", "x", F.col("y"), 4).orderBy(F.desc("_s"), "_u").collect()]
    assert [u for u, _ in got] == [2, 6, 3, 4] and got[0][1] == 1.0 and got[2][1] is None
