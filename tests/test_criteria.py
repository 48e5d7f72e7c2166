"""Urine criteria, matrices, committed buckets, sequence channels, linkage and refits against loops and known answers on small rows."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

T0 = datetime(2024, 1, 1)


def test_urine_criteria_are_those_of_a_loop(spark):
    from strandline.operators import phenotypes as p

    rng = random.Random(4)
    rows, t = [], {u: 0.0 for u in range(6)}
    for _ in range(240):
        u = rng.randrange(6)
        t[u] += rng.choice([1.0, 2.0, 3.5, 6.0])
        rows.append((u, T0 + timedelta(hours=t[u]), rng.choice([0.0, 0.0, 10.0, 40.0, 400.0]), 50.37 + u))  # an odd weight keeps rates off the limits, where sums differ in the last digit
    rows += [(9, T0, 5.0, 60.0), (9, None, 5.0, 60.0), (9, T0 + timedelta(hours=9), 5.0, None), (9, T0 + timedelta(hours=8), None, 60.0), (9, T0, 1.0, 60.0)]
    df = spark.createDataFrame(rows, "u int, t timestamp_ntz, ml double, kg double").repartition(4)
    got = {(r["u"], r["t"]): r["stage"] for r in p.urine_stage(df, "u", "t", "ml", "kg").collect()}
    want = {}
    for u in {r[0] for r in rows}:
        at = {}
        for _, when, ml, kg in (r for r in rows if r[0] == u and None not in r):
            at[when] = at.get(when, 0) + ml / kg
        times = sorted(at)
        for k, now in enumerate(times):
            rate = {}
            for h in (6, 12, 24):
                inside = [j for j in range(1, k + 1) if now - times[j] < timedelta(hours=h)]
                seen = sum((times[j] - times[j - 1]).total_seconds() / 3600 for j in inside)
                rate[h] = sum(at[times[j]] for j in inside) / seen if seen >= h else math.inf
            want[u, now] = 3 if rate[24] < 0.3 or rate[12] == 0 else 2 if rate[12] < 0.5 else 1 if rate[6] < 0.5 else 0
    assert got == want and set(got.values()) == {0, 1, 2, 3}


def test_ratio_over_a_minimum_of_zero(spark):
    """over zero the ratio is infinite, 0 over 0 is NaN, which counts as the largest: both are stage 3, as in the SQL."""
    from strandline.operators import phenotypes as p

    df = spark.createDataFrame([(1, T0 + timedelta(hours=h), v) for h, v in ((0, 1.0), (1, 0.0), (2, 0.2), (3, None), (300, 0.2))], "u int, t timestamp_ntz, x double")
    assert [r["stage"] for r in p.kdigo_stage(df, "u", "t", "x").orderBy("t").collect()] == [0, 3, 3, 0, 0]
    dry = df.select("u", "t", F.lit(0).alias("stage")).where("false")
    assert [r["stage"] for r in p.injury_stage(p.kdigo_stage(df, "u", "t", "x"), dry, "u", "t").orderBy("t").collect()] == [0, 3, 3, 3, 0]
    ratios = [r["r"] for r in df.select("t", p.ratio_to_rolling_min(df, "u", "t", "x", 168).alias("r")).orderBy("t").collect()]
    assert ratios[0] == 1 and math.isnan(ratios[1]) and ratios[2:] == [math.inf, None, 1]


def test_ratio_over_a_negative_zero(spark):
    """a zero's sign counts, so 1 over -0.0 is below every limit of the stages, as in the SQL."""
    from strandline.operators import phenotypes as p

    df = spark.createDataFrame([(1, T0 + timedelta(hours=h), v) for h, v in ((0, 1.0), (1, -0.0), (60, 0.2), (300, -3.0))], "u int, t timestamp_ntz, x double")
    stages = p.kdigo_stage(df, "u", "t", "x")
    assert [r["stage"] for r in stages.orderBy("t").collect()] == [0, 3, 0, 0]
    assert [r["stage"] for r in p.injury_stage(stages, stages.where("false"), "u", "t").orderBy("t").collect()] == [0, 3, 0, 0]
    pairs = spark.createDataFrame([(k, *x) for k, x in enumerate([(1.0, -0.0), (-1.0, -0.0), (-1.0, 0.0), (math.inf, -0.0), (0.0, -0.0), (math.nan, 0.0), (None, 0.0), (1.0, None), (-0.0, 2.0)])], "k int, x double, y double")
    got = [r["q"] for r in pairs.select("k", p.over(F.col("x"), F.col("y")).alias("q")).orderBy("k").collect()]
    assert got[:4] == [-math.inf, math.inf, -math.inf, -math.inf] and all(math.isnan(q) for q in got[4:6]) and got[6:8] == [None, None] and math.copysign(1, got[8]) == -1


def test_worse_of_two_stages_is_carried(spark):
    from strandline.operators import phenotypes as p

    mk = lambda rows: spark.createDataFrame([(1, T0 + timedelta(hours=h), s) for h, s in rows], "u int, t timestamp_ntz, stage int")
    got = p.injury_stage(mk([(0, 0), (2, 2), (30, 1)]), mk([(1, 1), (2, 1), (8, 0), (9, 0)]), "u", "t").collect()
    assert {(r["t"] - T0).total_seconds() / 3600: r["stage"] for r in got} == {0: 0, 1: 1, 2: 2, 8: 2, 9: 0, 30: 1}


def test_matrices_by_hand(spark):
    from strandline.operators import phenotypes as p

    row = lambda *x: [F.lit(v).cast("double") for v in x]
    ask = lambda c: spark.range(1).select(c.alias("c")).first()["c"]
    assert [ask(p.acid_base_points(*row(*x))) for x in ((7.1, 40), (7.1, 60), (7.25, 35), (7.4, 40), (7.47, 50), (7.7, 20), (None, 40), (7.1, None))] == [12, 4, 6, 0, 12, 0, 0, 0]
    breath = lambda pao2, paco2, fio2, v: ask(p.oxygenation_points(*row(pao2, paco2, fio2), F.lit(v).cast("boolean")))
    assert [breath(60, 40, 0.3, True), breath(60, 40, 1.0, True), breath(60, 40, 1.0, False), breath(60, 40, 1.0, None), breath(None, 40, 1.0, True), breath(None, 40, 0.2, False)] == [5, 14, 5, 5, 0, 0]
    assert [ask(p.nervous_points(*row(*x))) for x in ((4, 5, 6), (1, 1, 1), (1, 1, 4), (1, 1, 6), (3, 4, 5), (3, 2, 6), (None, 1, 1), (4, None, 6), (4, 5, None))] == [0, 48, 33, 16, 8, 10, 0, 0, 0]


def test_codes_meet_the_prefixes_of_their_own_system(spark):
    from strandline.operators import phenotypes as p

    sets = spark.createDataFrame([("mi", 9, "410"), ("mi", 10, "I21"), ("dm", 9, "250.0"), ("dm", 10, "e11"), ("none", 9, "")], "group string, system int, prefix string")
    dx = spark.createDataFrame([(1, "410.01", 9), (1, "4100", 9), (1, "25001", 9), (2, "i21.4", 10), (3, "I21", 9), (4, None, 9), (5, "410", None), (6, "E1", 10)], "h int, code string, system int")
    got = sorted((r["h"], r["group"]) for r in p.dual_groups(dx, "h", "code", "system", sets).collect())
    assert got == [(1, "dm"), (1, "mi"), (2, "mi")]
    assert p.dual_groups(dx, "h", "code", "system", sets.limit(0)).count() == 0


def test_a_broken_load_goes_on_from_its_commits(spark, tmp_path, monkeypatch):
    from strandline.sources import tables as src

    df = spark.range(500).select((F.col("id") * 3).alias("k"), "id")
    path = str(tmp_path / "t")
    real, n = src.commits, []
    calls = {"left": 2}
    make = type(spark).createDataFrame

    def breaks(self, data, schema=None, *a, **kw):
        if schema == src.COMMIT and data:
            if not calls["left"]:
                raise RuntimeError("lost")
            calls["left"] -= 1
        return make(self, data, schema, *a, **kw)

    monkeypatch.setattr(type(spark), "createDataFrame", breaks)
    with pytest.raises(RuntimeError):
        src.write_committed(df, "k", path, "run 1", buckets=10, sweep=3)
    monkeypatch.undo()
    assert sorted(r["bucket"] for r in real(spark, path).collect()) == [0, 1, 2, 3, 4, 5]
    assert src.read_committed(spark, path, [0, 1]).count() == 100
    with pytest.raises(ValueError, match="not committed"):
        src.read_committed(spark, path, [5, 6])
    with pytest.raises(ValueError, match="holds run 1"):
        src.write_committed(df, "k", path, "run 2", buckets=10)
    n = src.write_committed(df, "k", path, "run 1", buckets=10)
    assert n == [6, 7, 8, 9] and src.write_committed(df, "k", path, "run 1", buckets=10) == []
    assert src.read_committed(spark, path, list(range(10))).count() == 500 == spark.read.parquet(path).count()
    few = str(tmp_path / "few")  # buckets that no row has are committed as empty
    src.write_committed(df.where("k % 10 = 1"), "k", few, "run 1", buckets=10)
    assert {r["bucket"]: r["n_rows"] for r in src.commits(spark, few).collect()} == {b: 50 if b == 1 else 0 for b in range(10)}
    with pytest.raises(ValueError, match="rows without k"):
        src.write_committed(df.select(F.when(F.col("id") > 3, F.col("k")).alias("k"), "id"), "k", str(tmp_path / "n"), "run 1", buckets=10)


def test_channels_are_scaled_by_the_training_rows(spark):
    from strandline.operators import features as f

    rows = [(1, 0, None, 5.0, 1), (1, 1, 2.0, 5.0, 1), (1, 2, None, None, 1), (1, 3, 4.0, float("nan"), 1), (2, 0, 9.0, 7.0, 0), (2, 1, None, None, 0), (2, 2, None, None, 0), (2, 3, None, None, 0)]
    df = spark.createDataFrame(rows, "u int, bin int, a double, b double, train int").repartition(3)
    got = {r["u"]: r for r in f.sequence_channels(df, "u", "bin", ["a", "b"], F.col("train") == 1).collect()}
    s = math.sqrt(2)
    assert got[1]["a"]["values"] == pytest.approx([0, -1 / s, -1 / s, 1 / s]) and got[1]["a"]["mask"] == [0, 1, 0, 1] and got[1]["a"]["since"] == [-1, 0, 1, 0]
    assert got[2]["a"]["values"] == pytest.approx([6 / s] * 4) and got[2]["a"]["since"] == [0, 1, 2, 3]
    assert got[1]["b"]["values"] == got[2]["b"]["values"] == [0] * 4  # no spread in the training rows
    assert got[1]["b"]["mask"] == [1, 1, 0, 0]


def test_drugs_by_whole_words(spark):
    from strandline.operators import linkage as k

    stays = spark.createDataFrame([(1, T0), (2, T0), (3, None)], "s int, start timestamp_ntz")
    h = lambda n: T0 + timedelta(hours=n)
    meds = [(1, h(3), "Vancomycin 1,000 mg IV"), (1, h(1), "Vancomycinlike"), (1, h(2), "PIPERACILLIN-Tazobactam 4.5g"), (2, h(1), None), (2, h(2), "tazobactam"), (3, h(1), "vancomycin"), (8, h(1), "vancomycin")]
    df = spark.createDataFrame(meds, "s int, t timestamp_ntz, name string")
    got = {r["s"]: tuple(r)[1:] for r in k.drug_flags(stays, "s", "start", df, "t", "name", ["vancomycin", "Piperacillin  tazobactam"]).collect()}
    assert got == {1: (3, 2, 2.0), 2: (2, 0, None), 3: (1, 1, None)}
    assert {r["n_flagged"] for r in k.drug_flags(stays, "s", "start", df, "t", "name", []).collect()} == {0}


def test_triage_levels_and_bounds(spark):
    from strandline.operators import linkage as k

    df = spark.createDataFrame([(1, "2", "98.6"), (2, "7", "300"), (3, "x", None), (4, None, "warm")], "s int, level string, temp string")
    got = {r["s"]: (r["acuity"], r["temp"] and round(r["temp"], 6), r["implausible"]) for r in k.triage(df, ["s"], "level", {"temp": (5 / 9, -160 / 9, 30, 45)}).collect()}
    assert got == {1: (2, 37.0, 0), 2: (None, None, 1), 3: (None, None, 0), 4: (None, None, 0)}


def test_coverage_of_hot_and_null_keys(spark):
    from strandline.operators import linkage as k

    rows = [(1, 5)] * 90 + [(2, 6), (2, None), (3, 7), (None, 5)]
    core = spark.createDataFrame([(5,), (5,), (7,), (None,)], "k int")
    got = k.source_coverage(spark.createDataFrame(rows, "s int, k int"), "k", "s", core).first()
    assert tuple(got)[:4] == (94, 92, 3, 2) and got["row_share"] == 92 / 94
    none = k.source_coverage(spark.createDataFrame([], "s int, k int"), "k", "s", core).first()
    assert tuple(none) == (0, 0, 0, 0, None, None)


def test_refits_tell_that_a_sign_turned(spark):
    from strandline.operators import models

    rng = random.Random(5)
    rows = []
    for n in range(900):
        era, x = "abc"[n % 3], rng.gauss(0, 1)
        y = int((-x if era == "c" else x) + rng.gauss(0, 0.5) > 0)
        rows.append((n, era, x, y))
    rows += [(n, "d", 0.5, 1) for n in range(900, 940)] + [(1000, None, 1.0, 1)]
    df = spark.createDataFrame(rows, "n long, era string, x double, y int")
    got = {r["era"]: r for r in models.era_refits(df, ["x"], "y", "era", "n").collect()}
    assert got["c"]["auroc_own"] > 0.9 > 0.1 > got["c"]["auroc_others"] and got["a"]["auroc_own"] > 0.9 and got["a"]["auroc_mixed"] > 0.9
    assert got["d"]["auroc_own"] is None and got["d"]["auroc_mixed"] is None and set(got) == set("abcd")


def test_sizes_are_those_of_the_files(spark, tmp_path):
    from strandline.operators import profiling as p

    spark.range(1000).repartition(3).write.parquet(str(tmp_path / "a"))
    files = [f.stat().st_size for f in (tmp_path / "a").glob("part-*")]
    got = p.table_sizes(spark, {"a": str(tmp_path / "a")}).first()
    assert tuple(got) == ("a", 3, sum(files)) and len(files) == 3


def test_levels_of_columns_with_few_values(spark):
    from strandline.operators import profiling as p

    rows = [(n, "x" if n % 3 else "y", None if n % 2 else n % 8 // 2) for n in range(60)]
    df = spark.createDataFrame(rows, "id long, a string, b int").repartition(3)
    got = sorted((r["column"], r["rank"], r["level"], r["n"]) for r in p.level_counts(df, 50, 3).collect())
    assert got == [("a", 1, "x", 40), ("a", 2, "y", 20), ("b", 1, "0", 8), ("b", 2, "1", 8), ("b", 3, "2", 7)]
    assert p.level_counts(df.select("id"), 50, 3).count() == 0 == p.level_counts(df.limit(0), 50, 3).count()
