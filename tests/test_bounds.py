"""Steps whose tasks stay bounded while the tables grow."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import checks, disclosure, features, phenotypes, profiling, sums


def plan(df):
    return df._jdf.queryExecution().toString()


def test_keys_are_dealt_by_their_number(spark, monkeypatch):
    """both sides of a pair check lie in as many partitions as their rows ask for."""
    monkeypatch.setattr(sums, "TASK", 10)
    rows = [(k % 13, k % 7) for k in range(95)] + [(None, 1), (1, None)]
    df, parent = spark.createDataFrame(rows, "a int, b int"), spark.createDataFrame([(k % 13, k % 7) for k in range(40)], "a int, b int")
    got = checks.check_pair(df, "t", ["a", "b"], parent, ["a", "b"])
    assert tuple(got.first())[3:5] == (len({(k % 13, k % 7) for k in range(95)} - {(k % 13, k % 7) for k in range(40)}), 91)
    assert plan(got).count("REPARTITION_BY_NUM") >= 2 and ", 10), REPARTITION_BY_NUM" in plan(got)


def test_exact_profiles_buffer_no_column(spark):
    """F8: quantiles are read off at running counts, distinct values are counted column by column."""
    rng = np.random.default_rng(4)
    x = [None if k % 10 == 0 else float(v) for k, v in enumerate(rng.integers(0, 40, 500) / 8)]
    rows = [(k, v, f"s{k % 3}", None) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, x double, s string, e int").repartition(3)
    got = profiling.profile_columns(df, ("id",), exact=True)
    assert "percentile" not in plan(got).lower()
    by = {r["column"]: r for r in got.collect()}
    known = [v for v in x if v is not None]
    assert [by["x"][q] for q in ("p01", "p50", "p99")] == pytest.approx(list(np.quantile(known, [0.01, 0.5, 0.99])))
    assert {c: (r["n_rows"], r["n_null"], r["n_distinct"]) for c, r in by.items()} == {"id": (500, 0, 500), "x": (500, 50, len(set(known))), "s": (500, 0, 3), "e": (500, 500, 0)}
    assert by["e"]["p50"] is None and by["id"]["p50"] is None and (by["s"]["low"], by["s"]["high"], by["id"]["low"]) == ("s0", "s2", None)


def test_groups_are_dealt_by_their_number(spark, monkeypatch):
    """codes meet the sets once each, and the pairs found lie in as many partitions as they ask for."""
    monkeypatch.setattr(sums, "TASK", 8)
    dx = spark.createDataFrame([(k % 20, ("a.1", "A2", "b", None)[k % 4], 9 + k % 2) for k in range(100)], "h int, code string, system int")
    sets = spark.createDataFrame([("one", 9, "A"), ("two", 9, "a1"), ("three", 10, "a.2")], "group string, system int, prefix string")
    got = phenotypes.dual_groups(dx, "h", "code", "system", sets)
    want = {(k % 20, g) for k in range(100) for g in {0: ("one", "two"), 1: ("three",)}.get(k % 4, ())}
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert ", 10), REPARTITION_BY_NUM" in plan(got)  # 75 pairs


def test_spine_joins_are_dealt_by_their_number(spark, sf, monkeypatch):
    """what follows the join has as many tasks as lineitem asks for."""
    from strandline.plans.q_timeline import g7
    from strandline.sources.tables import load

    monkeypatch.setattr(sums, "TASK", 1000)
    assert f", {load(spark, sf, 'lineitem').count() // 1000 + 1}), REPARTITION_BY_NUM" in plan(g7(spark, sf))


def test_pair_rules_count_pairs_alone(spark, monkeypatch):
    """no item sets of more than two items are mined; rare items and null ones make no pairs."""
    import pyspark.ml.fpm

    monkeypatch.setattr(pyspark.ml.fpm, "FPGrowth", None)
    rng = np.random.default_rng(5)
    baskets = {k: {f"i{j}" for j in rng.integers(0, 6, 4)} | ({"rare"} if k < 2 else set()) for k in range(60)}
    rows = [(k, i) for k, items in baskets.items() for i in items for _ in range(2)] + [(99, None), (1, None)]
    got = {(r["antecedent"], r["consequent"]): (r["n"], r["confidence"], r["lift"]) for r in features.pair_rules(spark.createDataFrame(rows, "k int, i string"), "k", "i", 12).collect()}
    one = {i: sum(i in b for b in baskets.values()) for i in {x for b in baskets.values() for x in b}}
    two = {(a, c): sum(a in b and c in b for b in baskets.values()) for a, c in itertools.permutations(one, 2)}
    want = {(a, c): (n, n / one[a], n / one[a] / (one[c] / 61)) for (a, c), n in two.items() if n >= 12}
    assert set(got) == set(want) and want and all(got[k] == pytest.approx(want[k]) for k in want)


def test_vocabulary_counts_before_it_shuffles(spark):
    """texts of one row need no distinct pairs; texts of several rows count once a term."""
    rows = [(k, f"s{k % 3}", f"Common word{k % 2} 12345 ___ {k}") for k in range(12)]
    more = [(3, "s0", "common other"), (3, "s9", "Other"), (None, "s1", "common other"), (20, None, "other"), (21, "s1", None)]
    ask = lambda r, n, m: disclosure.filter_vocabulary(spark.createDataFrame(r, "d long, s string, t string"), "d", "s", "t", n, m)
    once = ask(rows, 2, 2)
    assert "Expand" not in plan(once) and sorted(map(tuple, once.collect())) == [("common", 12, 3), ("word0", 6, 3), ("word1", 6, 3)]
    assert sorted(map(tuple, ask(rows + more, 2, 3).collect())) == [("common", 12, 3), ("other", 2, 3), ("word0", 6, 3), ("word1", 6, 3)]
