"""Queries over assessment, likelihood models, criteria, scores by bands, validation plans and audits (rows of survey 2.8 to 2.20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import assess as a
from strandline.operators import causal as ca
from strandline.operators import cohorts as co
from strandline.operators import explore as x
from strandline.operators import features as f
from strandline.operators import models as m
from strandline.operators import pathways as y
from strandline.operators import phenotypes as p
from strandline.operators import regress as r
from strandline.operators import survival as s
from strandline.operators import text as tx
from strandline.plans.q_cohorts import ROLL
from strandline.plans.q_explore import GRID, TTE, WIDE, grid, tte, wide
from strandline.plans.q_features import SC, scored
from strandline.plans.q_inference import PSQ, ev, surv, treated
from strandline.plans.q_models import parts
from strandline.plans.q_temporal import ENC, encounters
from strandline.plans.q_timeline import rounded
from strandline.plans.registry import query
from strandline.sources import tables as src
from strandline.sources.tables import load

Z = "1.959963984540054::DOUBLE"


@query("a3b_reject_report", "WITH r AS (SELECT CASE WHEN event_id % 7 = 0 THEN 'x' ELSE '' END || json_extract_string(props, '$.k') AS k FROM events) SELECT 'k' AS \"column\", count(*) AS n FROM r WHERE k IS NOT NULL AND try_cast(k AS INT) IS NULL")
def a3b(spark, sf):
    from strandline.plans.q_tables import T, _raw

    spec = src.TableSpec("props", T.StructType.fromDDL("event_id bigint, k int"))
    raw = load(spark, sf, "events").select(F.col("event_id").cast("string").alias("event_id"), _raw().alias("k"))
    return src.reject_report(src.split_rejects(raw, spec, max_rejects=10**9)[1])


@query("a7b_text_inventory", "SELECT count(*)::BIGINT + 1 AS n_lines, true AS header_ok FROM nation")
def a7b(spark, sf):
    path = src.scratch(spark, "csv")
    src.write_contract(load(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey").coalesce(1), path)
    return src.text_inventory(spark, path, "n_nationkey,n_name,n_regionkey").select("n_lines", "header_ok")


#: Measures that the events stand for, each a function of value and event_id: by Spark and DuckDB alike.
MEASURES = {
    "pao2_fio2": "value * 3", "ventilated": "event_id % 2 = 0", "platelets": "value * 2", "bilirubin": "value / 20", "pressure": "value + 20", "dopamine": "CASE WHEN event_id % 5 = 0 THEN event_id % 20 ELSE NULL END",
    "epinephrine": "CASE WHEN event_id % 7 = 0 THEN (event_id % 30) / 100.0 ELSE NULL END", "norepinephrine": "CASE WHEN event_id % 11 = 0 THEN (event_id % 40) / 200.0 ELSE NULL END", "gcs": "3 + event_id % 13", "creatinine": "value / 50", "urine_day": "value * 8",
}


def _band(v, cuts, points):
    return f"CASE WHEN {v} IS NULL THEN 0 " + " ".join(f"WHEN {v} >= {c} THEN {n}" for c, n in reversed(list(zip(cuts, points[1:], strict=True)))) + f" ELSE {points[0]} END"


_O = {k: _band(k, *v) for k, v in p.ORGANS.items()}
_FLOW = "CASE WHEN coalesce(dopamine, 0) > 15 OR v > 0.1 THEN 4 WHEN coalesce(dopamine, 0) > 5 OR v > 0 THEN 3 WHEN coalesce(dopamine, 0) > 0 THEN 2 WHEN pressure < 70 THEN 1 ELSE 0 END"
_URINE = "CASE WHEN urine_day < 200 THEN 4 WHEN urine_day < 500 THEN 3 ELSE 0 END"
ORGAN_SQL = f"""o AS (SELECT event_id, user_id, ts, CASE WHEN ventilated THEN {_O['pao2_fio2']} ELSE least({_O['pao2_fio2']}, 2) END AS respiration, {_O['platelets']} AS coagulation, {_O['bilirubin']} AS liver, {_FLOW} AS circulation, {_O['gcs']} AS nervous, greatest({_O['creatinine']}, {_URINE}) AS kidneys
FROM (SELECT *, greatest(coalesce(epinephrine, 0), coalesce(norepinephrine, 0)) AS v FROM (SELECT event_id, user_id, ts, {', '.join(f'({e}) AS {k}' for k, e in MEASURES.items())} FROM events)))"""
SIX = ["respiration", "coagulation", "liver", "circulation", "nervous", "kidneys"]


def organs(spark, sf):
    e = load(spark, sf, "events").selectExpr("event_id", "user_id", "ts", *[f"{v} AS {k}" for k, v in MEASURES.items()])
    points = p.organ_points(*[F.col(k).cast("double") if k != "ventilated" else F.col(k) for k in MEASURES])
    return e.select("event_id", "user_id", "ts", *[c.cast("int").alias(k) for k, c in points.items()])


@query("h11c_organ_points", f"WITH {ORGAN_SQL} SELECT event_id, {', '.join(f'({k})::INT AS {k}' for k in SIX)} FROM o")
def h11c(spark, sf):
    return organs(spark, sf).drop("user_id", "ts")


@query("h11d_organ_score_24h", f"WITH {ORGAN_SQL} SELECT event_id, ({' + '.join(f'max({k}) OVER q' for k in SIX)})::INT AS score FROM o {ROLL.format(24)}")
def h11d(spark, sf):
    return p.worst_score_24h(organs(spark, sf), "user_id", "ts", SIX).select("event_id", F.col("score").cast("int").alias("score"))


_PHYS = {"heart_rate": "value", "pressure": "value + 20", "temperature": "30 + event_id % 12", "resp_rate": "event_id % 60", "hematocrit": "event_id % 55", "wbc": "value / 10", "creatinine": "value / 50", "urine_day": "value * 20", "bun": "value", "sodium": "100 + event_id % 70", "albumin": "(event_id % 60) / 10.0", "bilirubin": "value / 20", "glucose": "CASE WHEN event_id % 3 > 0 THEN value * 2 ELSE NULL END"}


@query("h16b_physiology_points", "SELECT event_id, (" + " + ".join(f"({_band(f'({_PHYS[k]})', *v)})" for k, v in p.PHYSIOLOGY.items()) + ")::INT AS points FROM events")
def h16b(spark, sf):
    return load(spark, sf, "events").select("event_id", p.physiology_points({k: F.expr(e).cast("double") for k, e in _PHYS.items()}).cast("int").alias("points"))


@query("i2b_demographic", f"WITH {ENC} SELECT hadm FROM enc WHERE price >= 50000 AND price < 200000 AND priority IN ('1-URGENT', '2-HIGH')")
def i2b(spark, sf):
    return encounters(spark, sf).where(co.demographic(50000, 200000, "price", {"priority": ("1-URGENT", "2-HIGH")})).select("hadm")


@query("i2c_data_available", "WITH b AS (SELECT user_id, min(ts) AS t FROM events GROUP BY 1) SELECT b.user_id FROM b JOIN events e ON b.user_id = e.user_id AND e.ts <= b.t + INTERVAL 120 HOUR AND e.event_type IN ('click', 'view') GROUP BY 1 HAVING count(*) FILTER (event_type = 'click') >= 2 AND count(*) FILTER (event_type = 'view') >= 2")
def i2c(spark, sf):
    e = load(spark, sf, "events")
    b = e.groupBy("user_id").agg(F.min("ts").alias("t")).withColumn("unit", F.col("user_id"))
    return co.data_available(b, "unit", "user_id", "t", e, "ts", "event_type", ["click", "view"], 120, 2).select(F.col("unit").alias("user_id"))


@query("i2d_prior_admissions", f"WITH {ENC} SELECT hadm, (row_number() OVER (PARTITION BY subject ORDER BY start, hadm) - 1)::INT AS n_prior FROM enc")
def i2d(spark, sf):
    return encounters(spark, sf).select("hadm", co.prior_admissions("subject", "start", "hadm").cast("int").alias("n_prior"))


@query("j3b_exact_intervals")
def j3b(spark, sf):
    t = load(spark, sf, "lineitem").groupBy("l_linenumber").agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("x"))
    t = t.withColumn("b", x.ci_exact("x", "n")).withColumn("c", x.ci_exact_count("x"))
    return t.select("l_linenumber", F.round("b.low", 6).alias("low"), F.round("b.high", 6).alias("high"), F.round("c.low", 3).alias("count_low"), F.round("c.high", 3).alias("count_high"))


@query("j6d_missing_profile", f"WITH {WIDE} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS n, count(*) FILTER (w.{c} IS NULL) AS missing, round(count(*) FILTER (w.{c} IS NULL) / count(*), 6) AS share, count(DISTINCT w.{c}) AS n_distinct FROM w" for c in "abc"))
def j6d(spark, sf):
    return rounded(x.missing_profile(wide(spark, sf), ["a", "b", "c"]), "share")


@query("m2c_rolling_median", "SELECT event_id, round(quantile_cont(value, 0.5) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS smooth FROM events")
def m2c(spark, sf):
    return load(spark, sf, "events").select("event_id", F.round(y.rolling_median(["user_id"], ["ts", "event_id"], "value", 5), 6).alias("smooth"))


@query("m4b_rolling_origin_units", GRID + """, z AS (SELECT * FROM lin WHERE filled IS NOT NULL), o AS (SELECT user_id, bin, filled AS l, avg(filled) OVER q AS m, (filled - first_value(filled) OVER q) / nullif(bin - first_value(bin) OVER q, 0) AS s FROM z WINDOW q AS (PARTITION BY user_id ORDER BY bin ROWS UNBOUNDED PRECEDING)),
j AS (SELECT o.*, k AS h, z.filled AS y, w.filled AS sea FROM o CROSS JOIN range(1, 4) r(k) JOIN z ON z.user_id = o.user_id AND z.bin = o.bin + k LEFT JOIN z w ON w.user_id = o.user_id AND w.bin = o.bin + k - 2 * ceil(k / 2)::BIGINT WHERE o.bin >= 0 AND o.bin % 2 = 0),
fc AS (SELECT user_id, y, 'naive' AS model, l AS f FROM j UNION ALL SELECT user_id, y, 'seasonal', sea FROM j UNION ALL SELECT user_id, y, 'mean', m FROM j UNION ALL SELECT user_id, y, 'drift', l + s * h FROM j), p AS (SELECT user_id, model, avg(abs(y - f)) AS mae FROM fc WHERE f IS NOT NULL GROUP BY 1, 2),
d AS (SELECT user_id, abs(filled - lag(filled) OVER (PARTITION BY user_id ORDER BY bin)) AS d FROM z), sc AS (SELECT user_id, avg(d) AS s FROM d GROUP BY 1) SELECT model, count(*) AS units, round(quantile_cont(mae, 0.5), 4) AS mae, round(quantile_cont(mae / nullif(s, 0), 0.5), 4) AS mase FROM p JOIN sc USING (user_id) GROUP BY 1""")
def m4b(spark, sf):
    g = y.fill_series(grid(spark, sf), ["user_id"], "bin", "mean", "linear").where("filled is not null").select("user_id", "bin", "filled")
    return rounded(y.rolling_origin_units(g, "user_id", "bin", "filled", 0, 2, 3, 2), "mae", "mase", to=4)


@query("n9b_bootstrap_intervals")
def n9b(spark, sf):
    return rounded(a.bootstrap_intervals(ev(spark, sf), "user_id", F.col("value"), F.lit(1), 100), "estimate", "low", "high", to=4)


@query("o3b_ordinal_logit")
def o3b(spark, sf):
    d = parts(spark, sf)[0].withColumn("grade", F.least(F.floor(F.col("price") / 1.5 + F.col("k") / 20), F.lit(2)).cast("int"))
    return rounded(r.ordinal_logit(d, "grade", ["k"], 3), "coefficient", "se", to=3)


@query("o3c_negative_binomial")
def o3c(spark, sf):
    n = load(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.avg(F.col("o_totalprice") / 1e5).alias("price"))
    return rounded(r.negative_binomial(n, "n", ["price"]), "coefficient", "se", to=3)


@query("o5b_predict_curve", "SELECT v AS x, count(*) AS n, round(avg(1 / (1 + exp(-(v / 100 - o_totalprice / 200000)))), 6) AS mean FROM orders, (SELECT unnest([0.0::DOUBLE, 100.0, 250.0]) AS v) GROUP BY 1")
def o5b(spark, sf):
    d = load(spark, sf, "orders").select("o_totalprice", F.lit(0.0).alias("dose"))
    return rounded(r.predict_curve(d, lambda t: t.withColumn("p", 1 / (1 + F.exp(-(F.col("dose") / 100 - F.col("o_totalprice") / 200000)))), "dose", [0, 100, 250]), "mean")


@query("o6b_vif", "SELECT unnest(['l_quantity', 'l_extendedprice']) AS variable, round(1 / (1 - pow(corr(l_quantity, l_extendedprice), 2)), 4) AS vif FROM lineitem")
def o6b(spark, sf):
    return rounded(r.vif(load(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"]), "vif", to=4)


@query("o6c_dispersion", f"WITH {SC} SELECT count(*) AS n, round(sum((y::INT - p) * (y::INT - p) / (p * (1 - p))), 3) AS pearson, round(sum((y::INT - p) * (y::INT - p) / (p * (1 - p))) / (count(*) - 2), 6) AS ratio FROM sc")
def o6c(spark, sf):
    q = F.col("p")
    return rounded(rounded(r.dispersion(scored(spark, sf), F.col("y").cast("int"), q, q * (1 - q), 2), "pearson", to=3), "ratio")


@query("o6d_influence", """WITH m AS (SELECT count(*) AS n, avg(l_quantity) AS mx, var_pop(l_quantity) * count(*) AS sxx, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem), e AS (SELECT l_extendedprice - a - b * l_quantity AS e, 1.0::DOUBLE / n + (l_quantity - mx) * (l_quantity - mx) / sxx AS h, n FROM lineitem, m), s AS (SELECT sum(e * e) / (any_value(n) - 2) AS s2 FROM e)
SELECT count(*) AS n, round(sum(h), 4) AS leverage, count(*) FILTER (e * e * h / (2 * s2 * (1 - h) * (1 - h)) > 4.0::DOUBLE / n) AS influential FROM e, s""")
def o6d(spark, sf):
    d = r.influence(load(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity"], ["l_orderkey", "l_linenumber"])
    n = d.count()
    return rounded(d.agg(F.count("*").alias("n"), F.sum("leverage").alias("leverage"), F.count_if(F.col("cook") > 4.0 / n).alias("influential")), "leverage", to=4)


def spells(spark, sf):
    """Counting-process rows: each user's follow-up cut at day 3, with what holds then."""
    d = surv(spark, sf).where("days > 0").withColumn("x", F.pmod(F.col("user_id"), F.lit(7)).cast("double")).withColumn("st", F.pmod(F.col("user_id"), F.lit(3)))
    early = d.select("user_id", "grp", "st", F.lit(0.0).alias("a"), F.least("days", F.lit(3.0)).alias("z"), ((F.col("code") == 1) & (F.col("days") <= 3)).alias("e"), "x")
    late = d.where("days > 3").select("user_id", "grp", "st", F.lit(3.0).alias("a"), F.col("days").alias("z"), (F.col("code") == 1).alias("e"), (F.col("x") + 1).alias("x"))
    return early.unionByName(late)


@query("p5b_cox_counting")
def p5b(spark, sf):
    return rounded(r.cox_counting(spells(spark, sf), "a", "z", F.col("e"), ["grp", "x"], "st", "user_id"), "beta", "se", "robust_se")


@query("p9b_stabilized_ipcw", f"""WITH {TTE}, c AS (SELECT (user_id % 2)::INT AS g, days AS time, count(*) FILTER (code <> 1) AS c, count(*) AS k FROM tte GROUP BY 1, 2), r AS (SELECT *, sum(k) OVER (PARTITION BY g ORDER BY time DESC) AS n FROM c), k1 AS (SELECT g, time, coalesce(sum(CASE WHEN n > c THEN -ln(1 - c / n) ELSE 700 END) OVER (PARTITION BY g ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM r),
c0 AS (SELECT time, sum(c) AS c, sum(k) AS k FROM c GROUP BY 1), r0 AS (SELECT *, sum(k) OVER (ORDER BY time DESC) AS n FROM c0), k0 AS (SELECT time, coalesce(sum(CASE WHEN n > c THEN -ln(1 - c / n) ELSE 700 END) OVER (ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b0 FROM r0),
w AS (SELECT g, CASE WHEN code = 1 THEN least(exp(b - b0), 20) ELSE 0 END AS w FROM tte JOIN k1 ON g = user_id % 2 AND k1.time = days JOIN k0 ON k0.time = days) SELECT g AS "group", count(*) AS n, round(sum(w), 4) AS total, round(pow(sum(w), 2) / sum(w * w), 4) AS ess FROM w GROUP BY 1""")
def p9b(spark, sf):
    w = s.stabilized_ipcw(surv(spark, sf), "user_id", "days", F.col("code") == 1, "grp")
    return rounded(w.groupBy("group").agg(F.count("*").alias("n"), F.sum("weight").alias("total")).join(ca.ess(w, "group", "weight"), "group"), "total", "ess", to=4)


@query("q6b_standardize", f"WITH {PSQ}, m AS (SELECT regr_intercept(x, z) FILTER (t) AS a1, regr_slope(x, z) FILTER (t) AS b1, regr_intercept(x, z) FILTER (NOT t) AS a0, regr_slope(x, z) FILTER (NOT t) AS b0 FROM d) SELECT round(avg(a1 + b1 * z), 3) AS mean1, round(avg(a0 + b0 * z), 3) AS mean0, round(avg(a1 + b1 * z) - avg(a0 + b0 * z), 3) AS difference FROM d, m")
def q6b(spark, sf):
    return rounded(r.standardize(treated(spark, sf), "x", F.col("t"), ["z"]), "mean1", "mean0", "difference", to=3)


def _control(c, test):
    return f"SELECT '{c}' AS control, avg(({test})::INT) FILTER (t) AS p1, avg(({test})::INT) FILTER (NOT t) AS p0, count(*) FILTER (t) AS n1, count(*) FILTER (NOT t) AS n0 FROM d"


@query("q7b_negative_control", f"WITH {PSQ}, c AS ({_control('dear', 'x > 200000')} UNION ALL {_control('seven', 'z = 7')}), e AS (SELECT *, p1 - p0 AS rd, {Z} * sqrt(p1 * (1 - p1) / n1 + p0 * (1 - p0) / n0) AS h FROM c) SELECT control, round(p1, 6) AS p1, round(p0, 6) AS p0, round(rd, 6) AS rd, round(rd - h, 6) AS low, round(rd + h, 6) AS high, rd - h > 0 OR rd + h < 0 AS flagged FROM e")
def q7b(spark, sf):
    d = treated(spark, sf).withColumn("dear", F.col("x") > 200000).withColumn("seven", F.col("z") == 7)
    return rounded(r.negative_control(d, ["dear", "seven"], F.col("t")), "p1", "p0", "rd", "low", "high")


@query("q7c_sensitivity_grid", f"WITH {PSQ}, r AS (SELECT z, avg((x > 250000)::INT) FILTER (t) / avg((x > 250000)::INT) FILTER (NOT t) AS rr FROM d GROUP BY 1), g AS (SELECT *, a * b / (a + b - 1) AS bias FROM r, (SELECT unnest([1.5::DOUBLE, 3.0]) AS a), (SELECT unnest([1.2::DOUBLE, 2.0]) AS b)) SELECT z, round(rr, 6) AS rr, a AS treatment_rr, b AS outcome_rr, round(CASE WHEN rr >= 1 THEN rr / bias ELSE rr * bias END, 6) AS adjusted, CASE WHEN rr >= 1 THEN rr / bias <= 1 ELSE rr * bias >= 1 END AS explained FROM g")
def q7c(spark, sf):
    big = (F.col("x") > 250000).cast("double")
    e = treated(spark, sf).groupBy("z").agg(F.try_divide(F.avg(F.when(F.col("t"), big)), F.avg(F.when(~F.col("t"), big))).alias("rr"))
    return rounded(r.sensitivity_grid(e, "rr", [1.5, 3.0], [1.2, 2.0]), "rr", "adjusted")


@query("r4b_era_split", "SELECT CASE WHEN year(o_orderdate) <= 1994 THEN 'train' WHEN year(o_orderdate) <= 1995 THEN 'purged' ELSE 'test' END AS part, count(*) AS n FROM orders GROUP BY 1")
def r4b(spark, sf):
    return load(spark, sf, "orders").groupBy(a.era_split(F.year("o_orderdate"), 1994, 1).alias("part")).agg(F.count("*").alias("n"))


@query("r5b_temporal_folds", "SELECT k::INT AS fold, CASE WHEN year(o_orderdate) = k THEN 'test' ELSE 'train' END AS role, count(*) AS n FROM orders, range(1994, 1997) r(k) WHERE year(o_orderdate) <= k GROUP BY 1, 2")
def r5b(spark, sf):
    return a.temporal_folds(load(spark, sf, "orders").select("o_orderdate"), F.year("o_orderdate"), 1994, 1996).groupBy("fold", "role").agg(F.count("*").alias("n"))


def _unit(key, seed):
    return f"('0x' || substr(md5('{seed}:' || {key}::VARCHAR), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE"


@query("r5c_nested_folds", f"WITH u AS (SELECT DISTINCT o_custkey, floor({_unit('o_custkey', 'n')} * 4)::INT AS o, floor({_unit('o_custkey', 'n:inner')} * 3)::INT AS i FROM orders) SELECT o_custkey, k::INT AS fold, CASE WHEN o <> k THEN i END AS \"inner\" FROM u, range(0, 4) r(k)")
def r5c(spark, sf):
    return a.nested_folds(load(spark, sf, "orders"), "o_custkey", 4, 3, "n")


@query("r6e_clustered_mean", f"WITH {SC}, c AS (SELECT o_custkey AS g, sum((s.p - s.y::INT) * (s.p - s.y::INT)) AS s, count(*) AS n FROM sc s JOIN orders o ON s.o_orderkey = o.o_orderkey GROUP BY 1), t AS (SELECT count(*) AS k, sum(n)::BIGINT AS n, sum(s) / sum(n) AS m FROM c), q AS (SELECT k, t.n, m, sqrt(sum((s - m * c.n) * (s - m * c.n)) * k / (k - 1)) / t.n AS se FROM c, t GROUP BY 1, 2, 3) SELECT k AS clusters, n, round(m, 6) AS mean, round(se, 6) AS se, round(m - {Z} * se, 6) AS low, round(m + {Z} * se, 6) AS high, round(m / se, 4) AS z FROM q")
def r6e(spark, sf):
    d = scored(spark, sf).join(load(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    return rounded(rounded(a.clustered_mean(d, (F.col("p") - F.col("y").cast("int")) ** 2, "o_custkey"), "mean", "se", "low", "high"), "z", to=4)


@query("r6f_calibration")
def r6f(spark, sf):
    return rounded(a.calibration(scored(spark, sf), "p", F.col("y")), "slope", "intercept", "difference", to=3)


@query("r7b_c_index", f"WITH {TTE}, s AS (SELECT *, user_id % 13 AS sc FROM tte) SELECT count(*) AS pairs, count(*) FILTER (i.sc > j.sc) AS concordant, count(*) FILTER (i.sc = j.sc) AS tied, round((count(*) FILTER (i.sc > j.sc) + count(*) FILTER (i.sc = j.sc) / 2) / count(*), 6) AS c FROM s i JOIN s j ON i.code = 1 AND (i.days < j.days OR i.days = j.days AND j.code <> 1)")
def r7b(spark, sf):
    return rounded(a.c_index(tte(spark, sf).withColumn("sc", F.col("user_id") % 13), "days", F.col("code") == 1, "sc"), "c")


@query("r7c_compare_scores", f"WITH {SC}, d AS (SELECT o_orderpriority AS g, (p - y::INT) * (p - y::INT) - (0.5::DOUBLE - y::INT) * (0.5::DOUBLE - y::INT) AS d FROM sc), c AS (SELECT g, sum(d) AS s, count(*) AS n FROM d GROUP BY 1), t AS (SELECT count(*) AS k, sum(n)::BIGINT AS n, sum(s) / sum(n) AS m FROM c), q AS (SELECT k, t.n, m, sqrt(sum((s - m * c.n) * (s - m * c.n)) * k / (k - 1)) / t.n AS se FROM c, t GROUP BY 1, 2, 3) SELECT k AS clusters, n, round(m, 6) AS mean, round(se, 6) AS se, round(m - {Z} * se, 6) AS low, round(m + {Z} * se, 6) AS high, round(m / se, 4) AS z FROM q")
def r7c(spark, sf):
    d = scored(spark, sf).withColumn("half", F.lit(0.5))
    return rounded(rounded(a.compare_scores(d, F.col("y"), "p", "half", "o_orderpriority"), "mean", "se", "low", "high"), "z", to=4)


@query("r7d_learning_curve")
def r7d(spark, sf):
    train, test = parts(spark, sf)
    return rounded(a.learning_curve(train, test, "o_orderkey", ["price", "k"], "y", [0.1, 1.0]), "auroc", to=2)


def four(spark, sf):
    return load(spark, sf, "embeddings").select("vec_id", F.slice("embedding", 1, 4).alias("v"))


@query("r10c_bisecting_silhouette")
def r10c(spark, sf):
    return rounded(m.silhouette(m.bisecting(four(spark, sf), "v", 3), "v", "cluster"), "silhouette", to=2)


@query("r10d_mixture")
def r10d(spark, sf):
    return m.mixture(four(spark, sf), "v", 2).groupBy("cluster").agg(F.count("*").alias("n"), F.round(F.avg("probability"), 2).alias("probability"))


@query("r10e_silhouette", """WITH e AS (SELECT label, vec_id, list_transform(embedding[1:4], lambda v: v::DOUBLE) AS v FROM embeddings), k AS (SELECT label, count(*) AS n, sum(list_sum(list_transform(v, lambda z: z * z))) AS sq, [sum(v[1]), sum(v[2]), sum(v[3]), sum(v[4])] AS s FROM e GROUP BY 1),
d AS (SELECT e.label, vec_id, k.label AS other, n, n * list_sum(list_transform(v, lambda z: z * z)) + sq - 2 * (v[1] * s[1] + v[2] * s[2] + v[3] * s[3] + v[4] * s[4]) AS t FROM e, k), w AS (SELECT vec_id, max(t / nullif(n - 1, 0)) FILTER (label = other) AS a, min(t / n) FILTER (label <> other) AS b FROM d GROUP BY 1) SELECT round(avg(coalesce((b - a) / greatest(a, b), 0)), 6) AS silhouette FROM w""")
def r10e(spark, sf):
    e = load(spark, sf, "embeddings").select("label", F.slice("embedding", 1, 4).alias("v"))
    return rounded(m.silhouette(e, "v", "label"), "silhouette")


@query("r14b_svd", "SELECT round(sum(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE))), 3) AS total FROM embeddings")
def r14b(spark, sf):
    return rounded(m.svd(load(spark, sf, "embeddings"), "embedding", 10**6).agg(F.sum(F.col("singular") ** 2).alias("total")), "total", to=3)


@query("r17b_duplicate_rows", "WITH g AS (SELECT l_quantity, l_discount, l_tax, count(*) AS n, count(DISTINCT l_returnflag) AS k FROM lineitem GROUP BY 1, 2, 3) SELECT sum(n)::BIGINT AS n_rows, sum(n - 1)::BIGINT AS repeated, coalesce(sum(n) FILTER (k > 1), 0)::BIGINT AS across_splits FROM g")
def r17b(spark, sf):
    return f.duplicate_rows(load(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_returnflag")


@query("r18b_prevalence_by_era", f"WITH {SC} SELECT yr::INT AS era, count(*) AS n, round(avg(y::INT), 6) AS prevalence, round(avg(p), 6) AS mean_p, round(avg((p IS NULL)::INT), 6) AS missing_p FROM sc GROUP BY 1")
def r18b(spark, sf):
    return rounded(f.prevalence_by_era(scored(spark, sf), F.col("yr"), F.col("y"), ["p"]), "prevalence", "mean_p", "missing_p")


@query("r18c_era_classifier")
def r18c(spark, sf):
    return rounded(m.era_classifier(scored(spark, sf).withColumnRenamed("p", "risk"), ["risk", "o_totalprice"], F.col("yr") > 1995, "o_orderkey"), "auroc", to=2)


def _group(dim, level):
    return f"SELECT '{dim}' AS dim, {level} AS level, p, y FROM sc"


@query("r19b_subgroup_auroc", f"WITH {SC}, g AS ({_group('yr', 'yr::VARCHAR')} UNION ALL {_group('all', chr(39) + 'all' + chr(39))}), r AS (SELECT *, rank() OVER (PARTITION BY dim, level ORDER BY p) + (count(*) OVER (PARTITION BY dim, level, p) - 1) / 2 AS ar FROM g), s AS (SELECT dim, level, count(*) AS n, count(*) FILTER (y) AS k, avg(p) AS m, sum(ar) FILTER (y) AS t FROM r GROUP BY 1, 2) SELECT dim, level, n, k AS positives, round(k / n, 6) AS prevalence, round(m, 6) AS mean_score, round((t - k * (k + 1) / 2) / nullif(k::DOUBLE * (n - k), 0), 6) AS auroc FROM s")
def r19b(spark, sf):
    return rounded(a.subgroup_auroc(scored(spark, sf), ["yr"], "p", F.col("y")), "prevalence", "mean_score", "auroc")


@query("r20d_error_profile", f"WITH {SC} SELECT CASE WHEN p >= 0.5 AND y THEN 'tp' WHEN p >= 0.5 THEN 'fp' WHEN y THEN 'fn' ELSE 'tn' END AS outcome, count(*) AS n, round(avg(p), 6) AS mean_score, round(avg(o_totalprice), 2) AS mean_o_totalprice FROM sc GROUP BY 1")
def r20d(spark, sf):
    return rounded(rounded(a.error_profile(scored(spark, sf), "p", F.col("y"), 0.5, ["o_totalprice"]), "mean_score"), "mean_o_totalprice", to=2)


@query("t6c_embedding_search", """WITH s AS (SELECT q.vec_id AS query, e.vec_id, list_sum(list_transform(list_zip(q.embedding, e.embedding), lambda p: p[1]::DOUBLE * p[2]::DOUBLE)) / (sqrt(list_sum(list_transform(q.embedding, lambda v: v::DOUBLE * v::DOUBLE))) * sqrt(list_sum(list_transform(e.embedding, lambda v: v::DOUBLE * v::DOUBLE)))) AS s FROM embeddings q JOIN embeddings e ON e.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query, row_number() OVER (PARTITION BY query ORDER BY s DESC, vec_id)::INT AS rank, vec_id, round(s, 6) AS similarity FROM s QUALIFY rank <= 3""")
def t6c(spark, sf):
    e = load(spark, sf, "embeddings")
    return rounded(m.embedding_search(e, e.where("vec_id % 20 = 0"), "vec_id", "embedding", 3), "similarity")


@query("t7b_topic_clusters")
def t7b(spark, sf):
    d = load(spark, sf, "documents")
    return tx.topic_clusters(d, "doc_id", "text", 4).join(d.select("doc_id", "lang"), "doc_id").groupBy("topic", "lang").agg(F.count("*").alias("n"))


def rivals(spark, sf):
    """Two scores of the same orders; a customer is a cluster."""
    return scored(spark, sf).join(load(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey").withColumn("q", (F.col("p") + F.when(F.col("y"), 0.2).otherwise(0.0)) / 1.2)


@query("r6g_metric_intervals")
def r6g(spark, sf):
    return rounded(a.metric_intervals(rivals(spark, sf), "o_custkey", "p", F.col("y"), 100, by=["yr"]), "estimate", "low", "high", "se")


@query("r7e_paired_intervals")
def r7e(spark, sf):
    return rounded(a.paired_intervals(rivals(spark, sf), "o_custkey", "q", "p", F.col("y"), 100), "estimate", "low", "high", "se")


@query("r6h_metrics_by_era", f"""WITH {SC}, t AS (SELECT yr, p, count(*)::DOUBLE AS n, count(*) FILTER (y)::DOUBLE AS k FROM sc GROUP BY 1, 2), c AS (SELECT *, sum(n) OVER u AS cn, sum(n) OVER d AS dn, sum(k) OVER d AS dk FROM t WINDOW u AS (PARTITION BY yr ORDER BY p), d AS (PARTITION BY yr ORDER BY p DESC))
SELECT yr, sum(n)::BIGINT AS n, round((sum((cn - (n - 1) / 2) * k) - sum(k) * (sum(k) + 1) / 2) / (sum(k) * (sum(n) - sum(k))), 6) AS auroc, round(sum(k * dk / dn) / sum(k), 6) AS auprc, round(sum(k * (1 - p) * (1 - p) + (n - k) * p * p) / sum(n), 6) AS brier FROM c GROUP BY 1""")
def r6h(spark, sf):
    r = a.replicated_metrics(rivals(spark, sf), "o_custkey", "p", F.col("y"), 1, by=["yr"]).where("rep < 0").drop("rep")
    return rounded(r, "auroc", "auprc", "brier")


@query("o3d_negative_binomial_ml")
def o3d(spark, sf):
    d = load(spark, sf, "lineitem").select(F.col("l_quantity").cast("long").alias("n"), (F.col("l_discount") * 10).alias("x"))
    return rounded(r.negative_binomial_ml(d, "n", ["x"]), "coefficient", "se", to=4)


SPECS = [{"estimand": e, **t} for e in ("ATE", "ATT", "ATO") for t in ({}, {"trim": (0.15, 0.75)}, {"truncate": (0.2, 0.7)})]


def _spec_sql(k, s):
    a, z = s.get("truncate", (0, 1))
    p = f"least(greatest(ps, {a}), {z})"
    w = {"ATE": f"CASE WHEN t THEN 1 / {p} ELSE 1 / (1 - {p}) END", "ATT": f"CASE WHEN t THEN 1 ELSE {p} / (1 - {p}) END", "ATO": f"CASE WHEN t THEN 1 - {p} ELSE {p} END"}[s["estimand"]]
    keep = f"WHERE ps BETWEEN {s['trim'][0]} AND {s['trim'][1]}" if "trim" in s else ""
    return f"SELECT {k} AS spec, x, t, {w} AS w FROM d {keep}"


@query("q7f_specification_grid", f"WITH {PSQ}, g AS ({' UNION ALL '.join(_spec_sql(k, s) for k, s in enumerate(SPECS))}) SELECT spec, count(*) AS n, count(*) FILTER (t) AS n_treated, round(sum(w * x) FILTER (t) / sum(w) FILTER (t) - sum(w * x) FILTER (NOT t) / sum(w) FILTER (NOT t), 4) AS difference, round(pow(sum(w), 2) / sum(w * w), 4) AS ess FROM g GROUP BY 1")
def q7f(spark, sf):
    g = r.specification_grid(treated(spark, sf), "x", F.col("t"), "ps", SPECS).select("spec", "n", "n_treated", "difference", "ess")
    return rounded(g, "difference", "ess", to=4)


@query("q7g_leave_one_out")
def q7g(spark, sf):
    d = treated(spark, sf).drop("ps").withColumn("x", F.col("x") / 1e5)
    return rounded(r.leave_one_out(d.withColumn("y", F.col("x") + F.col("z")), "y", "t", ["x", "z"], "ATE", src.scratch(spark, "ledger")), "difference", "ess", to=3)
