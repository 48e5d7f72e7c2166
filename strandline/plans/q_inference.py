"""Queries over inference, survival, regression and comparative effectiveness (survey 2.14 to 2.17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import causal as ca
from strandline.operators import inference as n
from strandline.operators import matching
from strandline.operators import survival as s
from strandline.plans.q_explore import TTE, tte
from strandline.plans.q_temporal import STAY, stays
from strandline.plans.q_timeline import rounded
from strandline.plans.registry import query
from strandline.sources.tables import load

RANKS = "r AS (SELECT *, min(k) OVER (PARTITION BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2 AS ar, count(*) OVER (PARTITION BY v) AS tn FROM (SELECT value AS v, event_type, user_id, event_id, rank() OVER (ORDER BY value) AS k FROM events))"


def ret():
    return F.col("l_returnflag") == "R"


def ev(spark, sf):
    return load(spark, sf, "events")


@query("n1_compare_means", """WITH s AS (SELECT count(value) FILTER (event_type = 'click') AS n1, count(value) FILTER (event_type <> 'click') AS n2, avg(value) FILTER (event_type = 'click') AS m1, avg(value) FILTER (event_type <> 'click') AS m2, var_samp(value) FILTER (event_type = 'click') AS v1, var_samp(value) FILTER (event_type <> 'click') AS v2 FROM events),
d AS (SELECT *, m1 - m2 AS diff, v1 / n1 AS a, v2 / n2 AS b, (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)) AS cd FROM s)
SELECT round(diff, 6) AS diff, round(diff / sqrt(a + b), 6) AS t, round((a + b) * (a + b) / (a * a / (n1 - 1) + b * b / (n2 - 1)), 4) AS df, round(cd, 6) AS cohen_d, round(cd * (1 - 3 / (4 * (n1 + n2) - 9)), 6) AS hedges_g FROM d""")
def n1(spark, sf):
    r = n.compare_means(ev(spark, sf), "value", F.col("event_type") == "click")
    return rounded(rounded(r, "diff", "t", "cohen_d", "hedges_g"), "df", to=4)


@query("n1b_t_test_p")
def n1b(spark, sf):
    r = n.compare_means(ev(spark, sf), "value", F.col("event_type") == "click")
    return r.select(n.t_p("t", "df").alias("p"))


@query("n2_compare_props", """WITH s AS (SELECT count(*) FILTER (g) AS n1, count(*) FILTER (NOT g) AS n2, count(*) FILTER (e AND g) AS x1, count(*) FILTER (e AND NOT g) AS x2 FROM (SELECT l_returnflag = 'R' AS e, l_quantity > 25 AS g FROM lineitem)), p AS (SELECT *, x1 / n1 AS p1, x2 / n2 AS p2 FROM s)
SELECT round(p1, 6) AS p1, round(p2, 6) AS p2, round(p1 - p2, 6) AS rd, round(p1 / p2, 6) AS rr, round(exp(ln(p1 / p2) - 1.959963984540054::DOUBLE * sqrt(1 / x1 - 1 / n1 + 1 / x2 - 1 / n2)), 6) AS rr_low, round(x1 * (n2 - x2) / (x2 * (n1 - x1)), 6) AS or_ FROM p""")
def n2(spark, sf):
    r = n.compare_props(load(spark, sf, "lineitem"), ret(), F.col("l_quantity") > 25)
    return rounded(r.select("p1", "p2", "rd", "rr", "rr_low", "or_"), "p1", "p2", "rd", "rr", "rr_low", "or_")


@query("n3_chi_square", """WITH o AS (SELECT l_returnflag AS r, l_linenumber AS c, count(*) AS n FROM lineitem GROUP BY 1, 2), e AS (SELECT *, sum(n) OVER (PARTITION BY r) * sum(n) OVER (PARTITION BY c) / sum(n) OVER () AS e FROM o), x AS (SELECT sum((n - e) * (n - e) / e) AS chi2, (count(DISTINCT r) - 1) * (count(DISTINCT c) - 1) AS df, sum(n)::BIGINT AS n, least(count(DISTINCT r), count(DISTINCT c)) - 1 AS k FROM e)
SELECT round(chi2, 4) AS chi2, df, n, round(sqrt(chi2 / (n * k)), 6) AS cramer_v FROM x""")
def n3(spark, sf):
    return rounded(rounded(n.chi_square(load(spark, sf, "lineitem"), "l_returnflag", "l_linenumber"), "chi2", to=4), "cramer_v")


@query("n3b_mcnemar", "WITH s AS (SELECT count(*) FILTER (a AND NOT b) AS oa, count(*) FILTER (b AND NOT a) AS ob FROM (SELECT l_quantity > 30 AS a, l_discount > 0.05 AS b FROM lineitem)) SELECT oa AS only_a, ob AS only_b, round((oa - ob) * (oa - ob) / (oa + ob), 6) AS chi2 FROM s")
def n3b(spark, sf):
    return rounded(n.mcnemar(load(spark, sf, "lineitem"), F.col("l_quantity") > 30, F.col("l_discount") > 0.05), "chi2")


@query("n3c_cmh", """WITH s AS (SELECT l_linenumber, count(*)::DOUBLE AS n, count(*) FILTER (e AND g)::DOUBLE AS a, count(*) FILTER (NOT e AND g)::DOUBLE AS b, count(*) FILTER (e AND NOT g)::DOUBLE AS c, count(*) FILTER (NOT e AND NOT g)::DOUBLE AS d FROM (SELECT l_linenumber, l_returnflag = 'R' AS e, l_quantity > 25 AS g FROM lineitem) GROUP BY 1)
SELECT round(sum(a * d / n) / sum(b * c / n), 6) AS or_mh, round(pow(sum(a - (a + b) * (a + c) / n), 2) / sum((a + b) * (c + d) * (a + c) * (b + d) / (n * n * (n - 1))), 6) AS chi2 FROM s""")
def n3c(spark, sf):
    return rounded(n.cmh(load(spark, sf, "lineitem"), "l_linenumber", ret(), F.col("l_quantity") > 25), "or_mh", "chi2")


@query("n4_avg_ranks", f"WITH {RANKS} SELECT event_id, ar AS avg_rank FROM r")
def n4(spark, sf):
    return n.avg_ranks(ev(spark, sf), "value").select("event_id", "avg_rank")


@query("n5_mann_whitney", f"""WITH {RANKS}, s AS (SELECT count(*) FILTER (event_type = 'click')::DOUBLE AS a, count(*) FILTER (event_type <> 'click')::DOUBLE AS b, sum(ar) FILTER (event_type = 'click') AS rs, sum(tn * tn - 1)::DOUBLE AS t FROM r), u AS (SELECT *, rs - a * (a + 1) / 2 AS u FROM s)
SELECT a::BIGINT AS n1, b::BIGINT AS n2, u, round((u - a * b / 2) / sqrt(a * b / 12 * ((a + b + 1) - t / ((a + b) * (a + b - 1)))), 6) AS z, round(2 * u / (a * b) - 1, 6) AS cliff_delta FROM u""")
def n5(spark, sf):
    return rounded(n.mann_whitney(ev(spark, sf), "value", F.col("event_type") == "click"), "z", "cliff_delta")


@query("n5b_kruskal", f"WITH {RANKS}, g AS (SELECT event_type, count(*)::DOUBLE AS m, sum(ar) AS s FROM r GROUP BY 1), t AS (SELECT sum(tn * tn - 1)::DOUBLE AS t, count(*)::DOUBLE AS n FROM r) SELECT count(*) AS groups, any_value(n)::BIGINT AS n, round((12 / (any_value(n) * (any_value(n) + 1)) * sum(s * s / m) - 3 * (any_value(n) + 1)) / (1 - any_value(t) / (pow(any_value(n), 3) - any_value(n))), 6) AS h FROM g, t")
def n5b(spark, sf):
    return rounded(n.kruskal(ev(spark, sf), "value", "event_type"), "h")


@query("n6_anova", """WITH g AS (SELECT event_type, count(*)::DOUBLE AS n, avg(value) AS m, var_pop(value) AS v FROM events GROUP BY 1), s AS (SELECT count(*) AS k, sum(n) AS n, sum(n * m * m) - sum(n * m) * sum(n * m) / sum(n) AS b, sum(n * v) AS w FROM g)
SELECT k AS groups, n::BIGINT AS n, round(b, 3) AS ss_between, round(w, 3) AS ss_within, round((b / (k - 1)) / (w / (n - k)), 6) AS f FROM s""")
def n6(spark, sf):
    return rounded(rounded(n.anova(ev(spark, sf), "value", "event_type"), "ss_between", "ss_within", to=3), "f")


@query("n5c_signed_rank")
def n5c(spark, sf):
    e = ev(spark, sf)
    d = e.groupBy("user_id").agg((F.avg(F.when(F.col("event_type") == "click", F.col("value"))) - F.avg(F.when(F.col("event_type") == "view", F.col("value")))).alias("d"))
    return rounded(n.signed_rank(d, F.col("d")), "z", "p")


@query("n6b_welch_anova", """WITH g AS (SELECT event_type, count(*)::DOUBLE AS n, avg(value) AS m, count(*) / var_samp(value) AS w FROM events GROUP BY 1), t AS (SELECT count(*) AS k, sum(w) AS w, sum(w * m) / sum(w) AS m FROM g), s AS (SELECT any_value(t.k) AS k, sum(g.w * pow(g.m - t.m, 2)) AS b, sum(pow(1 - g.w / t.w, 2) / (n - 1)) AS l FROM g, t)
SELECT k AS groups, round(b / (k - 1) / (1 + 2 * (k - 2) / (k * k - 1) * l), 6) AS f, k - 1 AS df1, round((k * k - 1) / (3 * l), 4) AS df2 FROM s""")
def n6b(spark, sf):
    return rounded(n.welch_anova(ev(spark, sf), "value", "event_type"), "f").withColumn("df2", F.round("df2", 4))


@query("n7_permutation_test")
def n7(spark, sf):
    return n.permutation_test(ev(spark, sf), "user_id", "value", F.col("user_id") % 2 == 0, 99)


PV = "p AS (SELECT p_brand, (count(*) % 17 + 1) / 400.0::DOUBLE AS p FROM part GROUP BY 1), k AS (SELECT *, row_number() OVER (ORDER BY p, p_brand) AS r, count(*) OVER () AS n, (SELECT sum(1.0::DOUBLE / i) FROM range(1, 1 + (SELECT count(*) FROM p)) t(i)) AS h FROM p)"


@query("n8_p_adjust", f"""WITH {PV} SELECT p_brand, p, round(least(p * n, 1), 8) AS bonferroni, round(least(max(p * (n - r + 1)) OVER (ORDER BY r ROWS UNBOUNDED PRECEDING), 1), 8) AS holm, round(least(min(p * n / r) OVER (ORDER BY r DESC ROWS UNBOUNDED PRECEDING), 1), 8) AS bh, round(least(min(p * n * h / r) OVER (ORDER BY r DESC ROWS UNBOUNDED PRECEDING), 1), 8) AS by FROM k""")
def n8(spark, sf):
    p = load(spark, sf, "part").groupBy("p_brand").agg(((F.count("*") % 17 + 1) / F.lit(400.0)).alias("p"))
    return rounded(n.p_adjust(p, "p"), "bonferroni", "holm", "bh", "by", to=8)


@query("n9_cluster_bootstrap")
def n9(spark, sf):
    return n.cluster_bootstrap(ev(spark, sf), "user_id", F.col("value"), F.lit(1), 200)


@query("n10_agreement", """WITH s AS (SELECT count(*) FILTER (a AND b)::DOUBLE AS tp, count(*) FILTER (a AND NOT b)::DOUBLE AS fp, count(*) FILTER (NOT a AND b)::DOUBLE AS fn, count(*) FILTER (NOT a AND NOT b)::DOUBLE AS tn FROM (SELECT l_quantity > 25 AS a, l_extendedprice > 30000 AS b FROM lineitem)), k AS (SELECT *, tp + fp + fn + tn AS n FROM s), e AS (SELECT *, ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n) AS pe FROM k)
SELECT tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, tn::BIGINT AS tn, round(tp / (tp + fn), 6) AS sensitivity, round(tn / (tn + fp), 6) AS specificity, round(tp / (tp + fp), 6) AS ppv, round(tn / (tn + fn), 6) AS npv, round(((tp + tn) / n - pe) / (1 - pe), 6) AS kappa FROM e""")
def n10(spark, sf):
    return rounded(n.agreement_2x2(load(spark, sf, "lineitem"), F.col("l_quantity") > 25, F.col("l_extendedprice") > 30000), "sensitivity", "specificity", "ppv", "npv", "kappa")


@query("n11_fdr_screen", """WITH u AS (SELECT o_orderkey, o_orderstatus = 'F' AS y FROM orders), b AS (SELECT count(*)::DOUBLE AS nn, count(*) FILTER (y)::DOUBLE AS ee FROM u), g AS (SELECT p_brand, count(*) AS n, count(*) FILTER (y) AS e FROM (SELECT DISTINCT p_brand, l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey) JOIN u ON l_orderkey = o_orderkey GROUP BY 1),
x AS (SELECT p_brand, n, e AS events, e::DOUBLE AS a, (n - e)::DOUBLE AS bb, ee - e AS c, nn - n - ee + e AS d, nn FROM g, b) SELECT p_brand, n, events, round(nn * pow(a * d - bb * c, 2) / ((a + bb) * (c + d) * (a + c) * (bb + d)), 6) AS chi2 FROM x""")
def n11(spark, sf):
    brands = load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    rows = load(spark, sf, "lineitem").join(brands, "l_partkey").select("p_brand", F.col("l_orderkey").alias("o_orderkey"))
    units = load(spark, sf, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").alias("y"))
    return rounded(n.fdr_screen(rows, "p_brand", "o_orderkey", units, "y"), "chi2")


@query("n12_ks_psi", """WITH c AS (SELECT value AS v, count(*) FILTER (user_id % 2 = 0) AS a, count(*) FILTER (user_id % 2 <> 0) AS b FROM events GROUP BY 1), r AS (SELECT abs(sum(a) OVER q / sum(a) OVER () - sum(b) OVER q / sum(b) OVER ()) AS d FROM c WINDOW q AS (ORDER BY v ROWS UNBOUNDED PRECEDING)),
k AS (SELECT (value >= 10)::INT + (value >= 50)::INT + (value >= 150)::INT AS bin, count(*) FILTER (user_id % 2 = 0) AS a, count(*) FILTER (user_id % 2 <> 0) AS b FROM events GROUP BY 1), p AS (SELECT greatest(a / sum(a) OVER (), 1e-4) AS p, greatest(b / sum(b) OVER (), 1e-4) AS q FROM k) SELECT (SELECT round(max(d), 6) FROM r) AS d, (SELECT round(sum((p - q) * ln(p / q)), 6) FROM p) AS psi""")
def n12(spark, sf):
    e, g = ev(spark, sf), F.col("user_id") % 2 == 0
    return rounded(n.ks(e, "value", g).crossJoin(n.psi(e, "value", g, [10, 50, 150])), "d", "psi")


RT = f"{TTE}, rt AS (SELECT (user_id % 2)::INT AS g, days AS time, count(*) FILTER (code = 1) AS d1, count(*) FILTER (code = 2) AS d2, count(*) AS c FROM tte GROUP BY 1, 2), rk AS (SELECT *, sum(c) OVER (PARTITION BY g ORDER BY time DESC) AS n FROM rt)"


def surv(spark, sf):
    return tte(spark, sf).withColumn("grp", (F.col("user_id") % 2).cast("int"))


KM = f"""{RT}, ks AS (SELECT *, coalesce(sum(CASE WHEN n > d1 THEN ln(1 - d1 / n) END) OVER w, 0) AS l, max((n = d1)::INT) OVER w AS dead, coalesce(sum(CASE WHEN n > d1 THEN d1 / (n * (n - d1)) END) OVER w, 0) AS v FROM rk WHERE d1 > 0 WINDOW w AS (PARTITION BY g ORDER BY time)), km AS (SELECT g, time, n, d1, CASE WHEN dead = 1 THEN 0 ELSE exp(l) END AS s, v FROM ks)"""


@query("p1_km", f"""WITH {KM} SELECT g AS "group", round(time, 6) AS time, n::BIGINT AS at_risk, d1 AS events, round(s, 6) AS survival, CASE WHEN s > 0 AND s < 1 THEN round(pow(s, exp(1.959963984540054 * sqrt(v) / abs(ln(s)))), 6) END AS low, CASE WHEN s > 0 AND s < 1 THEN round(pow(s, exp(-1.959963984540054 * sqrt(v) / abs(ln(s)))), 6) END AS high FROM km""")
def p1(spark, sf):
    return rounded(s.km(surv(spark, sf), "days", F.col("code") == 1, "grp"), "time", "survival", "low", "high")


@query("p1b_survival_quantiles", f"""WITH {KM}, b AS (SELECT *, CASE WHEN s > 0 AND s < 1 THEN pow(s, exp(1.959963984540054 * sqrt(v) / abs(ln(s)))) ELSE s END AS lo, CASE WHEN s > 0 AND s < 1 THEN pow(s, exp(-1.959963984540054 * sqrt(v) / abs(ln(s)))) ELSE s END AS hi FROM km)
SELECT g AS "group", p::DOUBLE AS prob, round(min(time) FILTER (s <= 1 - p + 1e-12), 6) AS time, round(min(time) FILTER (lo <= 1 - p + 1e-12), 6) AS low, round(min(time) FILTER (hi <= 1 - p + 1e-12), 6) AS high FROM b, (VALUES (0.25), (0.5), (0.75)) q(p) GROUP BY 1, 2""")
def p1b(spark, sf):
    return rounded(s.survival_quantiles(s.km(surv(spark, sf), "days", F.col("code") == 1, "grp"), [0.25, 0.5, 0.75]), "time", "low", "high")


@query("p2_logrank", f"""WITH {TTE}, t AS (SELECT days AS time, count(*) FILTER (code = 1) AS d, count(*) FILTER (code = 1 AND user_id % 2 = 0) AS d1, count(*) AS c, count(*) FILTER (user_id % 2 = 0) AS c1 FROM tte GROUP BY 1), k AS (SELECT *, sum(c) OVER (ORDER BY time DESC)::DOUBLE AS n, sum(c1) OVER (ORDER BY time DESC)::DOUBLE AS n1 FROM t),
e AS (SELECT d1, d * n1 / n AS e, CASE WHEN n > 1 THEN d * n1 / n * (1 - n1 / n) * (n - d) / (n - 1) ELSE 0 END AS v FROM k WHERE d > 0) SELECT sum(d1)::BIGINT AS observed, round(sum(e), 6) AS expected, round(sum(v), 6) AS variance, round(pow(sum(d1) - sum(e), 2) / sum(v), 6) AS chi2 FROM e""")
def p2(spark, sf):
    return rounded(s.logrank(surv(spark, sf), "days", F.col("code") == 1, F.col("grp") == 0), "expected", "variance", "chi2")


@query("p2b_logrank_strata", f"""WITH {TTE}, t AS (SELECT user_id % 3 AS st, days AS time, count(*) FILTER (code = 1) AS d, count(*) FILTER (code = 1 AND user_id % 2 = 0) AS d1, count(*) AS c, count(*) FILTER (user_id % 2 = 0) AS c1 FROM tte GROUP BY 1, 2), k AS (SELECT *, sum(c) OVER w::DOUBLE AS n, sum(c1) OVER w::DOUBLE AS n1 FROM t WINDOW w AS (PARTITION BY st ORDER BY time DESC)),
e AS (SELECT d1, d * n1 / n AS e, CASE WHEN n > 1 THEN d * n1 / n * (1 - n1 / n) * (n - d) / (n - 1) ELSE 0 END AS v FROM k WHERE d > 0) SELECT sum(d1)::BIGINT AS observed, round(sum(e), 6) AS expected, round(sum(v), 6) AS variance, round(pow(sum(d1) - sum(e), 2) / sum(v), 6) AS chi2 FROM e""")
def p2b(spark, sf):
    d = surv(spark, sf).withColumn("st", F.col("user_id") % 3)
    return rounded(s.logrank(d, "days", F.col("code") == 1, F.col("grp") == 0, "st"), "expected", "variance", "chi2")


@query("p3_aalen_johansen", f"""WITH {RT}, x AS (SELECT *, CASE WHEN n > d1 + d2 THEN ln(1 - (d1 + d2) / n) ELSE -700 END AS l FROM rk WHERE d1 + d2 > 0), y AS (SELECT *, coalesce(exp(sum(l) OVER (PARTITION BY g ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 1) AS p, exp(sum(l) OVER (PARTITION BY g ORDER BY time)) AS sv FROM x)
SELECT g AS "group", round(time, 6) AS time, n::BIGINT AS at_risk, round(sum(p * d1 / n) OVER (PARTITION BY g ORDER BY time), 6) AS cif1, round(sum(p * d2 / n) OVER (PARTITION BY g ORDER BY time), 6) AS cif2, round(sv, 6) AS survival FROM y""")
def p3(spark, sf):
    return rounded(s.aalen_johansen(surv(spark, sf), "days", "code", "grp"), "time", "cif1", "cif2", "survival")


@query("p4_mcf", """WITH f AS (SELECT user_id, min(ts) AS o FROM events GROUP BY 1), e AS (SELECT e.user_id, round((epoch_us(ts) - epoch_us(o)) / 86400e6::DOUBLE, 6) AS stop, (event_type = 'error')::INT AS d, event_id FROM events e JOIN f ON e.user_id = f.user_id), r AS (SELECT user_id, coalesce(lag(stop) OVER (PARTITION BY user_id ORDER BY stop, event_id), 0) AS start, stop, d FROM e), q AS (SELECT * FROM r WHERE stop > start),
t AS (SELECT time, sum(b) AS b, sum(x) AS x, sum(d)::BIGINT AS d FROM (SELECT stop AS time, 0 AS b, 1 AS x, d FROM q UNION ALL SELECT start, 1, 0, 0 FROM q) GROUP BY 1), c AS (SELECT *, sum(b) OVER (ORDER BY time) - b - (sum(x) OVER (ORDER BY time) - x) AS n FROM t) SELECT time, n::BIGINT AS at_risk, d AS events, round(sum(d / n) OVER (ORDER BY time), 6) AS mcf FROM c WHERE d > 0""")
def p4(spark, sf):
    from pyspark.sql import Window

    from strandline.functions.timesem import days_since

    e = ev(spark, sf)
    e = e.join(e.groupBy("user_id").agg(F.min("ts").alias("o")), "user_id").withColumn("stop", F.round(days_since("o", "ts"), 6))
    r = e.withColumn("start", F.coalesce(F.lag("stop").over(Window.partitionBy("user_id").orderBy("stop", "event_id")), F.lit(0.0))).where("stop > start")
    return rounded(s.mcf(r.withColumn("d", F.col("event_type") == "error"), "start", "stop", "d"), "mcf")


@query("p5_cox")
def p5(spark, sf):
    return rounded(s.cox(surv(spark, sf).withColumn("x", F.pmod(F.col("user_id"), F.lit(7)).cast("double")), "days", F.col("code") == 1, ["grp", "x"]), "beta", "se")


@query("p7_aft_weibull")
def p7(spark, sf):
    d = surv(spark, sf).withColumn("days", F.greatest("days", F.lit(1 / 86400)))  # a follow-up without length counts as one second
    return rounded(s.aft_weibull(d, "days", F.col("code") == 1, ["grp"]), "coefficient", to=3)


@query("p8_landmark", f"WITH {TTE} SELECT user_id, round(days - 2, 6) AS days, code FROM tte WHERE days > 2")
def p8(spark, sf):
    return rounded(s.landmark(tte(spark, sf), "days", 2), "days")


@query("p9_ipcw", f"""WITH {TTE}, t AS (SELECT days AS time, count(*) FILTER (code <> 1) AS c, count(*) AS k FROM tte GROUP BY 1), r AS (SELECT *, sum(k) OVER (ORDER BY time DESC) AS n FROM t), g AS (SELECT time, coalesce(sum(CASE WHEN n > c THEN -ln(1 - c / n) ELSE 700 END) OVER (ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM r)
SELECT user_id, round(CASE WHEN code = 1 THEN least(exp(b), 20) ELSE 0 END, 6) AS weight FROM tte JOIN g ON days = time""")
def p9(spark, sf):
    return rounded(s.ipcw(tte(spark, sf), "user_id", "days", F.col("code") == 1), "weight")


@query("p10_person_period", f"WITH {TTE}, n AS (SELECT *, greatest(ceil(days / 2), 1)::INT AS n FROM tte) SELECT user_id, k::INT AS period, CASE WHEN k = n THEN code ELSE 0 END AS outcome FROM n, range(1, 100) r(k) WHERE k <= n")
def p10(spark, sf):
    return s.person_period(tte(spark, sf), "user_id", "days", "code", 2)


@query("q1_sequential_trials", f"""WITH {STAY}, i AS (SELECT user_id, min(ts) AS i FROM events WHERE event_type = 'purchase' AND value > 100 GROUP BY 1), u AS (SELECT user_id, min(intime) AS a, max(outtime) AS z FROM stays GROUP BY 1), g AS (SELECT u.user_id, k AS trial, a + to_hours(48 * k) AS origin, z, i FROM u LEFT JOIN i ON u.user_id = i.user_id, range(0, 5) r(k))
SELECT trial::INT AS trial, count(*) AS n, sum((coalesce(i < origin + INTERVAL 48 HOUR, false))::INT)::BIGINT AS initiators, count(i) FILTER (NOT coalesce(i < origin + INTERVAL 48 HOUR, false)) AS deviators FROM g WHERE origin < z AND (i IS NULL OR i >= origin) GROUP BY 1""")
def q1(spark, sf):
    u = stays(spark, sf).groupBy("user_id").agg(F.min("intime").alias("a"), F.max("outtime").alias("z"))
    t = ca.sequential_trials(u, "user_id", "a", "z", ev(spark, sf).where("event_type = 'purchase' and value > 100"), "ts", 48, 5)
    return t.groupBy("trial").agg(F.count("*").alias("n"), F.sum("arm").alias("initiators"), F.count("deviated_at").alias("deviators"))


def treated(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 3 == 0).alias("t"), F.col("o_totalprice").alias("x"), (F.col("o_orderkey") % 10).cast("double").alias("z"))
    return o.withColumn("ps", (1 + F.col("o_orderkey") % 7) / F.lit(9.0))


PSQ = "d AS (SELECT o_orderkey, o_orderkey % 3 = 0 AS t, o_totalprice AS x, (o_orderkey % 10)::DOUBLE AS z, (1 + o_orderkey % 7) / 9.0::DOUBLE AS ps FROM orders), w AS (SELECT *, CASE WHEN t THEN 1 / ps ELSE 1 / (1 - ps) END AS w FROM d)"


@query("q2_propensity")
def q2(spark, sf):
    return ca.propensity(treated(spark, sf).drop("ps"), "t", ["x", "z"]).groupBy("t", F.round("ps", 2).alias("bin")).agg(F.count("*").alias("n"))


@query("q3_weights_ess", f"WITH {PSQ} SELECT t, round(pow(sum(w), 2) / sum(w * w), 4) AS ess FROM w GROUP BY 1")
def q3(spark, sf):
    d = treated(spark, sf)
    return rounded(ca.ess(d.withColumn("w", ca.weight(F.col("t"), F.col("ps"), "ATE")), "t", "w"), "ess", to=4)


@query("q4_match")
def q4(spark, sf):
    d = load(spark, sf, "customer").select("c_custkey", (F.col("c_custkey") % 5 == 0).alias("t"), (F.col("c_acctbal") / 1000).alias("s"))
    return matching.match(d, "c_custkey", "t", "s", 0.2)


@query("q4b_matched_sets")
def q4b(spark, sf):
    d = load(spark, sf, "customer").select("c_custkey", (F.col("c_custkey") % 5 == 0).alias("t"), (F.col("c_acctbal") / 1000).alias("s"))
    return rounded(matching.matched_sets(d, "c_custkey", "t", "s", 0.2, 3), "distance")


def _bal(v):
    sd = f"sqrt((var_samp({v}) FILTER (t) + var_samp({v}) FILTER (NOT t)) / 2)"
    return f"SELECT '{v}' AS variable, (avg({v}) FILTER (t) - avg({v}) FILTER (NOT t)) / {sd} AS a, (sum(w * {v}) FILTER (t) / sum(w) FILTER (t) - sum(w * {v}) FILTER (NOT t) / sum(w) FILTER (NOT t)) / {sd} AS b FROM w"


@query("q5_balance", f"WITH {PSQ}, b AS ({_bal('x')} UNION ALL {_bal('z')}) SELECT variable, round(a, 6) AS smd_raw, round(b, 6) AS smd_weighted, abs(b) > 0.1 AS flagged FROM b")
def q5(spark, sf):
    d = treated(spark, sf)
    return rounded(ca.balance(d, F.col("t"), ["x", "z"], ca.weight(F.col("t"), F.col("ps"), "ATE")).select("variable", "smd_raw", "smd_weighted", "flagged"), "smd_raw", "smd_weighted")


def _ratio(v):
    w = lambda g: f"(sum(w * {v} * {v}) FILTER ({g}) / sum(w) FILTER ({g}) - pow(sum(w * {v}) FILTER ({g}) / sum(w) FILTER ({g}), 2))"
    return f"SELECT '{v}' AS variable, round(var_samp({v}) FILTER (t) / var_samp({v}) FILTER (NOT t), 6) AS variance_ratio_raw, round({w('t')} / {w('NOT t')}, 6) AS variance_ratio_weighted FROM w"


@query("q5b_variance_ratio", f"WITH {PSQ} {_ratio('x')} UNION ALL {_ratio('z')}")
def q5b(spark, sf):
    d = treated(spark, sf)
    return rounded(ca.balance(d, F.col("t"), ["x", "z"], ca.weight(F.col("t"), F.col("ps"), "ATE")).select("variable", "variance_ratio_raw", "variance_ratio_weighted"), "variance_ratio_raw", "variance_ratio_weighted")


@query("q6_aipw", f"WITH {PSQ}, p AS (SELECT z * 2 + 1 - z + t::INT::DOUBLE * (x / 1000 - z * 2 - 1) / ps - (1 - t::INT::DOUBLE) * (x / 1000 - z) / (1 - ps) AS p FROM w) SELECT round(avg(p), 6) AS ate, round(stddev_samp(p) / sqrt(count(p)), 6) AS se FROM p")
def q6(spark, sf):
    z = F.col("z")
    return rounded(ca.aipw(treated(spark, sf), F.col("x") / 1000, F.col("t"), F.col("ps"), z * 2 + 1, z), "ate", "se")


@query("q7_e_value", f"WITH {PSQ}, r AS (SELECT z, avg((x > 250000)::INT) FILTER (t) / avg((x > 250000)::INT) FILTER (NOT t) AS rr FROM w GROUP BY 1), m AS (SELECT z, rr, CASE WHEN rr >= 1 THEN rr ELSE 1 / rr END AS m FROM r) SELECT z, round(rr, 6) AS rr, round(m + sqrt(m * (m - 1)), 6) AS e_value FROM m")
def q7(spark, sf):
    y = (F.col("x") > 250000).cast("double")
    r = treated(spark, sf).groupBy("z").agg(F.try_divide(F.avg(F.when(F.col("t"), y)), F.avg(F.when(~F.col("t"), y))).alias("rr"))
    return r.select("z", F.round("rr", 6).alias("rr"), F.round(ca.e_value(F.col("rr")), 6).alias("e_value"))


@query("o1_ols", "SELECT '(intercept)' AS term, round(regr_intercept(l_extendedprice, l_quantity), 4) AS coefficient FROM lineitem UNION ALL SELECT 'l_quantity', round(regr_slope(l_extendedprice, l_quantity), 4) FROM lineitem")
def o1(spark, sf):
    return ca.ols(load(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity"]).select("term", F.round("coefficient", 4).alias("coefficient"))


@query("o1b_glm")
def o1b(spark, sf):
    return rounded(ca.glm(load(spark, sf, "lineitem").withColumn("y", ret().cast("double")), "y", ["l_quantity", "l_discount"], "binomial"), "coefficient", to=4)


@query("o1c_elastic_net")
def o1c(spark, sf):
    from strandline.operators import regress

    d = load(spark, sf, "lineitem").select(ret().cast("double").alias("y"), (F.col("l_quantity") / 50).alias("quantity"), (F.col("l_discount") * 10).alias("discount"), (F.col("l_extendedprice") / 100_000).alias("price"), (F.col("l_tax") - 0.04).alias("offset"), (1 + F.col("l_linenumber") % 3).alias("w"))
    return rounded(regress.elastic_net(d, "y", ["quantity", "discount", "price"], "binomial", [0.05, 0.01, 0.001], 0.5, "offset", "w"), "coefficient", to=5)


@query("o2_cluster_robust")
def o2(spark, sf):
    return rounded(ca.cluster_robust(load(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity", "l_discount"], "l_suppkey"), "coefficient", "se", "hc_se", to=3)


_K = (5.0, 20.0, 35.0, 48.0)
_CUBE = "pow(greatest(l_quantity - {0}, 0), 3)"


@query("o4_rcs", "SELECT DISTINCT l_quantity, " + ", ".join(f"round(({_CUBE.format(k)} - {_CUBE.format(35.0)} * (48.0 - {k}) / 13.0 + {_CUBE.format(48.0)} * (35.0 - {k}) / 13.0) / pow(43.0, 2), 6) AS s{i}" for i, k in enumerate(_K[:2])) + " FROM lineitem")
def o4(spark, sf):
    a, b = ca.rcs(F.col("l_quantity"), list(_K))
    return load(spark, sf, "lineitem").select("l_quantity", F.round(a, 6).alias("s0"), F.round(b, 6).alias("s1")).distinct()


@query("o7_variance_components", """WITH g AS (SELECT user_id, count(*)::DOUBLE AS n, avg(value) AS m, var_pop(value) AS v FROM events GROUP BY 1), s AS (SELECT count(*) AS k, sum(n) AS nn, sum(n * n) AS n2, sum(n * v) AS w, sum(n * m * m) - pow(sum(n * m), 2) / sum(n) AS b FROM g), c AS (SELECT w / (nn - k) AS within, greatest((b / (k - 1) - w / (nn - k)) / ((nn - n2 / nn) / (k - 1)), 0) AS between FROM s)
SELECT round(within, 4) AS within, round(between, 4) AS "between", round(between / (within + between), 6) AS icc FROM c""")
def o7(spark, sf):
    return rounded(rounded(ca.variance_components(ev(spark, sf), "user_id", "value"), "within", "between", to=4), "icc")


@query("o8_impute", "WITH h AS (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS bal FROM customer) SELECT c_custkey, round(coalesce(bal, (SELECT quantile_cont(bal, 0.5) FROM h)), 4) AS bal, bal IS NOT NULL AS bal__measured FROM h")
def o8(spark, sf):
    h = load(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")).alias("bal"))
    return rounded(ca.impute(h, ["bal"]), "bal", to=4)


@query("o9_rubin_pool", """WITH f AS (SELECT event_type AS term, user_id % 5 AS imp, avg(value) AS c, stddev_samp(value) / sqrt(count(*)) AS se FROM events GROUP BY 1, 2), s AS (SELECT term, count(*) AS m, avg(c) AS e, avg(se * se) AS w, var_samp(c) AS b FROM f GROUP BY 1)
SELECT term, m, round(e, 6) AS estimate, round(w, 6) AS within, round(b, 6) AS "between", round(w + (1 + 1 / m) * b, 6) AS total, round((1 + 1 / m) * b / (w + (1 + 1 / m) * b), 6) AS fmi FROM s""")
def o9(spark, sf):
    f = ev(spark, sf).groupBy(F.col("event_type").alias("term"), (F.col("user_id") % 5).alias("imp")).agg(F.avg("value").alias("coefficient"), (F.stddev_samp("value") / F.sqrt(F.count("*"))).alias("se"))
    return rounded(ca.rubin_pool(f), "estimate", "within", "between", "total", "fmi")


@query("p6_schoenfeld")
def p6(spark, sf):
    d = surv(spark, sf).withColumn("x", F.pmod(F.col("user_id"), F.lit(7)).cast("double"))
    return rounded(s.schoenfeld_test(d, "days", F.col("code") == 1, s.cox(d, "days", F.col("code") == 1, ["grp", "x"])), "r", "z")


def holes(spark, sf):
    k = F.col("o_orderkey")
    return load(spark, sf, "orders").select("o_orderkey", F.when(k % 5 != 0, F.col("o_totalprice") / 1e5).alias("price"), F.when(k % 7 != 0, (k % 11).cast("double")).alias("load"), F.year("o_orderdate").alias("yr"))


@query("o9b_mice")
def o9b(spark, sf):
    filled = ca.mice(holes(spark, sf), "o_orderkey", ["price", "load"], ["yr"], 2, 1)
    return filled.groupBy("imp").agg(F.count("*").alias("n"), F.count("price").alias("n_price"), F.round(F.avg("price"), 3).alias("mean_price"), F.round(F.avg("load"), 3).alias("mean_load"))


@query("o10_informative_missing")
def o10(spark, sf):
    return rounded(ca.informative_missing(holes(spark, sf), "price", ["yr"]), "coefficient", to=3)
