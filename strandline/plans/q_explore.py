"""Queries over exploratory aggregation, endpoints, pathways and series (survey 2.10, 2.12 and 2.13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import explore as x
from strandline.operators import pathways as y
from strandline.operators import timeline as t
from strandline.plans.q_temporal import ENC, HOUR, STAY, encounters, stays
from strandline.plans.q_timeline import AL, BIN, aligned, rounded, stay_events
from strandline.plans.registry import query
from strandline.sources.tables import load

DAY = "86400e6::DOUBLE"
LI = "l_quantity, l_extendedprice, l_discount"


@query("j0_aggregate", "SELECT l_returnflag, floor(l_quantity / 10) * 10 AS l_quantity_bin, count(l_orderkey) AS n, count(DISTINCT l_orderkey) AS orders, round(avg(l_extendedprice), 1) AS mean_price, round(quantile_cont(l_discount, 0.9), 6) AS q90 FROM lineitem WHERE l_linestatus = 'O' AND l_quantity >= 5 AND l_quantity < 45 GROUP BY 1, 2")
def j0(spark, sf):
    stats = {"n": ("count", "l_orderkey"), "orders": ("count_distinct", "l_orderkey"), "mean_price": ("mean", "l_extendedprice"), "q90": ("quantile", "l_discount", 0.9)}
    a = x.aggregate(load(spark, sf, "lineitem"), ["l_returnflag", ("l_quantity", 10)], stats, [("l_linestatus", "eq", "O"), ("l_quantity", "range", (5, 45))])
    return a.withColumn("l_quantity_bin", F.col("l_quantity_bin").cast("double")).withColumn("mean_price", F.round("mean_price", 1)).withColumn("q90", F.round("q90", 6))


@query("j1a_histogram2d", "SELECT floor(l_quantity / 5) * 5 AS x, floor(l_extendedprice / 10000) * 10000 AS y, count(*) AS n FROM lineitem GROUP BY 1, 2")
def j1a(spark, sf):
    h = x.histogram2d(load(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 5, 10000)
    return h.withColumn("x", F.col("x").cast("double")).withColumn("y", F.col("y").cast("double"))


def _corr(a, b):
    return f"SELECT '{a}' AS a, '{b}' AS b, count(*) AS n, round(corr({a}, {b}), 6) AS r FROM lineitem"


@query("j1b_corr_matrix", " UNION ALL ".join([_corr("l_quantity", "l_extendedprice"), _corr("l_quantity", "l_discount"), _corr("l_extendedprice", "l_discount")]))
def j1b(spark, sf):
    return x.corr_matrix(load(spark, sf, "lineitem"), LI.split(", ")).withColumn("r", F.round("r", 6))


def _rho(a, b):
    return f"""SELECT '{a}' AS a, '{b}' AS b, count(*) AS n, round(corr(ra, rb), 6) AS rho FROM (SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2 AS ra, rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2 AS rb FROM holes WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""


@query("j1f_spearman", "WITH holes AS (SELECT CASE WHEN l_linenumber <> 2 THEN l_quantity END AS quantity, CASE WHEN l_suppkey % 5 > 0 THEN l_extendedprice END AS price, l_discount AS discount FROM lineitem) " + " UNION ALL ".join([_rho("quantity", "price"), _rho("quantity", "discount"), _rho("price", "discount")]))
def j1f(spark, sf):
    from strandline.operators.inference import spearman_matrix

    d = load(spark, sf, "lineitem").select(F.when(F.col("l_linenumber") != 2, F.col("l_quantity")).alias("quantity"), F.when(F.col("l_suppkey") % 5 > 0, F.col("l_extendedprice")).alias("price"), F.col("l_discount").alias("discount"))
    return rounded(spearman_matrix(d, ["quantity", "price", "discount"]), "rho")


@query("j1c_crosstab", """WITH c AS (SELECT l_returnflag AS r, l_linestatus AS c, count(*) AS n FROM lineitem GROUP BY CUBE(1, 2)) SELECT r AS l_returnflag, c AS l_linestatus, n, round(CASE WHEN r IS NOT NULL AND c IS NOT NULL THEN n / sum(n) FILTER (r IS NOT NULL AND c IS NOT NULL) OVER (PARTITION BY r) END, 6) AS row_share,
round(CASE WHEN r IS NOT NULL AND c IS NOT NULL THEN n / sum(n) FILTER (r IS NOT NULL AND c IS NOT NULL) OVER (PARTITION BY c) END, 6) AS col_share, c IS NULL AS row_total, r IS NULL AS col_total FROM c""")
def j1c(spark, sf):
    return rounded(x.crosstab(load(spark, sf, "lineitem"), "l_returnflag", "l_linestatus"), "row_share", "col_share")


@query("j1d_conditional_summary", "SELECT l_linenumber, count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean, round(quantile_cont(l_extendedprice, 0.05), 4) AS p05, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.95), 4) AS p95 FROM lineitem GROUP BY 1")
def j1d(spark, sf):
    return rounded(x.conditional_summary(load(spark, sf, "lineitem"), "l_linenumber", "l_extendedprice"), "mean", "p05", "p50", "p95", to=4)


@query("j1e_linked_brush", "SELECT 'l_quantity' AS panel, floor(l_quantity / 10) * 10 AS bin, l_discount >= 0.05 AS in_brush, count(*) AS n FROM lineitem GROUP BY 2, 3 UNION ALL SELECT 'l_extendedprice', floor(l_extendedprice / 20000) * 20000, l_discount >= 0.05, count(*) FROM lineitem GROUP BY 2, 3")
def j1e(spark, sf):
    return x.linked_brush(load(spark, sf, "lineitem"), {"l_quantity": 10, "l_extendedprice": 20000}, F.col("l_discount") >= 0.05)


_RATES = f"{ENC}, p AS (SELECT priority, status = 'F' AS ev, coalesce(bool_or(status = 'P') OVER (PARTITION BY subject ORDER BY start, hadm ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS prior, (epoch_us(stop) - epoch_us(start)) / {DAY} AS days FROM enc)"


@query("j2_rates", f"WITH {_RATES} SELECT priority, count(*) AS n, count(*) FILTER (ev) AS events, round(count(*) FILTER (ev OR prior) / count(*), 6) AS prevalence, count(*) FILTER (NOT prior) AS at_risk, round(count(*) FILTER (ev AND NOT prior) / count(*) FILTER (NOT prior), 6) AS incidence, round(1000 * count(*) FILTER (ev) / sum(days), 6) AS per_1000_days FROM p GROUP BY 1")
def j2(spark, sf):
    from pyspark.sql import Window

    e = encounters(spark, sf)
    w = Window.partitionBy("subject").orderBy("start", "hadm").rowsBetween(Window.unboundedPreceding, -1)
    e = e.select("priority", (F.col("status") == "F").alias("ev"), F.coalesce(F.bool_or(F.col("status") == "P").over(w), F.lit(False)).alias("prior"), F.datediff("stop", "start").cast("double").alias("days"))
    return rounded(x.rates(e, ["priority"], "ev", "prior", "days"), "prevalence", "incidence", "per_1000_days")


@query("j3_agresti_coull", """WITH s AS (SELECT l_linenumber, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS x, 1.959963984540054::DOUBLE AS z FROM lineitem GROUP BY 1), m AS (SELECT *, n + z * z AS m, (x + z * z / 2) / (n + z * z) AS p FROM s)
SELECT l_linenumber, round(p - z * sqrt(p * (1 - p) / m), 6) AS low, round(p + z * sqrt(p * (1 - p) / m), 6) AS high FROM m""")
def j3(spark, sf):
    s = load(spark, sf, "lineitem").groupBy("l_linenumber").agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("x"))
    lo, hi = x.ci_agresti_coull(F.col("x"), F.col("n"))
    return s.select("l_linenumber", F.round(lo, 6).alias("low"), F.round(hi, 6).alias("high"))


@query("j4_subgroups", " UNION ALL ".join(f"SELECT '{d}' AS dim, {lv} AS level, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS events, round(count(*) FILTER (l_returnflag = 'R') / count(*), 6) AS share FROM lineitem GROUP BY {lv}" for d, lv in (("l_linestatus", "l_linestatus"), ("l_linenumber", "l_linenumber::VARCHAR"))) + " UNION ALL SELECT 'overall', 'all', count(*), count(*) FILTER (l_returnflag = 'R'), round(count(*) FILTER (l_returnflag = 'R') / count(*), 6) FROM lineitem")
def j4(spark, sf):
    li = load(spark, sf, "lineitem").withColumn("ret", F.col("l_returnflag") == "R")
    return x.subgroups(li, ["l_linestatus", "l_linenumber"], "ret").withColumn("share", F.round("share", 6))


@query("j4b_overlap", "SELECT 'big' AS a, 'big' AS b, count(*) FILTER (l_quantity > 40) AS n FROM lineitem UNION ALL SELECT 'big', 'off', count(*) FILTER (l_quantity > 40 AND l_discount > 0.05) FROM lineitem UNION ALL SELECT 'off', 'off', count(*) FILTER (l_discount > 0.05) FROM lineitem")
def j4b(spark, sf):
    return x.overlap(load(spark, sf, "lineitem").select((F.col("l_quantity") > 40).alias("big"), (F.col("l_discount") > 0.05).alias("off")), ["big", "off"])


def _level(d, lv):
    return f"SELECT '{d}' AS dim, {lv} AS level, count(*) AS n, count(y) AS n_known, round(avg(y), 4) AS mean, round(stddev_samp(y), 4) AS sd, round(quantile_cont(y, 0.25), 4) AS p25, round(quantile_cont(y, 0.5), 4) AS median, round(quantile_cont(y, 0.75), 4) AS p75 FROM h GROUP BY {lv}"


@query("j4c_subgroup_means", "WITH h AS (SELECT *, CASE WHEN l_linenumber <> 3 OR l_tax > 0.02 THEN l_extendedprice END AS y FROM lineitem) " + " UNION ALL ".join([_level("l_linestatus", "l_linestatus"), _level("l_linenumber", "l_linenumber::VARCHAR"), _level("overall", "'all'")]))
def j4c(spark, sf):
    li = load(spark, sf, "lineitem").withColumn("y", F.when((F.col("l_linenumber") != 3) | (F.col("l_tax") > 0.02), F.col("l_extendedprice")))
    return rounded(x.subgroup_means(li, ["l_linestatus", "l_linenumber"], "y"), "mean", "sd", "p25", "median", "p75", to=4)


@query("j5b_table_groups", """SELECT 'o_totalprice' AS variable, NULL AS level, o_orderstatus AS "group", count(o_totalprice) AS n, NULL::DOUBLE AS share, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS sd, round(quantile_cont(o_totalprice, 0.25), 4) AS p25, round(quantile_cont(o_totalprice, 0.5), 4) AS median, round(quantile_cont(o_totalprice, 0.75), 4) AS p75 FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'o_orderpriority', o_orderpriority, o_orderstatus, count(*), round(count(*) / sum(count(*)) OVER (PARTITION BY o_orderstatus), 6), NULL, NULL, NULL, NULL, NULL FROM orders GROUP BY o_orderpriority, o_orderstatus""")
def j5b(spark, sf):
    t = x.table_groups(load(spark, sf, "orders"), "o_orderstatus", ["o_totalprice"], ["o_orderpriority"])
    return rounded(rounded(t, "mean", "sd", "p25", "median", "p75", to=4), "share")


@query("j5_table1", """WITH g AS (SELECT o_totalprice AS v, o_orderpriority AS c, o_orderstatus AS s FROM orders WHERE o_orderstatus IN ('F', 'O')),
n AS (SELECT c, count(*) FILTER (s = 'F') AS na, count(*) FILTER (s = 'O') AS nb FROM g GROUP BY 1), q AS (SELECT *, na / sum(na) OVER () AS pa, nb / sum(nb) OVER () AS pb FROM n)
SELECT 'o_totalprice' AS variable, NULL AS level, count(v) FILTER (s = 'F') AS n_a, round(avg(v) FILTER (s = 'F'), 4) AS stat_a, count(v) FILTER (s = 'O') AS n_b, round(avg(v) FILTER (s = 'O'), 4) AS stat_b, 0::BIGINT AS missing, round((avg(v) FILTER (s = 'F') - avg(v) FILTER (s = 'O')) / sqrt((var_samp(v) FILTER (s = 'F') + var_samp(v) FILTER (s = 'O')) / 2), 6) AS smd FROM g
UNION ALL SELECT 'o_orderpriority', c, na, round(pa, 4), nb, round(pb, 4), 0, round((pa - pb) / sqrt((pa * (1 - pa) + pb * (1 - pb)) / 2), 6) FROM q""")
def j5(spark, sf):
    out = x.table1(load(spark, sf, "orders"), "o_orderstatus", ("F", "O"), ["o_totalprice"], ["o_orderpriority"])
    return rounded(rounded(out, "stat_a", "stat_b", to=4), "smd").withColumn("missing", F.col("missing").cast("long"))


WIDE = "w AS (SELECT u.user_id, a.v AS a, b.v AS b, c.v AS c, (u.user_id % 2 = 0) AS y FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN (SELECT user_id, max(value) AS v FROM events WHERE event_type = 'click' AND value > 180 GROUP BY 1) a ON u.user_id = a.user_id LEFT JOIN (SELECT user_id, max(value) AS v FROM events WHERE event_type = 'view' AND value > 200 GROUP BY 1) b ON u.user_id = b.user_id LEFT JOIN (SELECT user_id, max(value) AS v FROM events WHERE event_type = 'error' AND value > 220 GROUP BY 1) c ON u.user_id = c.user_id)"


def wide(spark, sf):
    e = load(spark, sf, "events")
    pick = lambda k, lo: F.max(F.when((F.col("event_type") == k) & (F.col("value") > lo), F.col("value")))
    return e.groupBy("user_id").agg(pick("click", 180).alias("a"), pick("view", 200).alias("b"), pick("error", 220).alias("c"), F.first(F.col("user_id") % 2 == 0).alias("y"))


@query("j6_missing_patterns", f"WITH {WIDE}, s AS (SELECT (a IS NOT NULL)::INT::VARCHAR || (b IS NOT NULL)::INT::VARCHAR || (c IS NOT NULL)::INT::VARCHAR AS pattern, count(*) AS n FROM w GROUP BY 1) SELECT pattern, n, round(n / sum(n) OVER (), 6) AS share FROM s ORDER BY n DESC, pattern LIMIT 5")
def j6(spark, sf):
    return x.missing_patterns(wide(spark, sf), ["a", "b", "c"], 5).withColumn("share", F.round("share", 6))


@query("j6b_co_missing", f"WITH {WIDE} SELECT 'a' AS a, 'b' AS b, count(*) FILTER (w.a IS NULL AND w.b IS NULL) AS \"both\", round(count(*) FILTER (w.a IS NULL AND w.b IS NULL) / nullif(count(*) FILTER (w.a IS NULL OR w.b IS NULL), 0), 6) AS jaccard FROM w UNION ALL SELECT 'a', 'c', count(*) FILTER (w.a IS NULL AND c IS NULL), round(count(*) FILTER (w.a IS NULL AND c IS NULL) / nullif(count(*) FILTER (w.a IS NULL OR c IS NULL), 0), 6) FROM w UNION ALL SELECT 'b', 'c', count(*) FILTER (w.b IS NULL AND c IS NULL), round(count(*) FILTER (w.b IS NULL AND c IS NULL) / nullif(count(*) FILTER (w.b IS NULL OR c IS NULL), 0), 6) FROM w")
def j6b(spark, sf):
    return x.co_missing(wide(spark, sf), ["a", "b", "c"]).withColumn("jaccard", F.round("jaccard", 6))


@query("j6c_informative_presence", f"""WITH {WIDE}, s AS (SELECT count(*) FILTER (y AND c IS NOT NULL) AS x1, count(*) FILTER (c IS NOT NULL) AS n1, count(*) FILTER (y AND c IS NULL) AS x0, count(*) FILTER (c IS NULL) AS n0 FROM w), r AS (SELECT *, ln((x1 / n1) / (x0 / n0)) AS r, sqrt(1 / x1 - 1 / n1 + 1 / x0 - 1 / n0) AS se FROM s)
SELECT 'c' AS "column", round(x1 / n1, 6) AS rate_measured, round(x0 / n0, 6) AS rate_missing, round(exp(r), 6) AS ratio, round(exp(r - 1.959963984540054::DOUBLE * se), 6) AS low, round(exp(r + 1.959963984540054::DOUBLE * se), 6) AS high FROM r""")
def j6c(spark, sf):
    return rounded(x.informative_presence(wide(spark, sf), ["c"], F.col("y")), "rate_measured", "rate_missing", "ratio", "low", "high")


@query("j7_measurement_frequency", f"WITH {STAY}, l AS (SELECT user_id, session, intime, (epoch_us(outtime) - epoch_us(intime)) / {HOUR} AS len FROM stays), g AS (SELECT user_id, session, b AS bin FROM l, range(0, 25) r(b) WHERE b <= len), m AS (SELECT DISTINCT e.user_id, e.session, floor((epoch_us(ts) - epoch_us(intime)) / {HOUR})::BIGINT AS bin FROM sess e JOIN l ON e.user_id = l.user_id AND e.session = l.session) SELECT g.bin, count(*) AS at_risk, count(m.bin) AS measured, round(count(m.bin) / count(*), 6) AS share FROM g LEFT JOIN m ON g.user_id = m.user_id AND g.session = m.session AND g.bin = m.bin GROUP BY 1")
def j7(spark, sf):
    s = stays(spark, sf).withColumn("len", (F.unix_micros(F.col("outtime").cast("timestamp")) - F.unix_micros(F.col("intime").cast("timestamp"))) / 3600e6)
    bins = stay_events(spark, sf).withColumn("bin", F.floor("hours_since_anchor"))
    return x.measurement_frequency(s, ["user_id", "session"], "len", bins, 24).withColumn("share", F.round("share", 6))


@query("j7b_structural_absence", "WITH s AS (SELECT event_type, (user_id % 4)::INT AS era, count(*) AS n, avg((value > 250 AND event_type <> 'view')::INT) AS sh FROM events GROUP BY 1, 2) SELECT event_type, era, n, round(sh, 6) AS share, CASE WHEN sh = 0 AND n >= 50 THEN 'structural' WHEN sh < 0.05 THEN 'sparse' ELSE 'present' END AS verdict FROM s")
def j7b(spark, sf):
    e = load(spark, sf, "events").withColumn("era", (F.col("user_id") % 4).cast("int"))
    return x.structural_absence(e, "event_type", "era", (F.col("value") > 250) & (F.col("event_type") != "view")).withColumn("share", F.round("share", 6))


@query("j8_distinct_levels", "SELECT DISTINCT p_brand, false AS truncated FROM part")
def j8(spark, sf):
    return x.distinct_levels(load(spark, sf, "part"), "p_brand", 50)


@query("j8b_top_per_group", "SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey)::INT AS rank FROM part QUALIFY rank <= 3")
def j8b(spark, sf):
    return x.top_per_group(load(spark, sf, "part"), "p_brand", [F.desc("p_retailprice"), F.col("p_partkey")], 3).select("p_brand", "p_partkey", "rank")


@query("j9_set_ops", "SELECT 'union' AS op, count(*) AS n FROM (SELECT o_custkey FROM orders UNION ALL SELECT c_custkey FROM customer) UNION ALL SELECT 'intersect', count(*) FROM (SELECT o_custkey FROM orders INTERSECT SELECT c_custkey FROM customer) UNION ALL SELECT 'except_all', count(*) FROM (SELECT l_orderkey FROM lineitem EXCEPT ALL SELECT o_orderkey FROM orders)")
def j9(spark, sf):
    o, c, li = load(spark, sf, "orders"), load(spark, sf, "customer"), load(spark, sf, "lineitem")
    n = lambda name, df: df.agg(F.lit(name).alias("op"), F.count(F.lit(1)).alias("n"))
    a, b = o.select(F.col("o_custkey").alias("k")), c.select(F.col("c_custkey").alias("k"))
    return n("union", a.unionByName(b)).unionByName(n("intersect", a.intersect(b))).unionByName(n("except_all", li.select(F.col("l_orderkey").alias("k")).exceptAll(o.select(F.col("o_orderkey").alias("k")))))


@query("l1_endpoints", f"""WITH {ENC} SELECT hadm, count(*) OVER (PARTITION BY subject ORDER BY epoch_us(start) RANGE BETWEEN 1 FOLLOWING AND {30 * 86400 * 10**6} FOLLOWING) AS repeats_30d, CASE status WHEN 'O' THEN 0 WHEN 'F' THEN 1 END::INT AS ordinal, status = 'F' AS binary, round((epoch_us(stop) - epoch_us(start)) / {DAY}, 6) AS los FROM enc""")
def l1(spark, sf):
    return encounters(spark, sf).select("hadm", y.repeats_within("subject", "start", 30).alias("repeats_30d"), y.endpoint_ordinal(F.col("status"), ["O", "F"]).alias("ordinal"), (F.col("status") == "F").alias("binary"), F.round(y.length_of_stay("start", "stop"), 6).alias("los"))


TTE = f"u AS (SELECT user_id, min(ts) AS o, min(ts) FILTER (event_type = 'error' AND value > 150) AS e, min(ts) FILTER (event_type = 'purchase' AND value > 150) AS c, max(ts) AS l FROM events GROUP BY 1), tt AS (SELECT user_id, least((epoch_us(l) - epoch_us(o)) / {DAY}, 20) AS cens, (epoch_us(e) - epoch_us(o)) / {DAY} AS te, (epoch_us(c) - epoch_us(o)) / {DAY} AS tc FROM u), tte AS (SELECT user_id, least(coalesce(te, cens), coalesce(tc, cens), cens) AS days, CASE WHEN te <= least(coalesce(te, cens), coalesce(tc, cens), cens) THEN 1 WHEN tc <= least(coalesce(te, cens), coalesce(tc, cens), cens) THEN 2 ELSE 0 END AS code FROM tt)"


def tte(spark, sf):
    from strandline.functions.timesem import days_since

    e = load(spark, sf, "events")
    at = lambda k: F.min(F.when((F.col("event_type") == k) & (F.col("value") > 150), F.col("ts")))
    u = e.groupBy("user_id").agg(F.min("ts").alias("o"), at("error").alias("e"), at("purchase").alias("c"), F.max("ts").alias("l"))
    days, code = y.time_to_event("o", "e", "c", days_since("o", "l"), 20.0)
    return u.select("user_id", days.alias("days"), code.alias("code"))


@query("l2_time_to_event", f"WITH {TTE} SELECT user_id, round(days, 6) AS days, code FROM tte")
def l2(spark, sf):
    return rounded(tte(spark, sf), "days")


@query("l3_readmissions", f"WITH {ENC}, g AS (SELECT hadm, (epoch_us(lead(start) OVER (PARTITION BY subject ORDER BY start, hadm)) - epoch_us(stop)) / {DAY} AS d FROM enc) SELECT hadm, round(d, 6) AS days_to_next, coalesce(d BETWEEN 0 AND 30, false) AS readmitted FROM g")
def l3(spark, sf):
    return rounded(y.readmissions(encounters(spark, sf), "subject", "start", "stop", "hadm", 30).select("hadm", "days_to_next", "readmitted"), "days_to_next")


@query("l4_utilization", f"WITH {ENC} SELECT priority, count(*) AS n, count(DISTINCT subject) AS n_subjects, round(100 * count(*) / (sum(365.25::DOUBLE) / 365.25::DOUBLE), 6) AS per_100_years, round(1000 * count(*) / sum((epoch_us(stop) - epoch_us(start)) / {DAY}), 6) AS per_1000_bed_days FROM enc GROUP BY 1")
def l4(spark, sf):
    e = encounters(spark, sf).withColumn("days", F.datediff("stop", "start")).withColumn("py", F.lit(365.25))
    return rounded(y.utilization_rates(e, ["priority"], "subject", "py", "days"), "per_100_years", "per_1000_bed_days")


PATH = "c AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events), k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM c WHERE p IS NULL OR p <> event_type), pa AS (SELECT user_id, list(event_type ORDER BY r) FILTER (r <= {0}) AS path, count(*) AS n_steps FROM k GROUP BY 1)"


@query("l5_sequences", f"WITH {PATH.format(6)} SELECT user_id, array_to_string(path, '>') AS path, n_steps FROM pa")
def l5(spark, sf):
    s = y.sequences(load(spark, sf, "events"), "user_id", "ts", "event_id", "event_type", True, 6)
    return s.select("user_id", F.concat_ws(">", "path").alias("path"), "n_steps")


@query("l6_top_pathways", f"WITH {PATH.format(2)} SELECT array_to_string(path, '>') AS pathway, count(*) AS n FROM pa GROUP BY 1 ORDER BY n DESC, pathway LIMIT 8")
def l6(spark, sf):
    return y.top_pathways(y.sequences(load(spark, sf, "events"), "user_id", "ts", "event_id", "event_type", True, 2), 8)


@query("l7_transition_matrix", "WITH t AS (SELECT event_type AS state, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS following FROM events), n AS (SELECT state, following, count(*) AS n FROM t WHERE following IS NOT NULL GROUP BY 1, 2) SELECT *, round(n / sum(n) OVER (PARTITION BY state), 6) AS share FROM n")
def l7(spark, sf):
    return y.transition_matrix(load(spark, sf, "events"), "user_id", "ts", "event_id", "event_type").withColumn("share", F.round("share", 6))


DEL = f"a AS (SELECT user_id, min(ts) AS t FROM events WHERE event_type = 'click' GROUP BY 1), dl AS (SELECT a.user_id, (epoch_us(min(e.ts)) - epoch_us(any_value(a.t))) / {HOUR} AS hours FROM a LEFT JOIN events e ON a.user_id = e.user_id AND e.event_type = 'purchase' AND e.ts > a.t GROUP BY 1)"


@query("l8_delays", f"WITH {DEL} SELECT (user_id % 3)::INT AS grp, count(*) AS n, count(hours) AS n_reached, round(quantile_cont(hours, 0.5), 4) AS median, round(quantile_cont(hours, 0.75) - quantile_cont(hours, 0.25), 4) AS iqr FROM dl GROUP BY 1")
def l8(spark, sf):
    d = y.first_after(load(spark, sf, "events"), "user_id", "ts", F.col("event_type") == "click", F.col("event_type") == "purchase")
    return rounded(y.delay_summary(d.withColumn("grp", (F.col("user_id") % 3).cast("int")), ["grp"]), "median", "iqr", to=4)


@query("l9_cooccurrence", "SELECT floor((epoch_us(b.ts) - epoch_us(a.ts)) / 3600e6)::BIGINT AS lag, count(*) AS n FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 12 HOUR WHERE a.event_type = 'view' AND b.event_type = 'click' GROUP BY 1")
def l9(spark, sf):
    from strandline.operators.joins import window_join

    e = load(spark, sf, "events")
    a, b = e.where("event_type = 'view'").select("user_id", F.col("ts").alias("a_ts")), e.where("event_type = 'click'").select("user_id", F.col("ts").alias("b_ts"))
    return window_join(a, b, ["user_id"], "a_ts", "b_ts", 0, 12).groupBy(F.floor("lag_hours").alias("lag")).agg(F.count("*").alias("n"))


@query("l10_loops", f"WITH {PATH.format(20)} SELECT user_id, len(path) - len(list_distinct(path)) AS n_returns FROM pa")
def l10(spark, sf):
    return y.loops(y.sequences(load(spark, sf, "events"), "user_id", "ts", "event_id", "event_type")).select("user_id", F.col("n_returns").cast("long").alias("n_returns"))


@query("l11_exposure_order", "WITH f AS (SELECT user_id, event_type, min((ts, event_id)) AS t FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t) AS r FROM f) SELECT user_id, max(event_type) FILTER (r = 1) AS first_agent, max(event_type) FILTER (r = 2) AS second_agent FROM r GROUP BY 1")
def l11(spark, sf):
    return y.exposure_order(load(spark, sf, "events"), "user_id", "ts", "event_id", "event_type")


@query("l12_first_exposure_lag", f"WITH {DEL} SELECT least(floor(hours / 6), 8)::BIGINT AS band, count(*) AS n FROM dl WHERE hours IS NOT NULL GROUP BY 1")
def l12(spark, sf):
    d = y.first_after(load(spark, sf, "events"), "user_id", "ts", F.col("event_type") == "click", F.col("event_type") == "purchase")
    return d.where("hours is not null").groupBy(F.least(F.floor(F.col("hours") / 6), F.lit(8)).cast("long").alias("band")).agg(F.count("*").alias("n"))


@query("l13_dose_summary", f"WITH {ENC} SELECT subject, max(price) AS highest, round(sum(price * (epoch_us(stop) - epoch_us(start)) / {HOUR}) / sum((epoch_us(stop) - epoch_us(start)) / {HOUR}), 1) AS weighted_mean, round(sum(price * (epoch_us(stop) - epoch_us(start)) / {HOUR}), 0) AS cumulative FROM enc GROUP BY 1")
def l13(spark, sf):
    return rounded(y.dose_summary(encounters(spark, sf), ["subject"], "price", "start", "stop"), "weighted_mean", to=1).withColumn("cumulative", F.round("cumulative", 0))


@query("l14_exposure_prevalence", "SELECT year(o_orderdate)::INT AS era, o_orderpriority, count(*) AS n, round(avg((o_totalprice > 200000)::INT), 6) AS exposed FROM orders GROUP BY 1, 2")
def l14(spark, sf):
    o = load(spark, sf, "orders")
    return o.groupBy(F.year("o_orderdate").alias("era"), "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.avg((F.col("o_totalprice") > 200000).cast("double")), 6).alias("exposed"))


@query("l15_trajectory", f"""WITH d AS (SELECT user_id, value AS v, (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY user_id))) / {HOUR} AS h, lag(value) OVER q AS pv, lag(ts) OVER q AS pt, min(ts) OVER (PARTITION BY user_id) AS t0, event_id FROM events WINDOW q AS (PARTITION BY user_id ORDER BY ts, event_id)), e AS (SELECT *, (epoch_us(pt) - epoch_us(t0)) / {HOUR} AS ph FROM d)
SELECT user_id, count(*) AS n, round(regr_slope(v, h), 6) AS slope, round(stddev_samp(v), 6) AS sd, round(stddev_samp(v) / avg(v), 6) AS cv, round(sqrt(avg((v - pv) * (v - pv))), 6) AS rmssd, count(*) FILTER ((v > 50) <> (pv > 50)) AS crossings, round(min(h) FILTER (v <= 50), 6) AS hours_to_normal,
round(sum((h - ph) * (v + pv) / 2), 3) AS auc, max(v) AS peak, round(arg_max(h, (v, -h)), 6) AS peak_hour, round(count(*) / (max(h) / 24), 6) AS per_day FROM e GROUP BY 1""")
def l15(spark, sf):
    f = y.trajectory_features(load(spark, sf, "events"), "user_id", "ts", "event_id", "value", 50)
    return rounded(rounded(f, "slope", "sd", "cv", "rmssd", "hours_to_normal", "peak_hour", "per_day"), "auc", to=3)


@query("l16_cumulative", f"WITH {ENC} SELECT hadm, round(sum((epoch_us(stop) - epoch_us(start)) / {DAY}) OVER (PARTITION BY subject ORDER BY start, hadm ROWS UNBOUNDED PRECEDING), 4) AS days_so_far FROM enc")
def l16(spark, sf):
    return encounters(spark, sf).select("hadm", F.round(y.cumulative("subject", "start", "hadm", F.datediff("stop", "start")), 4).cast("double").alias("days_so_far"))


GRID = f"WITH {AL}, b AS ({BIN.format(6)}), k AS (SELECT user_id, b AS bin FROM (SELECT DISTINCT user_id FROM b), range(-4, 12) r(b)), f AS (SELECT k.user_id, k.bin, mean FROM k LEFT JOIN b ON k.user_id = b.user_id AND k.bin = b.bin), i AS (SELECT *, last_value(CASE WHEN mean IS NOT NULL THEN bin END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY bin) AS pb, last_value(mean IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY bin) AS pv, first_value(CASE WHEN mean IS NOT NULL THEN bin END IGNORE NULLS) OVER w AS nb, first_value(mean IGNORE NULLS) OVER w AS nv FROM f WINDOW w AS (PARTITION BY user_id ORDER BY bin ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), lin AS (SELECT user_id, bin, CASE WHEN pb = nb THEN pv ELSE pv + (nv - pv) * (bin - pb) / (nb - pb) END AS filled, CASE WHEN bin - pb <= 2 THEN pv END AS ff FROM i)"


def grid(spark, sf):
    return t.fill_bins(t.binned(aligned(spark, sf), ["user_id"], "value", "event_id", 6), ["user_id"], -4, 11)


@query("m1_fill_series", GRID + " SELECT user_id, bin, round(filled, 6) AS linear, round(ff, 6) AS ffill FROM lin")
def m1(spark, sf):
    a = y.fill_series(grid(spark, sf), ["user_id"], "bin", "mean", "linear").withColumnRenamed("filled", "linear")
    b = y.fill_series(a, ["user_id"], "bin", "mean", "ffill", 2)
    return b.select("user_id", "bin", F.round("linear", 6).alias("linear"), F.round("filled", 6).alias("ffill"))


@query("m2_smooth", "SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS smooth FROM events")
def m2(spark, sf):
    return load(spark, sf, "events").select("event_id", F.round(y.rolling_mean(["user_id"], ["ts", "event_id"], "value", 5), 6).alias("smooth"))


@query("m2b_ewma", "WITH s AS (SELECT user_id, list(value ORDER BY ts, event_id) AS v FROM events GROUP BY 1) SELECT user_id, len(v)::INT AS n, round(list_reduce(v, lambda a, x: 0.3::DOUBLE * x + 0.7::DOUBLE * a), 6) AS last_ewma FROM s")
def m2b(spark, sf):
    return rounded(y.ewma(load(spark, sf, "events"), "user_id", ["ts", "event_id"], "value", 0.3), "last_ewma")


@query("m3_ccf", f"WITH {AL}, b AS (SELECT user_id, floor(h / 6)::BIGINT AS bin, avg(value) FILTER (event_type = 'click') AS x, avg(value) FILTER (event_type = 'view') AS y FROM al GROUP BY 1, 2) SELECT g AS lag, count(*) AS n, round(corr(a.x, c.y), 6) AS r FROM b a CROSS JOIN range(-3, 4) r(g) JOIN b c ON a.user_id = c.user_id AND c.bin = a.bin + g WHERE a.x IS NOT NULL AND c.y IS NOT NULL GROUP BY 1")
def m3(spark, sf):
    a = aligned(spark, sf).groupBy("user_id", F.floor(F.col("hours_since_anchor") / 6).alias("bin")).agg(F.avg(F.when(F.col("event_type") == "click", F.col("value"))).alias("x"), F.avg(F.when(F.col("event_type") == "view", F.col("value"))).alias("y"))
    return y.ccf(a, "user_id", "bin", "x", "y", 3).withColumn("r", F.round("r", 6))


@query("m4_rolling_origin", GRID + """, z AS (SELECT * FROM lin WHERE filled IS NOT NULL), o AS (SELECT user_id, bin, filled AS l, avg(filled) OVER q AS m, (filled - first_value(filled) OVER q) / nullif(bin - first_value(bin) OVER q, 0) AS s FROM z WINDOW q AS (PARTITION BY user_id ORDER BY bin ROWS UNBOUNDED PRECEDING)),
j AS (SELECT o.*, k AS h, z.filled AS y FROM o CROSS JOIN range(1, 4) r(k) JOIN z ON z.user_id = o.user_id AND z.bin = o.bin + k WHERE o.bin >= 0 AND o.bin % 2 = 0), fc AS (SELECT y, 'naive' AS model, l AS f FROM j UNION ALL SELECT y, 'mean', m FROM j UNION ALL SELECT y, 'drift', l + s * h FROM j)
SELECT model, count(*) AS n, round(avg(abs(y - f)), 4) AS mae, round(sqrt(avg((y - f) * (y - f))), 4) AS rmse FROM fc WHERE f IS NOT NULL GROUP BY 1""")
def m4(spark, sf):
    f = y.fill_series(grid(spark, sf), ["user_id"], "bin", "mean", "linear").where("filled is not null").select("user_id", "bin", "filled")
    return rounded(y.rolling_origin(f, "user_id", "bin", "filled", 0, 2, 3), "mae", "rmse", to=4)


@query("m5_change_point", """WITH p AS (SELECT user_id, count(*) OVER q AS n, sum(value) OVER q AS s, count(*) OVER (PARTITION BY user_id) AS nn, sum(value) OVER (PARTITION BY user_id) AS ss FROM events WINDOW q AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
g AS (SELECT user_id, n, s * s / n + (ss - s) * (ss - s) / (nn - n) - ss * ss / nn AS g FROM p WHERE n >= 2 AND nn - n >= 2) SELECT user_id, n AS at, round(g, 3) AS gain FROM g QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY round(g, 6) DESC, n) = 1""")
def m5(spark, sf):
    return y.change_point(load(spark, sf, "events"), "user_id", ["ts", "event_id"], "value").withColumn("gain", F.round("gain", 3))


@query("m5b_change_points")
def m5b(spark, sf):
    return y.change_points(load(spark, sf, "events"), "user_id", ["ts", "event_id"], "value", 8.0).withColumn("gain", F.round("gain", 3))


@query("m5c_first_splits", """WITH p AS (SELECT user_id, count(*) OVER q AS n, sum(value) OVER q AS s, count(*) OVER w AS nn, sum(value) OVER w AS ss, var_samp(value) OVER w AS v FROM events WINDOW q AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), w AS (PARTITION BY user_id)),
g AS (SELECT user_id, n, v, s * s / n + (ss - s) * (ss - s) / (nn - n) - ss * ss / nn AS g FROM p WHERE n >= 2 AND nn - n >= 2) SELECT user_id, n AS at, round(g, 3) AS gain, 1 AS round FROM g WHERE g >= 4 * v QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY round(g, 6) DESC, n) = 1""")
def m5c(spark, sf):
    return y.change_points(load(spark, sf, "events"), "user_id", ["ts", "event_id"], "value", 4.0, rounds=1).withColumn("gain", F.round("gain", 3))
