"""Queries over code sets, phenotypes and cohorts (survey 2.8 and 2.9), and the tracer."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import cohorts as c
from strandline.operators import disclosure
from strandline.operators import phenotypes as p
from strandline.operators import windows as w
from strandline.plans.q_temporal import ENC, HOUR, encounters
from strandline.plans.q_timeline import rounded
from strandline.plans.registry import query
from strandline.sources.tables import load, scratch

ROLL = "WINDOW q AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL {0} HOUR PRECEDING AND CURRENT ROW)"


def members(spark, sf):
    d = load(spark, sf, "part").groupBy(F.upper("p_type").alias("code")).agg(F.min("p_brand").alias("label"))
    return p.compile_codeset(d, "code", "label", [("prefix", "PRO"), ("exact", "ECONOMY"), ("exact", "NOSUCH"), ("regex", "^S.*D$")])


@query("h1_compile_codeset", """WITH d AS (SELECT upper(p_type) AS code, min(p_brand) AS label FROM part GROUP BY 1), r AS (SELECT code, label, 'prefix:PRO' AS rule, true AS m FROM d WHERE starts_with(code, 'PRO') UNION ALL SELECT code, label, 'exact:ECONOMY', true FROM d WHERE code = 'ECONOMY'
UNION ALL SELECT 'NOSUCH', NULL, 'exact:NOSUCH', false UNION ALL SELECT code, label, 'regex:^S.*D$', true FROM d WHERE regexp_matches(code, '^S.*D$')) SELECT code, max(label) AS label, min(rule) AS rule, bool_or(m) AS matched_in_dictionary FROM r GROUP BY 1""")
def h1(spark, sf):
    return members(spark, sf)


@query("h2_leaf_diagnosis", """SELECT o_custkey, true AS flag, min(o_orderdate) AS first FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey WHERE upper(p_type) LIKE 'PRO%' OR upper(p_type) = 'ECONOMY' OR regexp_matches(upper(p_type), '^S.*D$') GROUP BY 1 HAVING count(DISTINCT o_orderkey) >= 8""")
def h2(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    pt = load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.upper("p_type").alias("code"))
    li = load(spark, sf, "lineitem").select("l_partkey", F.col("l_orderkey").alias("o_orderkey")).join(pt, "l_partkey").join(o, "o_orderkey")
    return p.leaf_codes(li, "o_custkey", "o_orderdate", "code", members(spark, sf), 8, "o_orderkey")


def dx(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    pt = load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.upper("p_type").alias("code"), "p_brand", "p_name")
    return load(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey").join(pt, "l_partkey").join(o, "o_orderkey")


DX = "dx AS (SELECT o_custkey, o_orderkey, o_orderdate, upper(p_type) AS code, p_brand, p_name, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey)"


@query("h3_leaf_medication", f"WITH {DX} SELECT o_custkey, true AS flag, min(o_orderdate) AS first FROM dx WHERE contains(lower(p_brand), 'brand#1') GROUP BY 1 HAVING count(*) >= 20")
def h3(spark, sf):
    return p.leaf(dx(spark, sf), "o_custkey", "o_orderdate", F.lower("p_brand").contains("brand#1"), 20)


@query("h4_leaf_lab", "SELECT user_id, true AS flag, min(ts) AS first FROM events WHERE event_type IN ('click', 'view') AND value > 100 GROUP BY 1 HAVING count(*) >= 2")
def h4(spark, sf):
    return p.leaf(load(spark, sf, "events"), "user_id", "ts", F.col("event_type").isin("click", "view") & (F.col("value") > 100), 2)


@query("h5_leaf_concept", f"SELECT user_id, true AS flag, min(ts) AS first FROM (SELECT *, min(ts) OVER (PARTITION BY user_id) AS f FROM events) WHERE value >= 150 AND (epoch_us(ts) - epoch_us(f)) / {HOUR} <= 48 GROUP BY 1")
def h5(spark, sf):
    from strandline.functions.timesem import hours_since

    e = load(spark, sf, "events")
    e = e.join(e.groupBy("user_id").agg(F.min("ts").alias("f")), "user_id")
    return p.leaf(e, "user_id", "ts", (F.col("value") >= 150) & (hours_since("f", "ts") <= 48))


@query("h6_temporal", "SELECT a.user_id, true AS flag, min(a.ts) AS first FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 24 HOUR WHERE a.event_type = 'error' AND b.event_type = 'purchase' GROUP BY 1")
def h6(spark, sf):
    e = load(spark, sf, "events").withColumnRenamed("ts", "time")
    return p.temporal(e.where("event_type = 'error'"), e.where("event_type = 'purchase'"), "user_id", "within_hours", 24)


TREE = """la AS (SELECT user_id, min(ts) AS a FROM events WHERE event_type = 'error' AND value > 150 GROUP BY 1), lb AS (SELECT user_id, min(ts) AS b FROM events WHERE event_type = 'purchase' GROUP BY 1 HAVING count(*) >= 12),
lc AS (SELECT user_id, min(ts) AS c FROM events WHERE event_type = 'signup' AND value > 300 GROUP BY 1), j AS (SELECT u.user_id, a, b, c, (a IS NOT NULL OR b IS NOT NULL) AND c IS NULL AS positive FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN la ON u.user_id = la.user_id LEFT JOIN lb ON u.user_id = lb.user_id LEFT JOIN lc ON u.user_id = lc.user_id)"""


def tree(spark, sf):
    e = load(spark, sf, "events")
    t = F.col("event_type")
    leaves = {"a": p.leaf(e, "user_id", "ts", (t == "error") & (F.col("value") > 150)), "b": p.leaf(e, "user_id", "ts", t == "purchase", 12), "c": p.leaf(e, "user_id", "ts", (t == "signup") & (F.col("value") > 300))}
    return p.phenotype(e, "user_id", leaves, (F.col("a") | F.col("b")) & ~F.col("c"), ("a", "b"))


@query("h7_phenotype", f"""WITH {TREE} SELECT user_id, positive, CASE WHEN positive THEN least(a, b) END AS onset, '{{"a":' || (a IS NOT NULL) || ',"b":' || (b IS NOT NULL) || ',"c":' || (c IS NOT NULL) || '}}' AS evidence FROM j""")
def h7(spark, sf):
    return tree(spark, sf)


@query("h8_phenotype_summary", f"WITH {TREE}, s AS (SELECT (user_id % 3)::INT AS era, count(*) AS n, count(*) FILTER (positive) AS x FROM j GROUP BY 1) SELECT era, CASE WHEN n >= 11 THEN n END AS n, CASE WHEN x = 0 OR x >= 11 THEN x END AS positives, round(CASE WHEN n >= 11 AND (x = 0 OR x >= 11) THEN x / n END, 6) AS share, n < 11 AS n_suppressed, x > 0 AND x < 11 AS positives_suppressed FROM s")
def h8(spark, sf):
    return rounded(p.phenotype_summary(tree(spark, sf).withColumn("era", (F.col("user_id") % 3).cast("int")), ["era"]), "share")


@query("h9_t2dm", f"WITH {DX}, f AS (SELECT o_custkey, bool_or(code = 'ECONOMY' AND l_quantity > 48) AS d, bool_or(contains(p_brand, '#2') AND l_quantity > 49) AS m, bool_or(l_quantity >= 50 AND code = 'PROMO') AS l, bool_or(code = 'SMALL' AND l_quantity > 47) AS t1 FROM dx GROUP BY 1) SELECT o_custkey, d OR ((m OR l) AND NOT t1) AS positive FROM f")
def h9(spark, sf):
    d = dx(spark, sf)
    q, code = F.col("l_quantity"), F.col("code")
    tests = {"dx": (code == "ECONOMY") & (q > 48), "med": F.col("p_brand").contains("#2") & (q > 49), "lab": (q >= 50) & (code == "PROMO"), "t1": (code == "SMALL") & (q > 47)}
    leaves = {k: p.leaf(d, "o_custkey", "o_orderdate", t) for k, t in tests.items()}
    return p.phenotype(d, "o_custkey", leaves, F.col("dx") | ((F.col("med") | F.col("lab")) & ~F.col("t1")), ("dx", "med", "lab")).select("o_custkey", "positive")


_RATIO = "value / min(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 168 HOUR PRECEDING AND CURRENT ROW)"


@query("h10_kdigo_stage", f"""WITH x AS (SELECT event_id, user_id, ts, value / 50 AS value FROM events), r AS (SELECT event_id, value, {_RATIO} AS r, value - min(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 48 HOUR PRECEDING AND CURRENT ROW) AS d FROM x)
SELECT event_id, CASE WHEN r >= 3 OR (value >= 4.0::DOUBLE AND (d >= 0.3::DOUBLE OR r >= 1.5::DOUBLE)) THEN 3 WHEN r >= 2 THEN 2 WHEN d >= 0.3::DOUBLE OR r >= 1.5::DOUBLE THEN 1 ELSE 0 END AS stage FROM r""")
def h10(spark, sf):
    return p.kdigo_stage(load(spark, sf, "events").withColumn("value", F.col("value") / 50), "user_id", "ts", "value").select("event_id", "stage")


_COMP = "CASE WHEN event_type = 'error' THEN CASE WHEN value >= 100 THEN 4 WHEN value >= 50 THEN 2 ELSE 0 END END AS c1, CASE WHEN event_type = 'view' THEN CASE WHEN value >= 80 THEN 3 ELSE 1 END END AS c2"


def scores(spark, sf):
    e = load(spark, sf, "events")
    v, t = F.col("value"), F.col("event_type")
    e = e.withColumn("c1", F.when(t == "error", F.when(v >= 100, 4).when(v >= 50, 2).otherwise(0))).withColumn("c2", F.when(t == "view", F.when(v >= 80, 3).otherwise(1)))
    return p.worst_score_24h(e, "user_id", "ts", ["c1", "c2"])


SCORE = f"sc AS (SELECT event_id, user_id, ts, coalesce(max(c1) OVER q, 0) + coalesce(max(c2) OVER q, 0) AS score FROM (SELECT *, {_COMP} FROM events) {ROLL.format(24)})"


@query("h11_sofa_24h", f"WITH {SCORE} SELECT event_id, score FROM sc")
def h11(spark, sf):
    return scores(spark, sf).select("event_id", "score")


@query("h11b_sepsis3", f"WITH {SCORE} SELECT i.user_id, min(i.ts) AS onset FROM events i JOIN sc ON sc.user_id = i.user_id AND sc.score >= 6 AND sc.ts BETWEEN i.ts - INTERVAL 48 HOUR AND i.ts + INTERVAL 24 HOUR WHERE i.event_type = 'signup' GROUP BY 1")
def h11b(spark, sf):
    inf = load(spark, sf, "events").where("event_type = 'signup'").select("user_id", F.col("ts").alias("infected_at"))
    return p.sepsis3(inf, scores(spark, sf).select("user_id", F.col("ts").alias("scored_at"), "score"), "user_id", least=6)


@query("h12_suspicion", "SELECT a.user_id, a.ts AS given_at, min(b.ts) AS taken_at, least(a.ts, min(b.ts)) AS suspected_at FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts - INTERVAL 72 HOUR AND a.ts + INTERVAL 24 HOUR WHERE a.event_type = 'view' AND b.event_type = 'click' GROUP BY 1, 2")
def h12(spark, sf):
    e = load(spark, sf, "events")
    return p.suspicion_of_infection(e.where("event_type = 'view'").select("user_id", F.col("ts").alias("given_at")), e.where("event_type = 'click'").select("user_id", F.col("ts").alias("taken_at")), "user_id")


@query("h13_charlson", f"WITH {DX}, f AS (SELECT o_orderkey, max((code = 'ECONOMY')::INT) AS a, max((code = 'PROMO')::INT) AS b, max((code = 'SMALL')::INT) AS c, max((code = 'LARGE')::INT) AS d FROM dx GROUP BY 1) SELECT o_orderkey, a * 1 + CASE WHEN a = 1 THEN 0 ELSE b * 2 END + c * 3 + CASE WHEN c = 1 THEN 0 ELSE d * 6 END AS score FROM f")
def h13(spark, sf):
    return p.weighted_groups(dx(spark, sf), "o_orderkey", "code", {"ECONOMY": 1, "PROMO": 2, "SMALL": 3, "LARGE": 6}, {"PROMO": "ECONOMY", "LARGE": "SMALL"})


@query("h14_state_episodes", """WITH f AS (SELECT *, CASE WHEN lag(event_type) OVER q IS NULL OR lag(event_type) OVER q <> event_type OR ts - lag(ts) OVER q > INTERVAL 14 HOUR THEN 1 ELSE 0 END AS nw FROM events WINDOW q AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS episode FROM f) SELECT user_id, event_type, episode, min(ts) AS start, max(ts) AS stop, count(*) AS n FROM g GROUP BY 1, 2, 3""")
def h14(spark, sf):
    return p.state_episodes(load(spark, sf, "events"), "user_id", "ts", "event_id", "event_type", 14)


@query("h14b_equivalent_dose", "SELECT user_id, round(sum(value * CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 0.5 WHEN 'error' THEN 2.5 ELSE 0 END), 4) AS dose FROM events GROUP BY 1")
def h14b(spark, sf):
    return rounded(p.equivalent_dose(load(spark, sf, "events"), ["user_id"], "event_type", "value", {"click": 1.0, "view": 0.5, "error": 2.5}), "dose", to=4)


@query("h15_concept_counts", "SELECT 'errors' AS concept, count(*)::VARCHAR AS shown FROM events WHERE event_type = 'error' UNION ALL SELECT 'first_rows', '<11'")
def h15(spark, sf):
    e = load(spark, sf, "events")
    return p.concept_counts({"errors": e.where("event_type = 'error'"), "first_rows": e.where("event_id < 5")})


@query("h16_sirs", "SELECT event_id, CASE WHEN value / 5 > 38 OR value / 5 < 36 THEN 1 ELSE 0 END + CASE WHEN value > 90 THEN 1 ELSE 0 END + CASE WHEN (event_id % 40) > 20 THEN 1 ELSE 0 END + CASE WHEN event_type = 'view' AND (value / 10 > 12 OR value / 10 < 4) THEN 1 ELSE 0 END AS points FROM events")
def h16(spark, sf):
    v = F.col("value")
    return load(spark, sf, "events").select("event_id", p.sirs(v / 5, v, F.col("event_id") % 40, F.when(F.col("event_type") == "view", v / 10)).alias("points"))


@query("h17_compare_versions", """WITH a AS (SELECT user_id FROM events WHERE value > 200 GROUP BY 1 HAVING count(*) >= 4), b AS (SELECT user_id FROM events WHERE value > 180 GROUP BY 1 HAVING count(*) >= 6), u AS (SELECT DISTINCT user_id, (user_id % 2)::INT AS era FROM events),
s AS (SELECT era, count(*) AS n, count(*) FILTER (x AND y) AS both_, count(*) FILTER (x AND NOT y) AS oa, count(*) FILTER (NOT x AND y) AS ob FROM (SELECT era, user_id IN (SELECT user_id FROM a) AS x, user_id IN (SELECT user_id FROM b) AS y FROM u) GROUP BY 1), z AS (SELECT *, (both_ + oa) / n AS p, 1.959963984540054::DOUBLE AS z FROM s)
SELECT era, n, both_ AS "both", oa AS only_a, ob AS only_b, round(p, 6) AS share_a, round((p + z * z / (2 * n) - z * sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n), 6) AS low_a, round((p + z * z / (2 * n) + z * sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n), 6) AS high_a FROM z""")
def h17(spark, sf):
    e = load(spark, sf, "events")
    a, b = p.leaf(e, "user_id", "ts", F.col("value") > 200, 4), p.leaf(e, "user_id", "ts", F.col("value") > 180, 6)
    pop = e.select("user_id", (F.col("user_id") % 2).cast("int").alias("era")).distinct()
    return rounded(p.compare_versions(a, b, "user_id", pop, "era"), "share_a", "low_a", "high_a")


def cohort_spec(spark, sf):
    o = load(spark, sf, "orders")
    base = w.index_event(o, "o_custkey", "o_orderdate", "o_orderkey").join(load(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    lines = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    big = load(spark, sf, "lineitem").where("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    steps = [c.Criterion("price", F.col("o_totalprice") >= 50000), c.Criterion("has lines", members=lines), c.Criterion("no bulk line", members=big, negate=True), c.Criterion("segment", F.col("c_mktsegment") != "MACHINERY")]
    return base, c.CohortSpec("first orders", 1, "o_orderkey", "o_custkey", steps)


COH = """base AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1),
fl AS (SELECT *, o_totalprice >= 50000 AS c0, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS c1, o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49) AS c2, c_mktsegment <> 'MACHINERY' AS c3 FROM base)"""


@query("i1_compile_cohort", f"WITH {COH} SELECT o_orderkey, o_custkey FROM fl WHERE c0 AND c1 AND c2 AND c3")
def i1(spark, sf):
    return c.compile_cohort(*cohort_spec(spark, sf)).select("o_orderkey", "o_custkey")


@query("i2_prior_codeset", f"WITH {ENC} SELECT DISTINCT a.hadm FROM enc a JOIN enc b ON a.subject = b.subject AND b.status = 'F' AND b.start < a.start AND b.start >= a.start - INTERVAL 180 DAY - INTERVAL 1 MICROSECOND")
def i2(spark, sf):
    e = encounters(spark, sf)
    return c.prior_events(e, "hadm", "subject", "start", e.where("status = 'F'"), "start", 180)


@query("i3_washout", f"WITH {ENC}, l AS (SELECT hadm, start, max(stop) OVER (PARTITION BY subject ORDER BY start, hadm ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l FROM enc) SELECT hadm, l IS NULL OR start - l > INTERVAL 90 DAY AS washed FROM l")
def i3(spark, sf):
    e = encounters(spark, sf)
    return e.select("hadm", c.washout(e, "subject", "start", "stop", "hadm", 90).alias("washed"))


@query("i4_attrition", f"WITH {COH}, s AS (" + " UNION ALL ".join(f"SELECT {k} AS step, '{n}' AS name, count(*) FILTER ({t}) AS n_units, count(DISTINCT o_custkey) FILTER ({t}) AS n_subjects FROM fl" for k, (n, t) in enumerate([("base", "true"), ("price", "c0"), ("has lines", "c0 AND c1"), ("no bulk line", "c0 AND c1 AND c2"), ("segment", "c0 AND c1 AND c2 AND c3")])) + ") SELECT *, coalesce(lag(n_units) OVER (ORDER BY step) - n_units, 0) AS dropped FROM s")
def i4(spark, sf):
    return c.attrition(*cohort_spec(spark, sf))


@query("i5_materialize", f"WITH {COH} SELECT o_orderkey FROM fl WHERE c0 AND c1 AND c2 AND c3")
def i5(spark, sf):
    base, spec = cohort_spec(spark, sf)
    path = scratch(spark, "cohort")
    c.materialize_cohort(c.compile_cohort(base, spec).select("o_orderkey"), spec, path)
    return spark.read.parquet(f"{path}/rows")


@query("i6_brush", "SELECT event_id FROM events WHERE value >= 20 AND value < 40 AND event_id >= 500")
def i6(spark, sf):
    return load(spark, sf, "events").where(c.ranges_to_filter({"value": (20, 40), "event_id": (500, None)})).select("event_id")


@query("tracer", f"""WITH {COH}, m AS (SELECT * FROM fl WHERE c0 AND c1), r AS (SELECT l_orderkey, max((l_returnflag = 'R')::INT) AS returned FROM lineitem GROUP BY 1),
t AS (SELECT CASE WHEN o_totalprice >= 300000 THEN 2 WHEN o_totalprice >= 150000 THEN 1 ELSE 0 END::INT AS band, c_mktsegment, count(*) AS n, sum(returned)::BIGINT AS n_returned FROM m JOIN r ON o_orderkey = l_orderkey GROUP BY 1, 2)
SELECT band, c_mktsegment, n, n_returned, round(n_returned / n, 6) AS rate FROM t WHERE n >= 11""")
def tracer(spark, sf):
    """First order per customer, price and lines as criteria, returned-line rate by price band and segment, small cells left out."""
    from strandline.functions.timesem import band

    base, spec = cohort_spec(spark, sf)
    cohort = c.compile_cohort(base, c.CohortSpec("tracer", 1, spec.grain, spec.subject, spec.criteria[:2]))
    returned = load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max((F.col("l_returnflag") == "R").cast("int")).alias("returned"))
    cells = cohort.join(returned, "o_orderkey").groupBy(band(F.col("o_totalprice"), [150000, 300000]).alias("band"), "c_mktsegment").agg(F.count("*").alias("n"), F.sum("returned").alias("n_returned"))
    return disclosure.drop_small_rows(cells, "n")[0].withColumn("rate", F.round(F.col("n_returned") / F.col("n"), 6))
