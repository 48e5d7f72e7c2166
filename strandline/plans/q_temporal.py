"""Queries over joins, grains and episodes (survey 2.5 and 2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import joins as j
from strandline.operators import windows as w
from strandline.plans.registry import query
from strandline.sources.tables import load

HOUR = "3600e6::DOUBLE"
SESS = """sess AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS session FROM
(SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 24 HOUR THEN 1 ELSE 0 END AS nw FROM events))"""
STAY = f"{SESS}, stays AS (SELECT user_id, session, min(ts) AS intime, max(ts) AS outtime, count(*) AS n FROM sess GROUP BY 1, 2)"
ENC = "enc AS (SELECT o_custkey AS subject, o_orderkey AS hadm, o_orderdate AS start, o_orderdate + to_days((1 + o_orderkey % 14)::INT) AS stop, o_totalprice AS price, o_orderstatus AS status, o_orderpriority AS priority FROM orders)"


def encounters(spark, sf):
    return load(spark, sf, "orders").selectExpr("o_custkey as subject", "o_orderkey as hadm", "o_orderdate as start", "o_orderdate + make_dt_interval(cast(1 + o_orderkey % 14 as int)) as stop", "o_totalprice as price", "o_orderstatus as status", "o_orderpriority as priority")


def stays(spark, sf):
    return w.sessions(load(spark, sf, "events")).groupBy("user_id", "session").agg(F.min("ts").alias("intime"), F.max("ts").alias("outtime"), F.count("*").alias("n"))


@query("e1_equi_join", "SELECT c_mktsegment, count(*) AS n, count(o_orderkey) AS n_orders, round(sum(o_totalprice), 2) AS total FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def e1(spark, sf):
    o = load(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return load(spark, sf, "customer").join(o, "c_custkey", "left").groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.count("o_orderkey").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("e2_semi_anti", "SELECT 'with' AS side, count(*) AS n FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') UNION ALL SELECT 'without', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def e2(spark, sf):
    o, li = load(spark, sf, "orders"), load(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    a = o.join(li.where("l_returnflag = 'R'"), "o_orderkey", "left_semi").agg(F.lit("with").alias("side"), F.count("*").alias("n"))
    return a.unionByName(o.join(li, "o_orderkey", "left_anti").agg(F.lit("without").alias("side"), F.count("*").alias("n")))


@query("e3_asof_join", """SELECT a.event_id, b.event_id AS click_id, b.value AS click_value, b.ts AS matched_at FROM (SELECT * FROM events WHERE event_type = 'error') a
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') b ON a.user_id = b.user_id AND a.ts >= b.ts""")
def e3(spark, sf):
    e = load(spark, sf, "events")
    clicks = e.where("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click_id"), F.col("value").alias("click_value"))
    return j.asof_join(e.where("event_type = 'error'").select("event_id", "user_id", "ts"), clicks, ["user_id"], "ts", "ts", ["click_id", "click_value"], "click_id").select("event_id", "click_id", "click_value", "matched_at")


@query("e3b_asof_hot_key", """WITH a AS (SELECT event_id, ts, event_id % 3 AS k FROM events WHERE event_type = 'error'), b AS (SELECT event_id % 3 AS k, ts, max(event_id) AS purchase_id FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT a.event_id, b.purchase_id FROM a ASOF LEFT JOIN b ON a.k = b.k AND a.ts >= b.ts""")
def e3b(spark, sf):
    """Three keys hold all rows: the last purchase of anyone in the same third before each error."""
    e = load(spark, sf, "events").withColumn("k", F.col("event_id") % 3)
    a, b = e.where("event_type = 'error'").select("event_id", "ts", "k"), e.where("event_type = 'purchase'").select("k", F.col("ts").alias("t"), F.col("event_id").alias("purchase_id"))
    return j.asof_join(a, b, ["k"], "ts", "t", ["purchase_id"], "purchase_id", hot=True).select("event_id", "purchase_id")


@query("e4_event_at", """WITH a AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT o_custkey, o_orderdate, o_orderkey AS prior_key FROM orders WHERE o_orderstatus = 'O'),
r AS (SELECT a.o_orderkey, b.prior_key, row_number() OVER (PARTITION BY a.o_orderkey ORDER BY b.o_orderdate DESC, prior_key DESC) AS r FROM a LEFT JOIN b ON a.o_custkey = b.o_custkey AND b.o_orderdate <= a.o_orderdate AND b.o_orderdate >= a.o_orderdate - INTERVAL 240 HOUR)
SELECT o_orderkey, prior_key FROM r WHERE r = 1""")
def e4(spark, sf):
    o = load(spark, sf, "orders")
    b = o.where("o_orderstatus = 'O'").select("o_custkey", F.col("o_orderdate").alias("t"), F.col("o_orderkey").alias("prior_key"))
    return j.event_at(b, o.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], "o_orderdate", "t", ["prior_key"], "prior_key", 240).select("o_orderkey", "prior_key")


@query("e5_window_join", f"""SELECT a.event_id AS purchase_id, b.event_id AS error_id, round((epoch_us(b.ts) - epoch_us(a.ts)) / {HOUR}, 6) AS lag_hours FROM events a JOIN events b ON a.user_id = b.user_id
AND b.ts BETWEEN a.ts - INTERVAL 1 HOUR AND a.ts + INTERVAL 2 HOUR WHERE a.event_type = 'purchase' AND b.event_type = 'error'""")
def e5(spark, sf):
    e = load(spark, sf, "events")
    a = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("a_ts"), F.col("event_id").alias("purchase_id"))
    b = e.where("event_type = 'error'").select("user_id", F.col("ts").alias("b_ts"), F.col("event_id").alias("error_id"))
    return j.window_join(a, b, ["user_id"], "a_ts", "b_ts", 1, 2).select("purchase_id", "error_id", F.round("lag_hours", 6).alias("lag_hours"))


def _in_encounters(spark, sf, lines):
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("subject"))
    pts = lines.join(o, "l_orderkey").select("l_orderkey", "l_linenumber", "l_shipdate", "subject")
    return j.interval_join(pts, encounters(spark, sf), ["subject"], "l_shipdate", "start", "stop", "hadm").select("l_orderkey", "l_linenumber", "l_shipdate", "hadm")


IN_ENC = f"WITH {ENC}, r AS (SELECT l_orderkey, l_linenumber, l_shipdate, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey) SELECT l_orderkey, l_linenumber, l_shipdate, (SELECT hadm FROM enc WHERE subject = o_custkey AND l_shipdate >= start AND l_shipdate < stop ORDER BY start, stop, hadm LIMIT 1) AS hadm FROM r"


@query("e6_interval_join", IN_ENC)
@query("e6b_interval_join_all", IN_ENC)
def e6(spark, sf):
    return _in_encounters(spark, sf, load(spark, sf, "lineitem"))


@query("e7_prefix_join", "WITH p(prefix, grp) AS (VALUES ('PRO', 'pro'), ('ST', 'st'), ('STANDARD', 'std'), ('ECO', 'eco'), ('S', 's')) SELECT p_partkey, p_type, prefix, grp FROM part JOIN p ON starts_with(upper(p_type), prefix)")
def e7(spark, sf):
    rules = spark.createDataFrame([("PRO", "pro"), ("ST", "st"), ("STANDARD", "std"), ("ECO", "eco"), ("S", "s")], "prefix string, grp string")
    codes = load(spark, sf, "part").select("p_partkey", "p_type", F.upper("p_type").alias("code"))
    return j.prefix_join(codes, "code", rules, "prefix", [1, 2, 3, 8]).select("p_partkey", "p_type", "prefix", "grp")


@query("e8_join_cardinality", """WITH a AS (SELECT o_orderkey AS k, count(*) AS a FROM orders GROUP BY 1), b AS (SELECT l_orderkey AS k, count(*) AS b FROM lineitem GROUP BY 1)
SELECT CASE WHEN max(a) FILTER (b IS NOT NULL) > 1 THEN 'n' ELSE '1' END || ':' || CASE WHEN max(b) FILTER (a IS NOT NULL) > 1 THEN CASE WHEN max(a) FILTER (b IS NOT NULL) > 1 THEN 'm' ELSE 'n' END ELSE '1' END AS relation, max(a) AS max_left, max(b) AS max_right,
count(*) FILTER (b IS NULL) AS left_only, count(*) FILTER (a IS NULL) AS right_only, round(avg((a > 1 OR b > 1)::INT) FILTER (a IS NOT NULL AND b IS NOT NULL), 6) AS share_multiple FROM a FULL JOIN b ON a.k = b.k""")
def e8(spark, sf):
    return j.join_cardinality(load(spark, sf, "orders").select(F.col("o_orderkey").alias("k")), load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k")), "k").withColumn("share_multiple", F.round("share_multiple", 6))


@query("e9_crosswalk", """WITH m AS (SELECT n_name AS source, r_name AS target, n_nationkey % 2 = 0 AS approximate FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 5 <> 0 UNION ALL SELECT n_name, 'EXTRA', true FROM nation WHERE n_nationkey % 7 = 1)
SELECT n_name AS code, target, approximate, target IS NULL AS no_map, coalesce((SELECT count(target) FROM m x WHERE x.source = n_name) > 1, false) AS combination FROM nation LEFT JOIN m ON source = n_name""")
def e9(spark, sf):
    n, r = load(spark, sf, "nation"), load(spark, sf, "region")
    m = n.where("n_nationkey % 5 <> 0").join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_name").alias("source"), F.col("r_name").alias("target"), (F.col("n_nationkey") % 2 == 0).alias("approximate"))
    m = m.unionByName(n.where("n_nationkey % 7 = 1").select(F.col("n_name").alias("source"), F.lit("EXTRA").alias("target"), F.lit(True).alias("approximate")))
    return j.crosswalk(n.select(F.col("n_name").alias("code")), "code", m)


@query("f1_index_event", "SELECT o_custkey, o_orderkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def f1(spark, sf):
    return w.index_event(load(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "o_orderdate")


@query("f2_stay_index", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::INT AS seq, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1 AS first FROM orders")
def f2(spark, sf):
    return w.stay_index(load(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_orderkey").select("o_orderkey", "seq", "first")


@query("f3_explode_days", f"WITH {STAY} SELECT user_id, session, unnest(range(least(greatest(ceil((epoch_us(outtime) - epoch_us(intime)) / 86400e6), 1), 5)::INT))::INT AS day FROM stays")
def f3(spark, sf):
    return w.explode_units(stays(spark, sf), "intime", "outtime", 24, "day", 5).select("user_id", "session", "day")


@query("f4_person_time", f"WITH {ENC} SELECT subject, round(sum(epoch_us(stop) - epoch_us(start)) / 86400e6, 6) AS person_days FROM enc GROUP BY 1")
def f4(spark, sf):
    return w.person_time(encounters(spark, sf), "subject", "start", "stop").withColumn("person_days", F.round("person_days", 6))


@query("f5_merge_gaps", f"""WITH {ENC}, f AS (SELECT *, CASE WHEN max(stop) OVER q IS NULL OR start - max(stop) OVER q > INTERVAL 240 HOUR THEN 1 ELSE 0 END AS nw FROM enc WINDOW q AS (PARTITION BY subject ORDER BY start, hadm ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, sum(nw) OVER (PARTITION BY subject ORDER BY start, hadm)::BIGINT AS episode FROM f)
SELECT subject, episode, min(start) AS start, max(stop) AS stop, count(*) AS n, round((epoch_us(max(stop)) - epoch_us(min(start))) / {HOUR}, 4) AS hours, count(DISTINCT start::DATE) AS days_of_therapy, round(sum(price), 2) AS total_dose FROM g GROUP BY 1, 2""")
def f5(spark, sf):
    e = w.merge_gaps(encounters(spark, sf), ["subject"], "start", "stop", 240, "hadm", "price")
    return e.withColumn("hours", F.round("hours", 4)).withColumn("total_dose", F.round("total_dose", 2))


@query("f5b_sessions", f"WITH {STAY} SELECT * FROM stays")
def f5b(spark, sf):
    return stays(spark, sf)


@query("f6_recurrent_episodes", f"""WITH fu AS (SELECT user_id, min(ts) AS o, max(ts) AS l FROM events GROUP BY 1), e AS (SELECT user_id, ts, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events WHERE event_type = 'error'),
x AS (SELECT user_id, ts AS t, 1 AS event FROM e WHERE gap IS NULL OR gap > INTERVAL 48 HOUR UNION ALL SELECT user_id, l, 0 FROM fu), y AS (SELECT x.user_id, (epoch_us(t) - epoch_us(o)) / {HOUR} AS stop, event FROM x JOIN fu ON x.user_id = fu.user_id),
z AS (SELECT user_id, row_number() OVER q AS no, coalesce(lag(stop) OVER q, 0) AS start, stop, event FROM y WINDOW q AS (PARTITION BY user_id ORDER BY stop, event DESC))
SELECT user_id, no::INT AS no, round(start, 6) AS start, round(stop, 6) AS stop, event FROM z WHERE event = 1 OR stop > start""")
def f6(spark, sf):
    e = load(spark, sf, "events")
    fu = e.groupBy("user_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    r = w.recurrent_episodes(e.where("event_type = 'error'"), "user_id", "ts", "event_id", 48, fu)
    return r.withColumn("start", F.round("start", 6)).withColumn("stop", F.round("stop", 6))


@query("f7_rolling_24h", "SELECT event_id, max(value) OVER q AS worst, count(*) OVER q AS n FROM events WINDOW q AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW)")
def f7(spark, sf):
    return load(spark, sf, "events").select("event_id", w.rolling(["user_id"], "ts", 24, F.max("value")).alias("worst"), w.rolling(["user_id"], "ts", 24, F.count("*")).alias("n"))


@query("f8_neighbours", f"""SELECT event_id, lag(event_type) OVER q AS previous, lead(event_type) OVER q AS following, round((epoch_us(lead(ts) OVER q) - epoch_us(ts)) / {HOUR}, 6) AS delay_hours,
first_value(event_type) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_value, last_value(event_type) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_value FROM events WINDOW q AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def f8(spark, sf):
    return w.neighbours(load(spark, sf, "events"), "user_id", "ts", "event_id", "event_type").select("event_id", "previous", "following", F.round("delay_hours", 6).alias("delay_hours"), "first_value", "last_value")


_SS = """ss AS (SELECT user_id, ts AS start, lead(ts) OVER q AS stop, event_type AS state, lead((event_id % 97 = 0)::INT) OVER q AS event FROM events WINDOW q AS (PARTITION BY user_id ORDER BY ts, event_id))"""


@query("f9_start_stop", f"WITH {_SS} SELECT user_id, start, stop, state, event FROM ss WHERE stop IS NOT NULL")
def f9(spark, sf):
    return w.start_stop(load(spark, sf, "events"), "user_id", "ts", "event_id", "event_type", F.col("event_id") % 97 == 0)


@query("f9b_validate_start_stop", f"WITH {_SS}, v AS (SELECT * FROM ss WHERE stop IS NOT NULL), m AS (SELECT count(*) AS m FROM (SELECT user_id FROM v GROUP BY 1 HAVING sum(event) > 1)) SELECT count(*) FILTER (stop <= start) AS no_length, 0::BIGINT AS overlaps, (SELECT m FROM m) AS many_terminal FROM v")
def f9b(spark, sf):
    return w.validate_start_stop(f9(spark, sf), "user_id")


@query("f10_window_flags", f"""WITH {ENC} SELECT hadm, coalesce((epoch_us(start) - epoch_us(lag(stop) OVER q)) / {HOUR} BETWEEN 0 AND 720, false) AS bounce_back, coalesce((epoch_us(lead(start) OVER q) - epoch_us(start)) / {HOUR} >= 2400, false) AS late_next
FROM enc WINDOW q AS (PARTITION BY subject ORDER BY start, hadm)""")
def f10(spark, sf):
    return w.event_window_flags(encounters(spark, sf), "subject", "start", "stop", "hadm", 720, 2400).select("hadm", "bounce_back", "late_next")
