"""Queries over the timeline, the spine, marts and disclosure control (survey 2.7 and 2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import disclosure as d
from strandline.operators import timeline as t
from strandline.operators.sums import dealt
from strandline.plans.q_temporal import HOUR, STAY, stays
from strandline.plans.registry import query
from strandline.sources.tables import load

KINDS = ["click", "error", "purchase", "signup", "view"]
AL = f"anc AS (SELECT u.user_id, min(ts) AS anchor FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON u.user_id = p.user_id GROUP BY 1), al AS (SELECT e.*, (epoch_us(ts) - epoch_us(anchor)) / {HOUR} AS h FROM events e JOIN anc ON e.user_id = anc.user_id WHERE (epoch_us(ts) - epoch_us(anchor)) / {HOUR} >= -24 AND (epoch_us(ts) - epoch_us(anchor)) / {HOUR} < 72)"


def anchors(spark, sf):
    e = load(spark, sf, "events")
    return t.anchor(e, "user_id", e.where("event_type = 'purchase'"), "ts")


def aligned(spark, sf):
    return t.align(load(spark, sf, "events"), anchors(spark, sf), "user_id", "ts", -24, 72)


def rounded(df, *cols, to=6):
    for c in cols:
        df = df.withColumn(c, F.round(c, to))
    return df


@query("g1_anchor", f"WITH {AL} SELECT * FROM anc")
def g1(spark, sf):
    return anchors(spark, sf)


@query("g2_align", f"WITH {AL} SELECT event_id, round(h, 6) AS hours FROM al")
def g2(spark, sf):
    return aligned(spark, sf).select("event_id", F.round("hours_since_anchor", 6).alias("hours"))


BIN = "SELECT user_id, floor(h / {0})::BIGINT AS bin, count(value) AS n, avg(value) AS mean, min(value) AS low, max(value) AS high, arg_max(value, (h, event_id)) AS last FROM al GROUP BY 1, 2"


@query("g3_hourly_bins", f"WITH {AL} SELECT * REPLACE (round(mean, 6) AS mean) FROM ({BIN.format(1)})")
def g3(spark, sf):
    return rounded(t.binned(aligned(spark, sf), ["user_id"], "value", "event_id", 1), "mean")


@query("g3b_filled_bins", f"WITH {AL}, b AS ({BIN.format(1)}), k AS (SELECT user_id, b AS bin FROM (SELECT DISTINCT user_id FROM b), range(-24, 72) r(b)) SELECT k.user_id, k.bin, coalesce(n, 0) AS n, last FROM k LEFT JOIN b ON k.user_id = b.user_id AND k.bin = b.bin")
def g3b(spark, sf):
    return t.fill_bins(t.binned(aligned(spark, sf), ["user_id"], "value", "event_id", 1), ["user_id"], -24, 71).select("user_id", "bin", "n", "last")


@query("g4_daily_bins", f"WITH {AL} SELECT * REPLACE (round(mean, 6) AS mean) FROM ({BIN.format(24)})")
def g4(spark, sf):
    return rounded(t.binned(aligned(spark, sf), ["user_id"], "value", "event_id", 24), "mean")


@query("g5_population_summary", f"""WITH {AL}, b AS ({BIN.format(1)}), s AS (SELECT bin, count(DISTINCT user_id) AS u, sum(n)::BIGINT AS n, avg(mean) AS mean FROM b GROUP BY 1)
SELECT bin, CASE WHEN u >= 25 THEN u END AS n_units, CASE WHEN u >= 25 THEN n END AS n, CASE WHEN u >= 25 THEN round(mean, 6) END AS mean, u < 25 AS n_units_suppressed FROM s""")
def g5(spark, sf):
    return rounded(t.population_summary(t.binned(aligned(spark, sf), ["user_id"], "value", "event_id", 1), "user_id", 25), "mean")


SPINE_SQL = """spine AS (SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, o_orderdate AS time, 'ORDER//' || o_orderpriority AS code, o_totalprice AS numeric_value, o_orderstatus AS text_value, 'orders' AS source FROM orders
UNION ALL SELECT o_custkey, l_orderkey, l_shipdate, 'PART//' || l_partkey || '//' || x.k, x.v, NULL, 'lineitem' FROM lineitem JOIN orders ON l_orderkey = o_orderkey, LATERAL (VALUES ('amount', l_quantity), ('rate', l_extendedprice)) x(k, v)
UNION ALL SELECT user_id, NULL, ts, 'EVENT//' || event_type, value, props, 'events' FROM events)"""


def spine(spark, sf):
    o, li, e = load(spark, sf, "orders"), load(spark, sf, "lineitem"), load(spark, sf, "events")
    c = F.col
    a = t.event_source(o, "orders", c("o_custkey"), c("o_orderkey"), c("o_orderdate"), [F.lit("ORDER"), c("o_orderpriority")], c("o_totalprice"), c("o_orderstatus"))
    two = dealt(li, li.count(), "l_orderkey").join(o.select(c("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey").withColumn("x", F.explode(F.array(F.struct(F.lit("amount").alias("k"), c("l_quantity").alias("v")), F.struct(F.lit("rate").alias("k"), c("l_extendedprice").alias("v")))))
    b = t.event_source(two, "lineitem", c("o_custkey"), c("l_orderkey"), c("l_shipdate"), [F.lit("PART"), c("l_partkey").cast("string"), c("x.k")], c("x.v"))
    return t.build_spine([a, b, t.event_source(e, "events", c("user_id"), F.lit(None), c("ts"), [F.lit("EVENT"), c("event_type")], c("value"), c("props"))])


@query("g6_event_source", "SELECT user_id AS subject_id, NULL::BIGINT AS hadm_id, ts AS time, 'EVENT//' || event_type AS code, value AS numeric_value, props AS text_value, 'events' AS source FROM events")
def g6(spark, sf):
    return t.event_source(load(spark, sf, "events"), "events", F.col("user_id"), F.lit(None), F.col("ts"), [F.lit("EVENT"), F.col("event_type")], F.col("value"), F.col("props"))


@query("g7_build_spine", f"WITH {SPINE_SQL} SELECT source, count(*) AS n, count(DISTINCT code) AS n_codes, min(time) AS first, max(time) AS last, round(sum(numeric_value), 2) AS total FROM spine GROUP BY 1")
def g7(spark, sf):
    return spine(spark, sf).groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("code").alias("n_codes"), F.min("time").alias("first"), F.max("time").alias("last"), F.round(F.sum("numeric_value"), 2).alias("total"))


@query("g8_spine_codes", f"WITH {SPINE_SQL} SELECT split_part(code, '//', 1) AS prefix, count(*) AS n_events, count(DISTINCT subject_id) AS n_subjects FROM spine GROUP BY 1")
def g8(spark, sf):
    return t.spine_codes(spine(spark, sf))


@query("g9_validate_spine", f"WITH {SPINE_SQL} SELECT count(*) FILTER (time IS NULL) AS no_time, count(*) FILTER (c_custkey IS NULL) AS unknown_subject, count(*) FILTER (length(text_value) > 8) AS long_text, count(*) FILTER (NOT contains(code, '//')) AS no_prefix FROM spine LEFT JOIN customer ON subject_id = c_custkey")
def g9(spark, sf):
    return t.validate_spine(spine(spark, sf), load(spark, sf, "customer").select("c_custkey"), 8)


FD = f"WITH {STAY}, al AS (SELECT s.*, e.event_id, e.event_type, e.value, (epoch_us(e.ts) - epoch_us(intime)) / {HOUR} AS h FROM sess e JOIN stays s ON e.user_id = s.user_id AND e.session = s.session)"


def stay_events(spark, sf):
    from strandline.functions.timesem import hours_since
    from strandline.operators.windows import sessions

    e = sessions(load(spark, sf, "events"))
    return e.join(stays(spark, sf).drop("n"), ["user_id", "session"]).withColumn("hours_since_anchor", hours_since("intime", "ts"))


@query("g10_first_day_mart", FD + "SELECT user_id, session, count(*) AS n, " + ", ".join(f"min(value) FILTER (event_type = '{k}') AS {k}_low, max(value) FILTER (event_type = '{k}') AS {k}_high, round(avg(value) FILTER (event_type = '{k}'), 6) AS {k}_mean" for k in KINDS) + " FROM al WHERE h < 24 GROUP BY 1, 2")
def g10(spark, sf):
    m = t.first_day_mart(stay_events(spark, sf).where("hours_since_anchor < 24"), ["user_id", "session"], "event_type", "value", KINDS)
    return rounded(m, *[f"{k}_mean" for k in KINDS])


DAILY = FD + """, x AS (SELECT *, value BETWEEN 5 AND 300 AS ok FROM al) SELECT user_id, session, event_type, floor(h / 24)::BIGINT AS bin, count(value) FILTER (ok) AS n, min(value) FILTER (ok) AS low, max(value) FILTER (ok) AS high, round(avg(value) FILTER (ok), 6) AS mean,
arg_min(value, (h, event_id)) FILTER (ok) AS first, arg_max(value, (h, event_id)) FILTER (ok) AS last, count(*) FILTER (NOT ok) AS n_implausible FROM x GROUP BY 1, 2, 3, 4"""


@query("g11_itemid_daily", DAILY)
def g11(spark, sf):
    return rounded(t.item_bins(stay_events(spark, sf), ["user_id", "session"], "event_type", "value", "event_id", 5, 300), "mean")


@query("g12_itemid_summary", "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_units, round(count(DISTINCT user_id) / (SELECT count(DISTINCT user_id) FROM events), 6) AS share, round(quantile_cont(value, 0.01), 4) AS p01, round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.99), 4) AS p99 FROM events GROUP BY 1")
def g12(spark, sf):
    e = load(spark, sf, "events")
    n = e.select(F.countDistinct("user_id")).first()[0]
    return rounded(rounded(t.item_summary(e, "event_type", "value", "user_id", n), "share"), "p01", "p50", "p99", to=4)


@query("g13_hourly_mart", FD + ", b AS (SELECT user_id, session, event_type, floor(h)::BIGINT AS bin, count(value) AS n, avg(value) AS mean, min(value) AS low, max(value) AS high, arg_max(value, (h, event_id)) AS last FROM al GROUP BY 1, 2, 3, 4) SELECT user_id, session, bin, " + ", ".join(f"max(n) FILTER (event_type = '{k}') AS {k}_n, round(max(mean) FILTER (event_type = '{k}'), 6) AS {k}_mean, max(low) FILTER (event_type = '{k}') AS {k}_low, max(high) FILTER (event_type = '{k}') AS {k}_high, max(last) FILTER (event_type = '{k}') AS {k}_last" for k in KINDS) + " FROM b WHERE bin < 48 GROUP BY 1, 2, 3")
def g13(spark, sf):
    bins = t.binned(stay_events(spark, sf), ["user_id", "session", "event_type"], "value", "event_id", 1)
    return rounded(t.hourly_mart(bins, ["user_id", "session"], "event_type", KINDS, 48), *[f"{k}_mean" for k in KINDS])


@query("g14_hourly_population", """WITH x AS (SELECT hour(ts)::INT AS hour, event_type, user_id % 5 AS era, value FROM events), y AS (SELECT hour, event_type, era::VARCHAR AS era, value FROM x UNION ALL SELECT hour, event_type, 'all', value FROM x)
SELECT hour, event_type, era, count(value) AS n, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.05), 4) AS p05, round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.95), 4) AS p95 FROM y GROUP BY 1, 2, 3""")
def g14(spark, sf):
    e = load(spark, sf, "events").select(F.hour("ts").alias("hour"), "event_type", (F.col("user_id") % 5).alias("era"), "value")
    return rounded(rounded(t.hourly_population(e, "hour", "event_type", "era", "value"), "mean"), "p05", "p50", "p95", to=4)


@query("g15_last_known", f"WITH {AL}, b AS ({BIN.format(1)}), k AS (SELECT user_id, b AS bin FROM (SELECT DISTINCT user_id FROM b), range(-24, 72) r(b)), f AS (SELECT k.user_id, k.bin, last FROM k LEFT JOIN b ON k.user_id = b.user_id AND k.bin = b.bin) SELECT user_id, bin, last_value(last IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY bin RANGE BETWEEN 6 PRECEDING AND CURRENT ROW) AS known FROM f")
def g15(spark, sf):
    f = t.fill_bins(t.binned(aligned(spark, sf), ["user_id"], "value", "event_id", 1), ["user_id"], -24, 71)
    return f.select("user_id", "bin", t.last_known(f, ["user_id"], "bin", "last", 6).alias("known"))


CELLS = "SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2"


@query("k1_suppress", f"SELECT p_brand, p_type, CASE WHEN n >= 11 THEN n END AS n, n < 11 AS n_suppressed FROM ({CELLS})")
def k1(spark, sf):
    return d.suppress(load(spark, sf, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n")), ["n"])


@query("k2_suppress_complementary")
def k2(spark, sf):
    return d.suppress_complementary(load(spark, sf, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n")), "p_brand", "p_type", "n")


STEPS = "steps AS (SELECT 0 AS step, count(*) AS n FROM orders UNION ALL SELECT 1, count(*) FILTER (o_orderkey % 2000 <> 3) FROM orders UNION ALL SELECT 2, count(*) FILTER (o_orderkey % 2000 <> 3 AND o_orderstatus = 'F') FROM orders)"


@query("k3_suppress_chain", f"""WITH {STEPS}, l AS (SELECT *, lag(n) OVER (ORDER BY step) - n AS dropped FROM steps), h AS (SELECT *, coalesce(dropped > 0 AND dropped < 11, false) AS h FROM l), m AS (SELECT *, h OR coalesce(lead(h) OVER (ORDER BY step), false) AS near FROM h)
SELECT step, CASE WHEN near THEN '~' || (round(n / 10) * 10)::BIGINT ELSE n::VARCHAR END AS shown, CASE WHEN NOT h THEN dropped END AS dropped FROM m""")
def k3(spark, sf):
    a = F.col("o_orderkey") % 2000 != 3
    one = load(spark, sf, "orders").agg(F.count("*").alias("s0"), F.count_if(a).alias("s1"), F.count_if(a & (F.col("o_orderstatus") == "F")).alias("s2"))
    steps = one.select(F.expr("stack(3, 0, s0, 1, s1, 2, s2) as (step, n)"))
    return d.suppress_chain(steps, "step", "n")


@query("k4_drop_small_rows", f"SELECT * FROM ({CELLS}) WHERE n >= 11")
def k4(spark, sf):
    return d.drop_small_rows(load(spark, sf, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n")), "n")[0]


@query("k5_scan_output", """SELECT * FROM (SELECT 'identifier' AS finding, 'doc_id' AS "column", count(*) AS n FROM documents UNION ALL SELECT 'id_band', 'doc_id', count(*) FILTER (doc_id BETWEEN 100 AND 200) FROM documents UNION ALL SELECT 'long_text', 'text', count(*) FILTER (length(text) > 64) FROM documents
UNION ALL SELECT 'long_text', 'lang', count(*) FILTER (length(lang) > 64) FROM documents UNION ALL SELECT 'id_band', 'n_chars', count(*) FILTER (n_chars BETWEEN 100 AND 200) FROM documents UNION ALL SELECT 'small_count', 'n_chars', count(*) FILTER (n_chars > 0 AND n_chars < 11) FROM documents
UNION ALL SELECT 'too_many_rows', '*', CASE WHEN count(*) > 100 THEN count(*) ELSE 0 END FROM documents) WHERE n > 0""")
def k5(spark, sf):
    return d.scan_output(load(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars"), 100, 200, ("doc_id",), 100)


@query("k6_safe_aggregate", "SELECT l_returnflag, l_linenumber, count(*) AS n, round(avg(l_quantity), 6) AS mean_qty, count(DISTINCT l_orderkey) AS n_orders FROM lineitem GROUP BY 1, 2 HAVING count(*) >= 11")
def k6(spark, sf):
    out = d.safe_aggregate(load(spark, sf, "lineitem"), ["l_returnflag", "l_linenumber"], {"mean_qty": ("mean", "l_quantity"), "n_orders": ("count_distinct", "l_orderkey")}, ("l_orderkey",))
    return rounded(out, "mean_qty")


@query("k7_filter_vocabulary", r"""WITH w AS (SELECT DISTINCT doc_id, source, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}_]+')) AS term FROM documents)
SELECT term, count(DISTINCT doc_id) AS n_docs, count(DISTINCT source) AS n_subjects FROM w WHERE term <> '' AND NOT regexp_matches(term, '^_+$') AND NOT regexp_matches(term, '^[0-9]{5,}$') GROUP BY 1 HAVING count(DISTINCT doc_id) >= 11 AND count(DISTINCT source) >= 11""")
def k7(spark, sf):
    return d.filter_vocabulary(load(spark, sf, "documents"), "doc_id", "source", "text")


