"""Queries over model-ready data, linkage and text (survey 2.18 to 2.20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import features as f
from strandline.operators import linkage as k
from strandline.operators import phrases
from strandline.operators import text as x
from strandline.plans.q_temporal import ENC, HOUR, encounters
from strandline.plans.q_timeline import AL, BIN, KINDS, aligned, rounded
from strandline.plans.registry import query
from strandline.sources.tables import load

SC = "sc AS (SELECT o_orderkey, o_orderstatus = 'F' AS y, (1 + o_orderkey % 97) / 99.0::DOUBLE AS p, o_totalprice, year(o_orderdate) AS yr, o_orderpriority FROM orders)"


def scored(spark, sf):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", (F.col("o_orderstatus") == "F").alias("y"), ((1 + F.col("o_orderkey") % 97) / F.lit(99.0)).alias("p"), "o_totalprice", F.year("o_orderdate").alias("yr"), "o_orderpriority")


def _feat(i):
    c = f"FILTER (event_type = '{i}')"
    return f"min(v) {c} AS {i}_min, max(v) {c} AS {i}_max, round(avg(v) {c}, 6) AS {i}_mean, arg_min(v, (h, event_id)) {c} AS {i}_first, arg_max(v, (h, event_id)) {c} AS {i}_last, count(v) {c} AS {i}_count, count(v) {c} > 0 AS {i}__measured"


@query("r1_build_features", f"WITH {AL} SELECT user_id, " + ", ".join(map(_feat, KINDS)) + " FROM (SELECT *, least(greatest(value, 5), 250)::DOUBLE AS v FROM al) GROUP BY 1")
def r1(spark, sf):
    return rounded(f.build_features(aligned(spark, sf), ["user_id"], "event_type", "value", "event_id", KINDS, 5.0, 250.0), *[f"{i}_mean" for i in KINDS])


@query("r1b_one_hot", "SELECT o_orderkey, (o_orderstatus = 'F')::INT AS \"o_orderstatus=F\", (o_orderstatus = 'O')::INT AS \"o_orderstatus=O\" FROM orders")
def r1b(spark, sf):
    return f.one_hot(load(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O"]).drop("o_orderstatus")


@query("r2_leakage", f"WITH {ENC}, m AS (SELECT hadm, start + INTERVAL 1 DAY AS cutoff, stop, (SELECT max(l_shipdate) FROM lineitem WHERE l_orderkey = hadm) AS c FROM enc) SELECT count(*) FILTER (c >= cutoff) AS late_features, count(*) FILTER (stop < cutoff) AS early_labels FROM m")
def r2(spark, sf):
    c = load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("hadm")).agg(F.max("l_shipdate").alias("c"))
    return f.leakage(encounters(spark, sf).join(c, "hadm", "left").withColumn("cutoff", F.expr("start + interval 1 day")), "c", "cutoff", "stop")


@query("r3_normalize", "WITH s AS (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS d FROM orders WHERE year(o_orderdate) < 1996) SELECT o_orderkey, round((o_totalprice - m) / d, 6) AS z FROM orders, s")
def r3(spark, sf):
    o = load(spark, sf, "orders")
    return f.normalize(o, F.year("o_orderdate") < 1996, ["o_totalprice"]).select("o_orderkey", F.round("o_totalprice", 6).alias("z"))


@query("r3b_robust_scaling", "WITH s AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.5) AS m, quantile_cont(o_totalprice, 0.75) AS z FROM orders WHERE year(o_orderdate) < 1996) SELECT o_orderkey, round((o_totalprice - m) / (z - a), 6) AS z FROM orders, s")
def r3b(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("z"), F.year("o_orderdate").alias("yr"))
    return rounded(f.normalize(o, F.col("yr") < 1996, ["z"], "robust").drop("yr"), "z")


@query("r4_assign_folds", """WITH u AS (SELECT o_custkey, max((o_orderstatus = 'P')::INT) AS y, ('0x' || substr(md5('f:' || o_custkey::VARCHAR), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE AS h FROM orders GROUP BY 1)
SELECT o_custkey, ((row_number() OVER (PARTITION BY y, floor(h * 256) ORDER BY h, o_custkey) + floor(h * 256)::BIGINT) % 5)::INT AS fold FROM u""")
def r4(spark, sf):
    return f.assign_folds(load(spark, sf, "orders"), "o_custkey", 5, "f", F.col("o_orderstatus") == "P")


@query("r5_subject_overlap", "SELECT count(*) FILTER (n > 1) AS overlapping FROM (SELECT o_custkey, count(DISTINCT year(o_orderdate) > 1995) AS n FROM orders GROUP BY 1)")
def r5(spark, sf):
    return f.subject_overlap(load(spark, sf, "orders").withColumn("fold", F.year("o_orderdate") > 1995), "o_custkey", "fold")


@query("r6_auroc", f"WITH {SC}, r AS (SELECT y, min(k) OVER (PARTITION BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2 AS ar FROM (SELECT *, rank() OVER (ORDER BY p) AS k FROM sc)), s AS (SELECT count(*) AS n, count(*) FILTER (y) AS pos, sum(ar) FILTER (y) AS rs FROM r) SELECT n, pos AS positives, round((rs - pos * (pos + 1) / 2) / (pos::DOUBLE * (n - pos)), 6) AS auroc FROM s")
def r6(spark, sf):
    return rounded(f.auroc(scored(spark, sf), "p", F.col("y")), "auroc")


@query("r6b_average_precision", f"WITH {SC}, t AS (SELECT p, count(*) AS n, count(*) FILTER (y) AS k FROM sc GROUP BY 1), c AS (SELECT *, sum(n) OVER (ORDER BY p DESC) AS cn, sum(k) OVER (ORDER BY p DESC) AS ck FROM t) SELECT round(sum(k * ck / cn) / sum(k), 6) AS auprc FROM c")
def r6b(spark, sf):
    return rounded(f.average_precision(scored(spark, sf), "p", F.col("y")), "auprc")


@query("r6c_assess_binary", f"WITH {SC}, v AS (SELECT *, y::INT::DOUBLE AS t FROM sc), b AS (SELECT least(floor(p * 10), 9) AS b, count(*) AS n, sum(t) AS t, sum(p) AS p, sum((p - t) * (p - t)) AS q, sum(-(t * ln(p) + (1 - t) * ln(1 - p))) AS l FROM v GROUP BY 1) SELECT sum(n)::BIGINT AS n, round(sum(t) / sum(n), 6) AS prevalence, round(sum(q) / sum(n), 6) AS brier, round(sum(l) / sum(n), 6) AS log_loss, round(sum(abs(p - t)) / sum(n), 6) AS ece FROM b")
def r6c(spark, sf):
    return rounded(f.assess_binary(scored(spark, sf), "p", F.col("y")), "prevalence", "brier", "log_loss", "ece")


def _cut(c):
    return f"SELECT {c}::DOUBLE AS threshold, count(*) FILTER (p >= {c}) AS alerts, count(*) FILTER (p >= {c} AND y) AS tp, round(count(*) FILTER (p >= {c} AND y) / count(*) FILTER (y), 6) AS sensitivity, round(count(*) FILTER (p >= {c} AND y) / count(*) FILTER (p >= {c}), 6) AS ppv, round(count(*) FILTER (p >= {c} AND y) / count(*) - count(*) FILTER (p >= {c} AND NOT y) / count(*) * ({c}::DOUBLE / (1 - {c}::DOUBLE)), 6) AS net_benefit FROM sc"


@query("r6d_threshold_table", f"WITH {SC} " + " UNION ALL ".join(_cut(c) for c in (0.25, 0.5, 0.75)))
def r6d(spark, sf):
    return rounded(f.threshold_table(scored(spark, sf), "p", F.col("y"), [0.25, 0.5, 0.75]), "sensitivity", "ppv", "net_benefit")


@query("r7_assess_regression", "WITH d AS (SELECT l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem) SELECT count(*) AS n, round(sqrt(avg((y - p) * (y - p))), 3) AS rmse, round(avg(abs(y - p)), 3) AS mae, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2 FROM d")
def r7(spark, sf):
    d = load(spark, sf, "lineitem").withColumn("p", F.col("l_quantity") * 1500)
    return rounded(rounded(f.assess_regression(d, "l_extendedprice", "p"), "rmse", "mae", to=3), "r2")


@query("r10_adjusted_rand", "WITH t AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1, 2), s AS (SELECT sum(n * (n - 1) / 2) AS s, sum(n) AS n FROM t), a AS (SELECT sum(n * (n - 1) / 2) AS v FROM (SELECT sum(n) AS n FROM t GROUP BY a)), b AS (SELECT sum(n * (n - 1) / 2) AS v FROM (SELECT sum(n) AS n FROM t GROUP BY b)) SELECT round((s.s - a.v * b.v / (s.n * (s.n - 1) / 2)) / ((a.v + b.v) / 2 - a.v * b.v / (s.n * (s.n - 1) / 2)), 6) AS ari FROM s, a, b")
def r10(spark, sf):
    return rounded(f.adjusted_rand(load(spark, sf, "lineitem"), "l_returnflag", "l_linestatus"), "ari")


@query("r12_pair_rules", """WITH b AS (SELECT DISTINCT l_orderkey AS k, p_brand AS i FROM lineitem JOIN part ON l_partkey = p_partkey), n AS (SELECT count(DISTINCT k) AS n FROM b), o AS (SELECT i, count(*) AS f FROM b GROUP BY 1), t AS (SELECT x.i AS a, y.i AS c, count(*) AS f FROM b x JOIN b y ON x.k = y.k AND x.i <> y.i GROUP BY 1, 2 HAVING count(*) >= 150)
SELECT a AS antecedent, c AS consequent, t.f AS n, round(t.f / p.f, 6) AS confidence, round(t.f / p.f / (q.f / n.n), 6) AS lift FROM t JOIN o p ON p.i = a JOIN o q ON q.i = c, n""")
def r12(spark, sf):
    brands = load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return rounded(f.pair_rules(load(spark, sf, "lineitem").join(brands, "l_partkey"), "l_orderkey", "p_brand", 150), "confidence", "lift")


R13 = """WITH q AS (SELECT vec_id AS query, embedding AS a FROM embeddings WHERE vec_id % 20 = 0), s AS (SELECT query, label, list_sum(list_transform(list_zip(a, embedding), lambda p: p[1]::DOUBLE * p[2]::DOUBLE)) / (sqrt(list_sum(list_transform(a, lambda v: v::DOUBLE * v::DOUBLE))) * sqrt(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE)))) AS s, vec_id FROM q JOIN embeddings ON vec_id <> query)
SELECT query, count(*) AS n, round(avg(label), 6) AS mean, round(avg(s), 6) AS similarity FROM (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY query ORDER BY s DESC, vec_id) <= 5) GROUP BY 1"""


@query("r13_similar_units", R13)
@query("r13b_similar_units_all", R13)
def r13(spark, sf):
    e = load(spark, sf, "embeddings")
    return rounded(f.neighbour_profile(e, e.where("vec_id % 20 = 0"), "vec_id", "embedding", F.col("label"), 5), "mean", "similarity")


@query("r17_audit_leakage", f"""WITH {SC}, f AS (SELECT 'p' AS feature, p AS v, y FROM sc UNION ALL SELECT 'same', y::INT, y FROM sc UNION ALL SELECT 'flat', 1, y FROM sc), r AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY v) + (count(*) OVER (PARTITION BY feature, v) - 1) / 2 AS ar FROM f),
s AS (SELECT feature, count(*)::DOUBLE AS n, (count(*) FILTER (y))::DOUBLE AS k, sum(ar) FILTER (y) AS t, count(DISTINCT v) AS n_distinct FROM r GROUP BY 1), u AS (SELECT feature, (t - k * (k + 1) / 2) / (k * (n - k)) AS auroc, n_distinct FROM s) SELECT feature, round(auroc, 6) AS auroc, n_distinct, greatest(auroc, 1 - auroc) > 0.95 OR n_distinct <= 1 AS suspicious FROM u""")
def r17(spark, sf):
    return rounded(f.audit_features(scored(spark, sf).withColumn("same", F.col("y").cast("int")).withColumn("flat", F.lit(1)), ["p", "same", "flat"], F.col("y")), "auroc")


@query("r18_audit_drift", f"""WITH {SC}, f AS (SELECT 'o_totalprice' AS feature, o_totalprice AS v, (o_totalprice >= 100000)::INT + (o_totalprice >= 200000)::INT + (o_totalprice >= 300000)::INT AS bin, yr > 1995 AS g FROM sc UNION ALL SELECT 'p', p, (p >= 0.2)::INT + (p >= 0.5)::INT + (p >= 0.8)::INT, yr > 1995 FROM sc),
c AS (SELECT feature, v, count(*) FILTER (g) AS a, count(*) FILTER (NOT g) AS b FROM f GROUP BY 1, 2), d AS (SELECT feature, abs(sum(a) OVER q / sum(a) OVER (PARTITION BY feature) - sum(b) OVER q / sum(b) OVER (PARTITION BY feature)) AS d FROM c WINDOW q AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING)),
k AS (SELECT feature, bin, count(*) FILTER (g) AS a, count(*) FILTER (NOT g) AS b FROM f GROUP BY 1, 2), s AS (SELECT feature, greatest(a / sum(a) OVER (PARTITION BY feature), 1e-4) AS x, greatest(b / sum(b) OVER (PARTITION BY feature), 1e-4) AS y FROM k)
SELECT s.feature, round(sum((x - y) * ln(x / y)), 6) AS psi, round((SELECT max(d) FROM d WHERE d.feature = s.feature), 6) AS ks FROM s GROUP BY s.feature""")
def r18(spark, sf):
    return rounded(f.audit_drift(scored(spark, sf), {"o_totalprice": [100000, 200000, 300000], "p": [0.2, 0.5, 0.8]}, F.col("yr") > 1995), "psi", "ks")


def _slice(dim, level, group):
    return f"SELECT '{dim}' AS dim, {level} AS level, count(*) AS n, avg((abs(y::INT - p) > 0.5)::INT) AS r FROM sc GROUP BY {group}"


@query("r20_slice_finder", f"WITH {SC}, s AS (" + " UNION ALL ".join([_slice("yr", "yr::VARCHAR", "yr"), _slice("o_orderpriority", "o_orderpriority", "o_orderpriority"), _slice("yr*o_orderpriority", "yr || '*' || o_orderpriority", "yr, o_orderpriority"), "SELECT 'all' AS dim, 'all' AS level, count(*) AS n, avg((abs(y::INT - p) > 0.5)::INT) AS r FROM sc"]) + ") SELECT dim, level, n, round(r, 6) AS error_rate, round(r - (SELECT r FROM s WHERE dim = 'all'), 6) AS excess FROM s WHERE n >= 11")
def r20(spark, sf):
    return rounded(f.slice_finder(scored(spark, sf), ["yr", "o_orderpriority"], F.abs(F.col("y").cast("int") - F.col("p")) > 0.5), "error_rate", "excess")


@query("r22_temporal_holdout", "SELECT CASE WHEN year(o_orderdate) <= 1995 THEN 'dev' WHEN year(o_orderdate) <= 1996 THEN 'holdout' ELSE 'sealed' END AS part, count(*) AS n FROM orders GROUP BY 1")
def r22(spark, sf):
    return f.temporal_holdout(load(spark, sf, "orders"), F.year("o_orderdate"), 1995, 1996)


@query("r23_binomial_cells", """WITH c AS (SELECT o_orderpriority, year(o_orderdate)::INT AS yr, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS e FROM orders GROUP BY 1, 2), r AS (SELECT *, e / n AS rate, sum(e) OVER () / sum(n) OVER () AS m FROM c), v AS (SELECT *, greatest(var_samp(rate) OVER () - avg(m * (1 - m) / n) OVER (), 1e-9) AS v FROM r), k AS (SELECT *, greatest(m * (1 - m) / v - 1, 0) AS k FROM v)
SELECT o_orderpriority, yr, n, e AS events, round(rate, 6) AS rate, round((e + m * k) / (n + k), 6) AS shrunken FROM k""")
def r23(spark, sf):
    return rounded(f.binomial_cells(load(spark, sf, "orders").withColumn("yr", F.year("o_orderdate")), ["o_orderpriority", "yr"], F.col("o_orderstatus") == "F"), "rate", "shrunken")


@query("r24_build_sequences", f"""WITH {AL}, b AS ({BIN.format(6)}), g AS (SELECT user_id, b AS bin FROM (SELECT DISTINCT user_id FROM b), range(-4, 12) r(b)), d AS (SELECT g.user_id, g.bin, last FROM g LEFT JOIN b ON g.user_id = b.user_id AND g.bin = b.bin), s AS (SELECT user_id, bin, coalesce(last_value(last IGNORE NULLS) OVER q, 0) AS v, (last IS NOT NULL)::INT AS m, coalesce(bin - last_value(CASE WHEN last IS NOT NULL THEN bin END IGNORE NULLS) OVER q, -1) AS s FROM d WINDOW q AS (PARTITION BY user_id ORDER BY bin))
SELECT user_id, bin::BIGINT + 4 AS pos, v AS value, m AS mask, s::BIGINT AS since FROM s""")
def r24(spark, sf):
    from strandline.operators.timeline import binned, fill_bins

    g = fill_bins(binned(aligned(spark, sf), ["user_id"], "value", "event_id", 6), ["user_id"], -4, 11)
    s = f.build_sequences(g, "user_id", "bin", "last")
    z = s.select("user_id", F.posexplode(F.arrays_zip("values", "mask", "since")).alias("pos", "z"))
    return z.select("user_id", F.col("pos").cast("long").alias("pos"), F.col("z.values").alias("value"), "z.mask", "z.since")


GRADED = "CASE WHEN a / nullif(t, 0) > 0.05 THEN 'fail' WHEN a / nullif(t, 0) > 0.001 THEN 'warn' ELSE 'ok' END"


@query("s1_validate_keys", f"""WITH r AS (SELECT 'unique' AS check_id, sum(n - 1)::BIGINT AS a, sum(n)::BIGINT AS t FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey) UNION ALL SELECT 'not_null', count(*) FILTER (l_orderkey IS NULL), count(*) FROM lineitem
UNION ALL SELECT 'fk', count(*) FILTER (o_orderkey IS NULL), count(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem) LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderkey % 50 <> 0) ON l_orderkey = o_orderkey) SELECT check_id, 'lineitem' AS "table", 'l_orderkey' AS "column", a AS n_affected, t AS n_total, {GRADED} AS status FROM r""")
def s1(spark, sf):
    return k.validate_keys(load(spark, sf, "lineitem"), "lineitem", "l_orderkey", load(spark, sf, "orders").where("o_orderkey % 50 <> 0"), "o_orderkey")


@query("s2_coverage", "SELECT year(o_orderdate)::INT AS era, count(*) AS n_core, count(l.k) AS n_covered, round(count(l.k) / count(*), 6) AS share FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) l ON o_orderkey = l.k GROUP BY 1")
def s2(spark, sf):
    core = load(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").alias("era"))
    return rounded(k.coverage(load(spark, sf, "lineitem"), core, "l_orderkey", "era"), "share")


@query("s3_infer_key", f"WITH {ENC}, e AS (SELECT event_id, user_id, TIMESTAMP '1995-06-01' + to_days((event_id % 300)::INT) AS t FROM events) SELECT event_id, (SELECT hadm FROM enc WHERE subject = user_id AND t >= start AND t < stop ORDER BY start, stop, hadm LIMIT 1) AS hadm FROM e")
def s3(spark, sf):
    e = load(spark, sf, "events").selectExpr("event_id", "user_id as subject", "timestamp_ntz '1995-06-01' + make_dt_interval(cast(event_id % 300 as int)) as t")
    return k.infer_key_by_time(e, encounters(spark, sf), "subject", "t", "start", "stop", "hadm").select("event_id", "hadm")


@query("s3b_match_counts", "WITH v AS (SELECT o_custkey, o_orderdate AS a, o_orderdate + INTERVAL 200 DAY AS z FROM orders WHERE o_orderkey % 3 = 0), e AS (SELECT o_orderkey, o_custkey, o_orderdate AS t FROM orders), m AS (SELECT e.o_orderkey, count(v.a) AS n_stays FROM e LEFT JOIN v ON v.o_custkey = e.o_custkey AND v.a <= e.t AND e.t < v.z GROUP BY 1) SELECT n_stays, count(*) AS n FROM m GROUP BY 1")
def s3b(spark, sf):
    o = load(spark, sf, "orders")
    v = o.where("o_orderkey % 3 = 0").select("o_custkey", F.col("o_orderdate").alias("a"), (F.col("o_orderdate") + F.expr("interval 200 days")).alias("z"))
    return k.match_counts(o, v, "o_custkey", "o_orderdate", "a", "z")


@query("s4_reference_coverage", "WITH r AS (SELECT DISTINCT p_brand FROM part WHERE p_size > 48), d AS (SELECT DISTINCT p_brand FROM part) SELECT round((SELECT count(*) FROM d WHERE p_brand IN (SELECT p_brand FROM r)) / (SELECT count(*) FROM d), 6) AS dictionary_share, round(count(*) FILTER (p_brand IN (SELECT p_brand FROM r)) / count(*), 6) AS event_share FROM lineitem JOIN part ON l_partkey = p_partkey")
def s4(spark, sf):
    p = load(spark, sf, "part")
    e = load(spark, sf, "lineitem").join(p.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    return rounded(k.reference_coverage(p, p.where("p_size > 48"), e, "p_brand"), "dictionary_share", "event_share")


@query("s5_ed_stays", f"WITH {ENC} SELECT hadm, round((epoch_us(stop) - epoch_us(start)) / {HOUR}, 4) AS los_hours, coalesce(n, 0) AS n_meds, coalesce(n, 0) > 3 AS many FROM enc LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON hadm = l_orderkey")
def s5(spark, sf):
    from strandline.functions.timesem import hours_since

    n = load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("hadm")).agg(F.count("*").alias("n"))
    m = F.coalesce("n", F.lit(0))
    return encounters(spark, sf).join(n, "hadm", "left").select("hadm", F.round(hours_since("start", "stop"), 4).alias("los_hours"), m.alias("n_meds"), (m > 3).alias("many"))


@query("t1_note_stats", "SELECT d.lang, count(*) AS n, quantile_cont(length(text), 0.25) AS q25, quantile_cont(length(text), 0.5) AS q50, quantile_cont(length(text), 0.75) AS q75, round(count(*) / count(DISTINCT d.doc_id), 6) AS per_encounter, round(avg((l.doc_id IS NOT NULL)::INT), 6) AS linked FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id GROUP BY 1")
def t1(spark, sf):
    return rounded(x.note_stats(load(spark, sf, "documents"), "lang", "text", "doc_id", load(spark, sf, "labels").select("doc_id")), "per_encounter", "linked")


@query("t2_sections")
def t2(spark, sf):
    return x.sections(load(spark, sf, "pages"), "page_id", "html", r"<(h1|nav|footer|article)>")


BM = """tk AS (SELECT doc_id, source, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) AS t FROM documents), l AS (SELECT doc_id, source, count(*) AS dl, count(*) FILTER (t = 'idiot') AS f0, count(*) FILTER (t = 'worthless') AS f1 FROM tk WHERE t <> '' GROUP BY 1, 2),
s AS (SELECT avg(dl) AS a, count(*) AS n, count(*) FILTER (f0 > 0) AS d0, count(*) FILTER (f1 > 0) AS d1 FROM l), b AS (SELECT source, ln(1 + (n - d0 + 0.5) / (d0 + 0.5)) * f0 * 2.2 / (f0 + 1.2 * (0.25 + 0.75 * dl / a)) + ln(1 + (n - d1 + 0.5) / (d1 + 0.5)) * f1 * 2.2 / (f1 + 1.2 * (0.25 + 0.75 * dl / a)) AS sc FROM l, s)"""


@query("t3_search_counts", f"WITH {BM} SELECT source, count(*) AS hits, round(avg(sc), 4) AS mean_score FROM b WHERE sc >= 0.5 GROUP BY 1")
def t3(spark, sf):
    return rounded(x.search_counts(load(spark, sf, "documents"), "doc_id", "text", "source", ["idiot", "worthless"], 0.5), "mean_score", to=4)


CUES = """w AS (SELECT doc_id, source, list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda t: t <> '') AS a FROM documents), tk AS (SELECT doc_id, source, unnest(a) AS t, unnest(range(len(a))) AS pos FROM w),
h AS (SELECT doc_id, source, pos, CASE t WHEN 'idiot' THEN 'insult' WHEN 'moron' THEN 'insult' WHEN 'pathetic' THEN 'scorn' END AS concept FROM tk WHERE t IN ('idiot', 'moron', 'pathetic')), c AS (SELECT doc_id, pos AS cp, CASE t WHEN 'of' THEN 'negated' WHEN 'that' THEN 'historical' END AS assertion FROM tk WHERE t IN ('of', 'that')),
e AS (SELECT h.*, coalesce((SELECT assertion FROM c WHERE c.doc_id = h.doc_id AND abs(cp - pos) <= 6 ORDER BY abs(cp - pos), cp, assertion LIMIT 1), 'affirmed') AS assertion FROM h)"""


def concepts(spark, sf):
    return x.extract_concepts(load(spark, sf, "documents"), "doc_id", "text", {"idiot": "insult", "moron": "insult", "pathetic": "scorn"}, {"of": "negated", "that": "historical"})


@query("t4_extract_concepts", f"WITH {CUES} SELECT doc_id, pos::INT AS pos, concept, assertion FROM e")
def t4(spark, sf):
    return concepts(spark, sf)


@query("t5_mention_prevalence", f"WITH {CUES} SELECT concept, source, assertion, CASE WHEN count(*) >= 11 THEN count(*) END AS n, count(*) < 11 AS n_suppressed FROM e GROUP BY 1, 2, 3")
def t5(spark, sf):
    from strandline.operators.disclosure import suppress

    j = concepts(spark, sf).join(load(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    return suppress(j.groupBy("concept", "source", "assertion").agg(F.count("*").alias("n")), ["n"])


PHRASES = phrases.Rules(
    {"idiot": "insult", "pathetic idiot": "strong insult", "moron": "insult", "pathetic": "scorn", "you are": "address", "of the": "of", "in the": "in"},
    (phrases.Cue("that", "historical"), phrases.Cue("to the", "hypothetical", "forward", 4), phrases.Cue("and", "negated", "backward", 3), phrases.Cue("with", "other subject", "both", 5)),
    ("a", "it is"),
)


def mentions(spark, sf):
    return phrases.extract_mentions(load(spark, sf, "documents"), ["doc_id", "source"], "text", PHRASES)


@query("t4b_phrase_mentions")
def t4b(spark, sf):
    return mentions(spark, sf)


@query("t5b_phrase_prevalence")
def t5b(spark, sf):
    from strandline.operators.disclosure import suppress

    return suppress(mentions(spark, sf).groupBy("concept", "source", "assertion").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_docs")), ["n", "n_docs"])


def dated_mentions(spark, sf):
    """Documents stand for notes of the customer whose order has the document's number, written on its day; the anchor is the customer's first order."""
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), "o_custkey", "o_orderdate")
    first = load(spark, sf, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_at"))
    return mentions(spark, sf).join(o, "doc_id").join(first, "o_custkey")


@query("t9b_assertion_flags")
def t9b(spark, sf):
    return phrases.assertion_flags(dated_mentions(spark, sf), ["o_custkey"], F.col("first_at"), "o_orderdate")


@query("t10b_onset_offsets")
def t10b(spark, sf):
    onset = load(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select("o_custkey", F.col("o_orderdate").alias("urgent_at"))
    return phrases.onset_offsets(dated_mentions(spark, sf), onset, ["o_custkey"], "o_orderdate", "urgent_at", 24 * 90)


@query("t7_class_terms", r"""WITH n AS (SELECT lang, t AS term, count(*) AS n FROM (SELECT lang, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS t FROM documents) WHERE t <> '' GROUP BY 1, 2), f AS (SELECT term, sum(n) AS f FROM n GROUP BY 1 HAVING sum(n) >= 11), w AS (SELECT lang, sum(n) AS w FROM n GROUP BY 1), a AS (SELECT avg(w) AS a FROM w),
s AS (SELECT n.lang, n.term, n.n, n.n / w * ln(1 + a / f) AS weight FROM n JOIN f ON n.term = f.term JOIN w ON n.lang = w.lang, a) SELECT lang, term, n, round(weight, 6) AS weight, row_number() OVER (PARTITION BY lang ORDER BY weight DESC, term)::INT AS rank FROM s QUALIFY rank <= 10""")
def t7(spark, sf):
    return rounded(x.class_terms(load(spark, sf, "documents"), "doc_id", "text", "lang", 10), "weight")


@query("t8_classify_text")
def t8(spark, sf):
    d = load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id").select("doc_id", "text", "toxic")
    p = x.classify_text(d.where("doc_id % 4 <> 0"), d.where("doc_id % 4 = 0"), "text", "toxic")
    return p.select("doc_id", "toxic", F.round("p", 3).alias("p"))


@query("t9_text_flags", f"WITH {CUES} SELECT doc_id, count(*) FILTER (assertion = 'affirmed') AS n_affirmed, count(*) FILTER (assertion = 'negated') AS n_negated FROM e GROUP BY 1")
def t9(spark, sf):
    return x.concept_flags(concepts(spark, sf), "doc_id")


@query("t10_text_vs_structured", f"WITH {CUES}, j AS (SELECT l.doc_id, l.toxic = 1 AS b, l.doc_id IN (SELECT doc_id FROM e) AS a FROM labels l) SELECT count(*) FILTER (a AND b) AS tp, count(*) FILTER (a AND NOT b) AS fp, count(*) FILTER (NOT a AND b) AS fn, count(*) FILTER (NOT a AND NOT b) AS tn FROM j")
def t10(spark, sf):
    from strandline.operators.inference import agreement_2x2

    hit = concepts(spark, sf).select("doc_id").distinct().withColumn("a", F.lit(True))
    j = load(spark, sf, "labels").join(hit, "doc_id", "left")
    return agreement_2x2(j, F.coalesce("a", F.lit(False)), F.col("toxic") == 1).select("tp", "fp", "fn", "tn")
