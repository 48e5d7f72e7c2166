"""Queries over urine criteria, physiology matrices, dual code sets, committed buckets, sequence channels, linkage and refits by era (rows of survey 2.1, 2.8, 2.18 and 2.19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import features as f
from strandline.operators import linkage as k
from strandline.operators import models as m
from strandline.operators import phenotypes as p
from strandline.operators import profiling as pr
from strandline.operators.timeline import fill_bins
from strandline.plans.q_assess import _band
from strandline.plans.q_cohorts import DX, dx
from strandline.plans.q_features import scored
from strandline.plans.q_temporal import ENC, HOUR, encounters
from strandline.plans.q_timeline import AL, aligned, rounded
from strandline.plans.registry import query
from strandline.sources import tables as src
from strandline.sources.tables import load


def _urine_frame(h):
    return f"(PARTITION BY user_id ORDER BY us RANGE BETWEEN {h * 3600 * 1_000_000 - 1} PRECEDING AND CURRENT ROW)"


URINE = f"""u AS (SELECT user_id, ts, epoch_us(ts) AS us, sum(CASE WHEN value < 20 THEN 0 ELSE value * 8 END / 70) AS v FROM events GROUP BY 1, 2, 3), g AS (SELECT *, (us - lag(us) OVER (PARTITION BY user_id ORDER BY us)) / 3600e6 AS h FROM u), w AS (SELECT user_id, ts, {', '.join(f"sum(h) OVER {_urine_frame(h)} AS h{h}, sum(CASE WHEN h IS NOT NULL THEN v END) OVER {_urine_frame(h)} AS v{h}" for h in (6, 12, 24))} FROM g),
us AS (SELECT user_id, ts, CASE WHEN (h24 >= 24 AND v24 / h24 < 0.3::DOUBLE) OR (h12 >= 12 AND v12 / h12 = 0) THEN 3 WHEN h12 >= 12 AND v12 / h12 < 0.5::DOUBLE THEN 2 WHEN h6 >= 6 AND v6 / h6 < 0.5::DOUBLE THEN 1 ELSE 0 END AS stage FROM w)"""


def urine(spark, sf):
    e = load(spark, sf, "events").select("user_id", "ts", F.when(F.col("value") < 20, 0.0).otherwise(F.col("value") * 8).alias("ml"), F.lit(70.0).alias("kg"))
    return p.urine_stage(e, "user_id", "ts", "ml", "kg")


@query("h10b_urine_stage", f"WITH {URINE} SELECT * FROM us")
def h10b(spark, sf):
    return urine(spark, sf)


@query("h10c_injury_stage", f"""WITH {URINE}, r AS (SELECT user_id, ts, value / 50 AS x, min(value / 50) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 168 HOUR PRECEDING AND CURRENT ROW) AS a, min(value / 50) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 48 HOUR PRECEDING AND CURRENT ROW) AS b FROM events),
c AS (SELECT user_id, ts, CASE WHEN x / a >= 3 OR (x >= 4.0::DOUBLE AND (x - b >= 0.3::DOUBLE OR x / a >= 1.5::DOUBLE)) THEN 3 WHEN x / a >= 2 THEN 2 WHEN x - b >= 0.3::DOUBLE OR x / a >= 1.5::DOUBLE THEN 1 ELSE 0 END AS stage FROM r), e AS (SELECT user_id, ts, max(stage) AS stage FROM (FROM us UNION ALL FROM c) GROUP BY 1, 2)
SELECT user_id, ts, max(stage) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW) AS stage FROM e""")
def h10c(spark, sf):
    creatinine = p.kdigo_stage(load(spark, sf, "events").withColumn("value", F.col("value") / 50), "user_id", "ts", "value")
    return p.injury_stage(creatinine, urine(spark, sf), "user_id", "ts")


SETS = [("heart", 9, "e.co"), ("heart", 10, "PRO"), ("kidney", 9, "PROMO"), ("kidney", 10, "ECONOMY"), ("kidney", 10, "EC"), ("liver", 9, "SM"), ("liver", 10, "LARGE"), ("liver_severe", 9, "LA"), ("liver_severe", 10, "S")]


@query("h13b_dual_code_sets", f"""WITH {DX}, v(grp, sys, pre) AS (VALUES {', '.join(f"('{a}', {b}, '{c.upper().replace('.', '')}')" for a, b, c in SETS)}), d AS (SELECT DISTINCT o_orderkey, code, CASE WHEN l_quantity > 25 THEN 10 ELSE 9 END AS sys FROM dx), g AS (SELECT DISTINCT o_orderkey, grp FROM d JOIN v ON d.sys = v.sys AND starts_with(code, pre)),
w AS (SELECT o_orderkey, max((grp = 'heart')::INT) AS a, max((grp = 'kidney')::INT) AS b, max((grp = 'liver')::INT) AS c, max((grp = 'liver_severe')::INT) AS d FROM g GROUP BY 1) SELECT o_orderkey, a + b * 2 + CASE WHEN d = 1 THEN 0 ELSE c END + d * 3 AS score FROM w""")
def h13b(spark, sf):
    d = dx(spark, sf).withColumn("sys", F.when(F.col("l_quantity") > 25, 10).otherwise(9))
    groups = p.dual_groups(d, "o_orderkey", "code", "sys", spark.createDataFrame(SETS, "group string, system int, prefix string"))
    return p.weighted_groups(groups, "o_orderkey", "group", {"heart": 1, "kidney": 2, "liver": 1, "liver_severe": 3}, {"liver": "liver_severe"})


#: Measures that the events stand for, off the cuts of every band.
GASES = {"ph": "7 + (event_id % 80 + 0.5) / 100", "paco2": "15 + event_id % 50 + 0.25", "pao2": "40 + value", "fio2": "(21 + event_id % 79 + 0.5) / 100", "eyes": "1 + event_id % 4", "verbal": "CASE WHEN event_id % 9 = 0 THEN NULL ELSE 1 + event_id % 5 END", "motor": "1 + (event_id // 5) % 6"}


def _matrix(x, y, cuts, rows):
    each = [_bands(y, *r) for r in rows]
    return f"CASE WHEN {x} IS NULL THEN 0 " + " ".join(f"WHEN {x} >= {c}::DOUBLE THEN {r}" for c, r in reversed(list(zip(cuts, each[1:], strict=True)))) + f" ELSE {each[0]} END"


def _bands(v, cuts, points):
    return _band(v, cuts, points) if cuts else f"CASE WHEN {v} IS NULL THEN 0 ELSE {points[0]} END"


@query("h16c_physiology_matrices", f"""WITH x AS (SELECT event_id, {', '.join(f'({e})::DOUBLE AS {n}' for n, e in GASES.items())}, event_type IN ('view', 'click') AS vent FROM events)
SELECT event_id, ({_matrix('ph', 'paco2', *p.ACID_BASE)})::INT AS acid_base, (CASE WHEN vent AND fio2 >= 0.5::DOUBLE THEN {_band('(fio2 * 713 - paco2 / 0.8::DOUBLE - pao2)', *p.OXYGENATION['gradient'])} ELSE {_band('pao2', *p.OXYGENATION['pao2'])} END)::INT AS oxygenation,
(CASE WHEN eyes > 1 THEN {_matrix('verbal', 'motor', *p.NERVOUS['open'])} ELSE {_matrix('verbal', 'motor', *p.NERVOUS['shut'])} END)::INT AS nervous FROM x""")
def h16c(spark, sf):
    x = load(spark, sf, "events").select("event_id", F.col("event_type").isin("view", "click").alias("vent"), *[F.expr(e.replace("event_id // 5", "event_id div 5")).cast("double").alias(n) for n, e in GASES.items()])
    c = F.col
    acid, breath, mind = p.acid_base_points(c("ph"), c("paco2")), p.oxygenation_points(c("pao2"), c("paco2"), c("fio2"), c("vent")), p.nervous_points(c("eyes"), c("verbal"), c("motor"))
    return x.select("event_id", acid.cast("int").alias("acid_base"), breath.cast("int").alias("oxygenation"), mind.cast("int").alias("nervous"))


@query("a4b_committed_buckets", "WITH o AS (SELECT (o_custkey % 16)::INT AS bucket, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) SELECT b.bucket::INT AS bucket, coalesce(n, 0) AS n_rows, coalesce(n, 0) AS n_read, total FROM range(16) b(bucket) LEFT JOIN o ON o.bucket = b.bucket")
def a4b(spark, sf):
    path = src.scratch(spark, "committed")
    o = load(spark, sf, "orders")
    src.write_committed(o, "o_custkey", path, "orders", ("o_custkey", "o_orderdate"), 16, sweep=8)
    src.write_committed(o, "o_custkey", path, "orders", ("o_custkey", "o_orderdate"), 16)  # finds all buckets committed and writes none
    read = src.read_committed(spark, path, list(range(16))).groupBy(F.col("subject_bucket").alias("bucket")).agg(F.count("*").alias("n_read"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return src.commits(spark, path).select("bucket", "n_rows").join(read, "bucket", "left").withColumn("n_read", F.coalesce("n_read", F.lit(0)))


CHANNELS = ["click", "view", "error"]
_W = "arg_max(value, (h, event_id)) FILTER (event_type = '{0}') AS {0}"
_CH = ", ".join(f"coalesce(last_value(({c} - m_{c}) / s_{c} IGNORE NULLS) OVER q, 0) AS v_{c}, ({c} IS NOT NULL)::INT AS m_{c}, coalesce(bin - last_value(CASE WHEN {c} IS NOT NULL THEN bin END IGNORE NULLS) OVER q, -1)::BIGINT AS s_{c}" for c in CHANNELS)


@query("r24b_sequence_channels", f"""WITH {AL}, b AS (SELECT user_id, floor(h / 6)::BIGINT AS bin, {', '.join(_W.format(c) for c in CHANNELS)} FROM al GROUP BY 1, 2), g AS (SELECT user_id, b AS bin FROM (SELECT DISTINCT user_id FROM b), range(-4, 12) r(b)), d AS (SELECT g.user_id, g.bin, {', '.join(CHANNELS)} FROM g LEFT JOIN b ON g.user_id = b.user_id AND g.bin = b.bin),
t AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in CHANNELS)} FROM d WHERE user_id % 3 > 0), s AS (SELECT user_id, bin, {_CH} FROM d, t WINDOW q AS (PARTITION BY user_id ORDER BY bin))
""" + " UNION ALL ".join(f"SELECT user_id, '{c}' AS variable, bin::BIGINT + 4 AS pos, round(v_{c}, 6) AS value, m_{c} AS mask, s_{c} AS since FROM s" for c in CHANNELS))
def r24b(spark, sf):
    at = F.struct("hours_since_anchor", "event_id")
    last = [F.max_by(F.when(F.col("event_type") == c, F.col("value")), F.when(F.col("event_type") == c, at)).alias(c) for c in CHANNELS]
    b = aligned(spark, sf).groupBy("user_id", F.floor(F.col("hours_since_anchor") / 6).alias("bin")).agg(F.count("*").alias("n"), *last)
    s = f.sequence_channels(fill_bins(b, ["user_id"], -4, 11), "user_id", "bin", CHANNELS, F.col("user_id") % 3 > 0)
    each = s.select("user_id", F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.arrays_zip(f"{c}.values", f"{c}.mask", f"{c}.since").alias("z")) for c in CHANNELS])).alias("c"))
    z = each.select("user_id", "c.variable", F.posexplode("c.z").alias("pos", "z"))
    return z.select("user_id", "variable", F.col("pos").cast("long").alias("pos"), F.round("z.values", 6).alias("value"), "z.mask", "z.since")


@query("s2b_source_coverage", "WITH s AS (SELECT l_suppkey, l_orderkey, o_orderkey IS NOT NULL AS h FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') ON l_orderkey = o_orderkey) SELECT count(*) AS n_rows, count(*) FILTER (h) AS rows_linked, count(DISTINCT l_suppkey) AS n_subjects, count(DISTINCT l_suppkey) FILTER (h) AS subjects_linked, round(count(*) FILTER (h) / count(*), 6) AS row_share, round(count(DISTINCT l_suppkey) FILTER (h) / count(DISTINCT l_suppkey), 6) AS subject_share FROM s")
def s2b(spark, sf):
    core = load(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return rounded(k.source_coverage(load(spark, sf, "lineitem"), "l_orderkey", "l_suppkey", core), "row_share", "subject_share")


@query("s2c_temporal_consistency", f"WITH {ENC} SELECT year(start)::INT AS era, count(*) AS n_linked, count(*) FILTER (l_shipdate BETWEEN start - INTERVAL 24 HOUR AND stop + INTERVAL 24 HOUR) AS n_inside, round(count(*) FILTER (l_shipdate BETWEEN start - INTERVAL 24 HOUR AND stop + INTERVAL 24 HOUR) / count(*), 6) AS share FROM lineitem JOIN enc ON l_orderkey = hadm GROUP BY 1")
def s2c(spark, sf):
    core = encounters(spark, sf).withColumn("era", F.year("start"))
    source = load(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "hadm")
    return rounded(k.temporal_consistency(source, "hadm", "l_shipdate", core, "start", "stop", "era"), "share")


_VITALS = {"temperature": ("value / 2 + 50", 5 / 9, -160 / 9, 25.0, 45.0), "heart_rate": ("value", 1.0, 0.0, 20.0, 150.0)}


@query("s5b_triage", """WITH v AS (SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INT) AS k, (value / 2 + 50) * (5 / 9.0::DOUBLE) - 160 / 9.0::DOUBLE AS t, value AS h FROM events)
SELECT event_id, CASE WHEN k BETWEEN 1 AND 5 THEN k END AS acuity, round(CASE WHEN t BETWEEN 25 AND 45 THEN t END, 4) AS temperature, CASE WHEN h BETWEEN 20 AND 150 THEN h END AS heart_rate, (t NOT BETWEEN 25 AND 45)::INT + (h NOT BETWEEN 20 AND 150)::INT AS implausible FROM v""")
def s5b(spark, sf):
    e = load(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), *[F.expr(x).alias(n) for n, (x, *_) in _VITALS.items()])
    return rounded(k.triage(e, ["event_id"], "k", {n: v[1:] for n, v in _VITALS.items()}), "temperature", to=4)


@query("s5c_drug_flags", f"""WITH {ENC}, m AS (SELECT l_orderkey, l_shipdate, regexp_matches(p_name, '(^| )(bolt|cold widget)( |$)') AS hit FROM lineitem JOIN part ON l_partkey = p_partkey), g AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (hit) AS f, min(l_shipdate) FILTER (hit) AS first_at FROM m GROUP BY 1)
SELECT hadm, coalesce(n, 0) AS n_meds, coalesce(f, 0) AS n_flagged, round((epoch_us(first_at) - epoch_us(start)) / {HOUR}, 4) AS first_flagged_hours FROM enc LEFT JOIN g ON hadm = l_orderkey""")
def s5c(spark, sf):
    name = load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.concat(F.initcap("p_name"), F.lit(" 2.5 mg")).alias("drug"))
    meds = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("hadm"), "l_partkey", "l_shipdate").join(name, "l_partkey")
    return rounded(k.drug_flags(encounters(spark, sf), "hadm", "start", meds, "l_shipdate", "drug", ["bolt", "Cold  Widget"]), "first_flagged_hours", to=4)


@query("r18d_era_refits")
def r18d(spark, sf):
    d = scored(spark, sf).withColumn("label", F.col("y").cast("int")).withColumn("era", F.when(F.col("yr") < 1996, "early").when(F.col("yr") < 1999, "middle").otherwise("late"))
    return rounded(m.era_refits(d.withColumnRenamed("p", "risk"), ["risk", "o_totalprice"], "label", "era", "o_orderkey"), "auroc_own", "auroc_others", "auroc_mixed", to=2)


@query("d1b_table_sizes")
def d1b(spark, sf):
    return pr.table_sizes(spark, {t: f"{sf}/{t}.parquet" for t in ("orders", "events", "documents", "pages")})


_LEVELS = ("doc_id", "lang", "source", "n_chars")


@query("d4b_level_counts", "WITH l AS (" + " UNION ALL ".join(f"SELECT '{c}' AS c, {c}::VARCHAR AS level, count(*) AS n FROM documents WHERE {c} IS NOT NULL AND (SELECT count(DISTINCT {c}) FROM documents) <= 50 GROUP BY 2" for c in _LEVELS) + ") SELECT c AS \"column\", level, n, (row_number() OVER (PARTITION BY c ORDER BY n DESC, level))::INT AS rank FROM l QUALIFY rank <= 10")
def d4b(spark, sf):
    return pr.level_counts(load(spark, sf, "documents").select(*_LEVELS))
