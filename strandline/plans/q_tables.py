"""Queries over sources and sinks, time semantics and scalar functions (survey 2.1 and 2.2)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions import timesem as ts
from strandline.plans.registry import query
from strandline.sources import tables as src
from strandline.sources.tables import load

EVENTS = T.StructType(
    [T.StructField(n, t) for n, t in (("event_id", T.LongType()), ("ts", T.TimestampNTZType()), ("user_id", T.LongType()), ("event_type", T.StringType()), ("value", T.DoubleType()), ("props", T.StringType()))]
)


@query("a1_read_contract", "SELECT event_type, count(*) AS n, sum(user_id)::BIGINT AS users, round(sum(value), 2) AS total, max(ts) AS last_ts, count(DISTINCT props) AS n_props FROM events GROUP BY event_type")
def a1(spark, sf):
    path = src.scratch(spark, "csv")
    src.write_contract(load(spark, sf, "events").select(*EVENTS.names), path)
    df = src.read_contract(spark, src.TableSpec("events", EVENTS), path)
    return df.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("user_id").alias("users"), F.round(F.sum("value"), 2).alias("total"), F.max("ts").alias("last_ts"), F.countDistinct("props").alias("n_props"))


@query("a2_column_map", "SELECT c_custkey AS subject_id, c_name AS name, c_acctbal AS balance, NULL::VARCHAR AS phone FROM customer")
def a2(spark, sf):
    spec = src.TableSpec("subject", T.StructType.fromDDL("subject_id bigint, name string, balance double, phone string"))
    cmap = src.ColumnMap(rename={"c_custkey": "subject_id", "c_name": "name", "c_acctbal": "balance"}, drop=("c_nationkey", "c_mktsegment"), add=("phone",))
    return src.apply_column_map(load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey", "c_mktsegment"), cmap, spec)


def _raw():
    return F.concat(F.when(F.col("event_id") % 7 == 0, F.lit("x")).otherwise(F.lit("")), F.get_json_object("props", "$.k"))


@query("a3_split_rejects", """WITH r AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'x' ELSE '' END || json_extract_string(props, '$.k') AS k FROM events)
SELECT CASE WHEN k IS NOT NULL AND try_cast(k AS INT) IS NULL THEN 'reject' ELSE 'good' END AS part, count(*) AS n, sum(try_cast(k AS INT))::BIGINT AS total FROM r GROUP BY 1""")
def a3(spark, sf):
    spec = src.TableSpec("props", T.StructType.fromDDL("event_id bigint, k int"))
    raw = load(spark, sf, "events").select(F.col("event_id").cast("string").alias("event_id"), _raw().alias("k"))
    good, bad = src.split_rejects(raw, spec)
    both = good.select(F.lit("good").alias("part"), "k").unionByName(bad.select(F.lit("reject").alias("part"), F.lit(None).cast("int").alias("k")))
    return both.groupBy("part").agg(F.count("*").alias("n"), F.sum("k").alias("total"))


@query("a4_write_bucketed", "SELECT (o_custkey % 100)::INT AS subject_bucket, count(*) AS n, min(o_orderkey) AS first_key, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def a4(spark, sf):
    path = src.scratch(spark, "bucketed")
    src.write_bucketed(load(spark, sf, "orders"), "o_custkey", path, ("o_custkey", "o_orderdate"))
    return src.read_buckets(spark, path).groupBy("subject_bucket").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("a5_write_dim", "SELECT p_partkey, p_brand, p_type, p_size FROM part")
def a5(spark, sf):
    path = src.scratch(spark, "dim")
    src.write_dim(load(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size"), ["p_partkey"], path)
    return spark.read.parquet(path)


@query("a6_read_buckets", "SELECT o_orderkey, o_custkey, (o_custkey % 100)::INT AS subject_bucket FROM orders WHERE o_custkey % 100 < 5")
def a6(spark, sf):
    path = src.scratch(spark, "tier")
    src.write_bucketed(load(spark, sf, "orders"), "o_custkey", path)
    return src.read_buckets(spark, path, 5).select("o_orderkey", "o_custkey", "subject_bucket")


@query("a7_file_inventory")
def a7(spark, sf):
    return src.file_inventory(spark, f"{sf}/lineitem.parquet").select("bytes", "n_rows")


@query("a8_snapshot_id")
def a8(spark, sf):
    return src.snapshot_id(src.file_inventory(spark, f"{sf}/orders.parquet").select("bytes", "n_rows"), ["bytes", "n_rows"])


@query("a9_table_fingerprint")
def a9(spark, sf):
    df = load(spark, sf, "lineitem")
    return src.table_fingerprint(df, df.columns)


@query("a10_reconcile", """WITH e AS (SELECT event_type AS name, count(*) AS n FROM events GROUP BY 1), x AS (SELECT name, CASE WHEN name = 'error' THEN n + 1 ELSE n END AS n FROM e WHERE name <> 'click' UNION ALL SELECT 'absent', 5)
SELECT coalesce(x.name, e.name) AS name, x.n AS expected, e.n AS observed, e.n - x.n AS delta, CASE WHEN e.n IS NULL THEN 'pending' WHEN x.n IS NULL THEN 'no-expectation' WHEN e.n = x.n THEN 'match' ELSE 'mismatch' END AS status
FROM x FULL JOIN e ON x.name = e.name""")
def a10(spark, sf):
    seen = load(spark, sf, "events").groupBy(F.col("event_type").alias("name")).agg(F.count("*").alias("n_rows"))
    wanted = seen.where("name <> 'click'").withColumn("n_rows", F.col("n_rows") + (F.col("name") == "error").cast("long"))
    absent = seen.agg(F.lit("absent").alias("name"), F.lit(5).cast("long").alias("n_rows"))
    return src.reconcile(wanted.unionByName(absent), seen)


@query("a11_register_views", "SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'nation', count(*) FROM nation")
def a11(spark, sf):
    src.register_views(spark, sf, ["orders", "nation"])
    return spark.sql("SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'nation', count(*) FROM nation")


@query("a12_ledger", "SELECT json_extract_string(props, '$.k')::BIGINT AS k, count(*) AS n FROM events GROUP BY 1")
def a12(spark, sf):
    path = src.scratch(spark, "ledger")
    e = load(spark, sf, "events").select("event_id", F.from_json("props", "k long").alias("p"))
    src.append_ledger(e.where("event_id % 2 = 0"), path)
    src.append_ledger(e.where("event_id % 2 = 1").withColumn("note", F.lit("odd")), path)
    return src.read_ledger(spark, path).groupBy(F.col("p.k").alias("k")).agg(F.count("*").alias("n"))


@query("a13_mapped_view", "SELECT event_id, try_cast(event_type AS DOUBLE) AS kind, event_type AS kind_raw, round(value * 2, 6) AS doubled FROM events")
def a13(spark, sf):
    e = load(spark, sf, "events").withColumn("twice", F.col("value") * 2)
    out = src.mapped_view(e, {"event_id": ("event_id", "bigint"), "kind": ("event_type", "double"), "doubled": ("twice", "double")})
    return out.withColumn("doubled", F.round("doubled", 6))


_FIRST = "SELECT *, min(ts) OVER (PARTITION BY user_id) AS first_ts FROM events"


def _first(spark, sf):
    e = load(spark, sf, "events")
    return e.join(e.groupBy("user_id").agg(F.min("ts").alias("first_ts")), "user_id")


@query("b1_hours_since", f"SELECT event_id, round(epoch_us(ts) / 3600e6 - epoch_us(first_ts) / 3600e6, 4) AS hours, round((epoch_us(ts) - epoch_us(first_ts)) / 86400e6, 4) AS days FROM ({_FIRST})")
def b1(spark, sf):
    return _first(spark, sf).select("event_id", F.round(ts.hours_since("first_ts", "ts"), 4).alias("hours"), F.round(ts.days_since("first_ts", "ts"), 4).alias("days"))


@query("b2_hour_bin", f"SELECT event_id, floor((epoch_us(ts) - epoch_us(first_ts)) / 3600e6 / 6)::BIGINT AS bin6, floor((epoch_us(ts) - epoch_us(first_ts)) / 3600e6 / 24)::BIGINT AS day FROM ({_FIRST})")
def b2(spark, sf):
    h = ts.hours_since("first_ts", "ts")
    return _first(spark, sf).select("event_id", ts.hour_bin(h, 6).alias("bin6"), ts.icu_day(h).alias("day"))


@query("b3_age_at", """SELECT o_orderkey, least(85 + year(o_orderdate) - year(min(o_orderdate) OVER (PARTITION BY o_custkey)), 91)::INT AS age,
least(85 + year(o_orderdate) - year(min(o_orderdate) OVER (PARTITION BY o_custkey)), 91) >= 91 AS capped FROM orders""")
def b3(spark, sf):
    o = load(spark, sf, "orders")
    o = o.join(o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first")), "o_custkey")
    age = ts.age_at(F.lit(85), F.year("first"), F.col("o_orderdate"))
    return o.select("o_orderkey", age.cast("int").alias("age"), ts.age_capped(age).alias("capped"))


ERAS = (1992, 1994, 1995, 1997, 1998)
ERA_SQL = "CASE WHEN year({0}) < 1994 THEN 0 WHEN year({0}) < 1995 THEN 1 WHEN year({0}) < 1997 THEN 2 WHEN year({0}) < 1998 THEN 3 ELSE 4 END"


@query("b4_era_index", f"SELECT {ERA_SQL.format('o_orderdate')}::INT AS era, count(*) AS n FROM orders GROUP BY 1")
def b4(spark, sf):
    return load(spark, sf, "orders").groupBy(ts.era_index(F.year("o_orderdate"), ERAS).alias("era")).agg(F.count("*").alias("n"))


@query("b5_code_system", """WITH c AS (SELECT l_orderkey, substr(p_type, 1, 1) AS fam FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT l_orderkey, CASE WHEN min(fam) = max(fam) THEN min(fam) ELSE 'mixed' END AS code_system FROM c GROUP BY 1""")
def b5(spark, sf):
    p = load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.substring("p_type", 1, 1).alias("fam"))
    return ts.code_system(load(spark, sf, "lineitem").join(p, "l_partkey"), "l_orderkey", "fam")


@query("b6_follow_up_end", """WITH o AS (SELECT o_orderkey, o_orderdate, max(o_orderdate) OVER (PARTITION BY o_custkey) AS last FROM orders)
SELECT o_orderkey, least(o_orderdate + INTERVAL 730 DAY, last + INTERVAL 365 DAY) AS follow_up_end,
CASE WHEN last + INTERVAL 365 DAY < o_orderdate + INTERVAL 730 DAY THEN 'last-contact' ELSE 'horizon' END AS reason FROM o""")
def b6(spark, sf):
    o = load(spark, sf, "orders")
    o = o.join(o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last")), "o_custkey")
    a, z = F.col("o_orderdate"), F.col("last")
    return o.select("o_orderkey", ts.follow_up_end(a, z, 730).alias("follow_up_end"), ts.censor_reason(a, z, 730).alias("reason"))


@query("b7_band", """SELECT CASE WHEN l_quantity >= 40 THEN 3 WHEN l_quantity >= 20 THEN 2 WHEN l_quantity >= 10 THEN 1 ELSE 0 END::INT AS band,
CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'kept' ELSE 'other' END AS grp, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def b7(spark, sf):
    b = ts.band(F.col("l_quantity"), [10, 20, 40]).alias("band")
    return load(spark, sf, "lineitem").groupBy(b, ts.collapse(F.col("l_returnflag"), {"R": "returned", "A": "kept"}).alias("grp")).agg(F.count("*").alias("n"))


_RULES = [("click", "raw", 2.0, 0.0, "u2", 0.0, 150.0), ("error", "raw", 1.8, 32.0, "F", 32.0, 500.0), ("view", "raw", 0.5, 0.0, "u0.5", 0.0, 1000.0)]


@query("b8_harmonize", """WITH r(item, factor, shift, to_unit, low, high) AS (VALUES ('click', 2.0::DOUBLE, 0.0::DOUBLE, 'u2', 0.0, 150.0), ('error', 1.8, 32.0, 'F', 32.0, 500.0), ('view', 0.5, 0.0, 'u0.5', 0.0, 1000.0))
SELECT event_id, round(CASE WHEN factor IS NULL THEN value ELSE value * factor + shift END, 6) AS value, coalesce(to_unit, 'raw') AS unit, factor IS NOT NULL AS converted,
value * factor + shift BETWEEN low AND high AS plausible FROM events LEFT JOIN r ON item = event_type""")
def b8(spark, sf):
    rules = spark.createDataFrame(_RULES, "item string, unit string, factor double, shift double, to_unit string, low double, high double")
    h = ts.harmonize(load(spark, sf, "events").withColumn("unit", F.lit("raw")), "event_type", "value", "unit", rules)
    return h.select("event_id", F.round("harmonized.value", 6).alias("value"), "harmonized.unit", "harmonized.converted", "harmonized.plausible")


@query("b9_plausible", "SELECT event_id, value BETWEEN 10 AND 200 AS plausible, least(greatest(value, 10), 200)::DOUBLE AS clipped FROM events")
def b9(spark, sf):
    v = F.col("value")
    return load(spark, sf, "events").select("event_id", ts.plausible(v, 10, 200).alias("plausible"), ts.clip_to_plausible(v, 10.0, 200.0).alias("clipped"))


@query("b10_sensitive_scan", r"""SELECT 'doc_id' AS "column", count(*) FILTER (doc_id BETWEEN 100 AND 200) AS n_hits, count(*) AS n_total FROM documents
UNION ALL SELECT 'n_chars', count(*) FILTER (n_chars BETWEEN 100 AND 200), count(*) FROM documents
UNION ALL SELECT 'text', count(*) FILTER (regexp_matches(text, '(^|[^0-9])[0-9]{8}([^0-9]|$)')), count(*) FROM documents""")
def b10(spark, sf):
    return ts.sensitive_scan(load(spark, sf, "documents").select("doc_id", "text", "n_chars"), 100, 200, 8)


@query("b11_parse_value", r"""WITH t AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '<' || k WHEN 1 THEN k || '-' || (k::INT + 1) WHEN 2 THEN k || '/80' ELSE k END AS s FROM (SELECT event_id, json_extract_string(props, '$.k') AS k FROM events))
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'bound' WHEN 1 THEN 'range' WHEN 2 THEN 'pair' ELSE 'number' END AS kind, regexp_extract(s, '([0-9]+)', 1)::DOUBLE AS low,
CASE WHEN event_id % 4 IN (1, 2) THEN regexp_extract(s, '[-/]([0-9]+)$', 1) ELSE regexp_extract(s, '([0-9]+)', 1) END::DOUBLE AS high FROM t""")
def b11(spark, sf):
    k = F.get_json_object("props", "$.k")
    m = F.col("event_id") % 4
    s = F.when(m == 0, F.concat(F.lit("<"), k)).when(m == 1, F.concat(k, F.lit("-"), (k.cast("int") + 1).cast("string"))).when(m == 2, F.concat(k, F.lit("/80"))).otherwise(k)
    return load(spark, sf, "events").select("event_id", ts.parse_value(s).alias("v")).select("event_id", "v.kind", "v.low", "v.high")


@query("b12_normalize_code", "SELECT DISTINCT upper(replace(trim(p_type), '.', '')) AS code FROM part")
def b12(spark, sf):
    return load(spark, sf, "part").select(ts.normalize_code(F.col("p_type")).alias("code")).distinct()


@query("b13_hash_partition")
def b13(spark, sf):
    return load(spark, sf, "customer").groupBy(ts.hash_partition(F.col("c_custkey"), 7, 5).alias("fold")).agg(F.count("*").alias("n"))


@query("b14_stratified_sample", """WITH u AS (SELECT o_custkey, min(o_orderpriority) AS s FROM orders GROUP BY 1),
r AS (SELECT o_custkey, row_number() OVER (PARTITION BY s ORDER BY ('0x' || substr(md5('s1:' || o_custkey::VARCHAR), 1, 12))::BIGINT, o_custkey) AS r FROM u)
SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey IN (SELECT o_custkey FROM r WHERE r <= 20) GROUP BY 1""")
def b14(spark, sf):
    return ts.stratified_sample(load(spark, sf, "orders"), "o_custkey", "o_orderpriority", 20, "s1").groupBy("o_custkey").agg(F.count("*").alias("n"))
