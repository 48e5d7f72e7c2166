"""Queries over checks and profiles (survey 2.3 and 2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import checks as c
from strandline.operators import profiling as p
from strandline.plans.registry import query
from strandline.sources.tables import TableSpec, load, persisted


def res(check: str, table: str, column: str, affected: str, source: str, total: str = "count(*)", status: str | None = None) -> str:
    status = status or "CASE WHEN a = 0 THEN 'ok' ELSE 'fail' END"
    return f"""SELECT '{check}' AS check_id, '{table}' AS "table", '{column}' AS "column", a AS n_affected, t AS n_total, {status} AS status FROM (SELECT coalesce({affected}, 0)::BIGINT AS a, ({total})::BIGINT AS t FROM {source})"""


GRADE = "CASE WHEN a / t > {1} THEN 'fail' WHEN a / t > {0} THEN 'warn' ELSE 'ok' END"
HALF = "(SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS bal FROM customer)"


@query("c1_check_schema", "SELECT 'schema' AS check_id, 'orders' AS \"table\", x AS \"column\", 0::BIGINT AS n_affected, (SELECT count(*) FROM orders) AS n_total, 'ok' AS status FROM (SELECT column_name AS x FROM (DESCRIBE orders) UNION ALL SELECT '*')")
def c1(spark, sf):
    df = load(spark, sf, "orders")
    return c.check_schema(df, TableSpec("orders", df.schema))


@query("c2_check_not_null", res("not_null", "customer", "c_custkey", "count(*) FILTER (c_custkey IS NULL)", "customer") + " UNION ALL " + res("not_null", "customer", "bal", "count(*) FILTER (bal IS NULL)", HALF))
def c2(spark, sf):
    df = load(spark, sf, "customer").withColumn("bal", F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")))
    return c.check_not_null(df, "customer", ["c_custkey", "bal"])


_DUP = "(SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"


@query("c3_check_unique", res("unique", "lineitem", "l_orderkey,l_linenumber", "sum(n - 1)", _DUP, "sum(n)"))
def c3(spark, sf):
    return c.check_unique(load(spark, sf, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])


def _fk(check, child, key, parent, pkey):
    return res(check, child, key, "count(*) FILTER (p.k IS NULL)", f"(SELECT DISTINCT {key} AS k FROM {child} WHERE {key} IS NOT NULL) c LEFT JOIN (SELECT DISTINCT {pkey} AS k FROM {parent}) p ON c.k = p.k")


@query("c4_check_fk", _fk("fk", "lineitem", "l_orderkey", "orders", "o_orderkey") + " UNION ALL " + _fk("fk", "orders", "o_orderkey", "lineitem", "l_orderkey"))
def c4(spark, sf):
    li, o = load(spark, sf, "lineitem"), load(spark, sf, "orders")
    return c.check_fk(li, "lineitem", ["l_orderkey"], o, ["o_orderkey"]).unionByName(c.check_fk(o, "orders", ["o_orderkey"], li, ["l_orderkey"]))


LINKS = [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("customer", "c_nationkey", "nation", "n_nationkey"), ("nation", "n_regionkey", "region", "r_regionkey")]


@query("c5_check_all_fks", " UNION ALL ".join(_fk("fk", *x) for x in LINKS))
def c5(spark, sf):
    tables = {t: load(spark, sf, t) for t in {x for a, _, b, _ in LINKS for x in (a, b)}}
    return c.check_all_fks(tables, [c.Link(a, (k,), b, (q,)) for a, k, b, q in LINKS])


@query("c6_check_pair", res("pair", "lineitem", "l_partkey,l_suppkey", "count(*) FILTER (s.k IS NULL)", "(SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) l LEFT JOIN (SELECT DISTINCT l_partkey AS k, l_suppkey AS s FROM lineitem WHERE l_quantity > 10) s ON l.l_partkey = s.k AND l.l_suppkey = s.s"))
def c6(spark, sf):
    li = load(spark, sf, "lineitem")
    return c.check_pair(li, "lineitem", ["l_partkey", "l_suppkey"], li.where("l_quantity > 10"), ["l_partkey", "l_suppkey"])


@query("c7_check_sorted", res("sorted", "orders", "o_orderkey", "count(*) FILTER (p > o_orderkey)", "(SELECT o_orderkey, lag(o_orderkey) OVER (ORDER BY file_row) AS p FROM (SELECT o_orderkey, row_number() OVER () AS file_row FROM orders))"))
def c7(spark, sf):
    return c.check_sorted(load(spark, sf, "orders"), "orders", ["o_orderkey"])


@query("c8_check_order", res("order", "lineitem", "o_orderdate<=l_shipdate", "count(*) FILTER (o_orderdate > l_shipdate)", "lineitem JOIN orders ON l_orderkey = o_orderkey"))
def c8(spark, sf):
    df = load(spark, sf, "lineitem").join(load(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return c.check_order(df, "lineitem", "o_orderdate", "l_shipdate")


_SENT = "(SELECT o_orderstatus = 'F' AS f, l.k IS NOT NULL AS p FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_linestatus = 'F') l ON o_orderkey = l.k)"


@query("c9_check_flag_agrees", res("flag", "orders", "filled", "count(*) FILTER (f <> p)", _SENT))
def c9(spark, sf):
    filled = load(spark, sf, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey"), F.lit(True).alias("p")).distinct()
    df = load(spark, sf, "orders").join(filled, "o_orderkey", "left")
    return c.check_flag_agrees(df, "orders", F.col("o_orderstatus") == "F", F.col("p").isNotNull(), "filled")


@query("c10_check_group_max", res("group_max", "orders", "o_orderdate", "count(*) FILTER (o_orderdate < m)", "orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS m FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey"))
def c10(spark, sf):
    return c.check_against_group_max(load(spark, sf, "orders"), "orders", "o_orderkey", "o_orderdate", load(spark, sf, "lineitem"), "l_orderkey", "l_shipdate")


@query("c11_check_domain", res("domain", "lineitem", "discounted", "count(*) FILTER (NOT (l_discount <= 0.05 OR l_quantity >= 10))", "lineitem"))
def c11(spark, sf):
    return c.check_domain(load(spark, sf, "lineitem"), "lineitem", "discounted", (F.col("l_discount") <= 0.05) | (F.col("l_quantity") >= 10))


@query("c12_check_contained", res("contained", "lineitem", "l_shipdate,l_shipdate", "count(*) FILTER (l_shipdate < o_orderdate - INTERVAL 6 HOUR OR l_shipdate > o_orderdate + to_days((1 + o_orderkey % 14)::INT) + INTERVAL 6 HOUR)", "lineitem JOIN orders ON l_orderkey = o_orderkey"))
def c12(spark, sf):
    o = load(spark, sf, "orders").selectExpr("o_orderkey as l_orderkey", "o_orderdate as lo", "o_orderdate + make_dt_interval(cast(1 + o_orderkey % 14 as int)) as hi")
    return c.check_contained(load(spark, sf, "lineitem"), "lineitem", o, "l_orderkey", ("l_shipdate", "l_shipdate"), ("lo", "hi"), 6)


@query("c13_check_derived", res("derived", "lineitem", "price", "count(*) FILTER (abs(l_extendedprice - l_quantity * p_retailprice) > 1e-6)", "lineitem JOIN part ON l_partkey = p_partkey"))
def c13(spark, sf):
    df = load(spark, sf, "lineitem").join(load(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return c.check_derived(df, "lineitem", "price", F.col("l_extendedprice"), F.col("l_quantity") * F.col("p_retailprice"))


@query("c14_check_exactly_one", res("exactly_one", "orders", "o_orderkey", "count(*) FILTER (coalesce(n, 0) <> 1)", "orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_linenumber = 1 GROUP BY 1) ON o_orderkey = l_orderkey"))
def c14(spark, sf):
    return c.check_exactly_one(load(spark, sf, "orders"), "orders", ["o_orderkey"], load(spark, sf, "lineitem").where("l_linenumber = 1"), ["l_orderkey"])


@query("c15_dictionary_link", res("dictionary", "lineitem", "l_partkey", "count(*) FILTER (NOT coalesce(p_size > 5, false))", "(SELECT DISTINCT l_partkey FROM lineitem) LEFT JOIN part ON l_partkey = p_partkey"))
def c15(spark, sf):
    return c.check_dictionary_link(load(spark, sf, "lineitem"), "lineitem", "l_partkey", load(spark, sf, "part"), "p_partkey", F.col("p_size") > 5)


@query("c16_duplicates", res("duplicates", "events", "user_id,event_type,ts", "sum(n - 1)", "(SELECT count(*) AS n FROM events GROUP BY user_id, event_type, ts)", "sum(n)"))
def c16(spark, sf):
    return c.check_duplicates(load(spark, sf, "events"), "events", ["user_id", "event_type", "ts"])


@query("c17_shares", res("null_share", "customer", "bal", "count(*) FILTER (bal IS NULL)", HALF, status=GRADE.format(0.05, 0.5)) + " UNION ALL " + res("era_coverage", "orders", "era", "10 - count(DISTINCT year(o_orderdate))", "orders", "10") + " UNION ALL " + res("cap_share", "lineitem", "l_quantity", "count(*) FILTER (l_quantity >= 50)", "lineitem", status=GRADE.format(0.01, 0.05)))
def c17(spark, sf):
    half = load(spark, sf, "customer").withColumn("bal", F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")))
    era = c.check_era_coverage(load(spark, sf, "orders"), "orders", F.year("o_orderdate"), 10)
    cap = c.check_share(load(spark, sf, "lineitem"), "lineitem", "cap_share", "l_quantity", F.col("l_quantity") >= 50)
    return c.union([c.check_null_share(half, "customer", ["bal"]), era, cap])


@query("c18_unit_variants", """WITH n AS (SELECT event_type, CASE WHEN value < 60 THEN 'low' ELSE 'high' END AS unit, count(*) AS n FROM events GROUP BY 1, 2), s AS (SELECT *, n / sum(n) OVER (PARTITION BY event_type) AS sh FROM n)
SELECT event_type, unit, n, round(sh, 6) AS share, max(sh) OVER (PARTITION BY event_type) < 0.6 AS mixed FROM s""")
def c18(spark, sf):
    e = load(spark, sf, "events").withColumn("unit", F.when(F.col("value") < 60, "low").otherwise("high"))
    return c.unit_variants(e, "event_type", "unit", 0.6).withColumn("share", F.round("share", 6))


@query("c19_implausible_share", res("implausible", "events", "value", "count(*) FILTER (NOT value BETWEEN 5 AND 300)", "events", status=GRADE.format(0.01, 0.05)))
def c19(spark, sf):
    return c.check_implausible_share(load(spark, sf, "events"), "events", "value", 5, 300)


@query("c20_qc_report", f"""WITH x AS ({" UNION ALL ".join(_fk("fk", *x) for x in LINKS)} UNION ALL {res("unique", "lineitem", "l_orderkey,l_linenumber", "sum(n - 1)", _DUP, "sum(n)")})
SELECT "table", status, count(*) AS n_checks, sum(n_affected)::BIGINT AS n_affected FROM x GROUP BY 1, 2""")
def c20(spark, sf):
    return c.qc_report(c5(spark, sf).unionByName(c3(spark, sf)))


@query("c21_validate_all")
def c21(spark, sf):
    names = ["orders", "customer", "nation"]
    tables = {t: load(spark, sf, t) for t in names}
    specs = [TableSpec(t, tables[t].schema, (k,)) for t, k in zip(names, ("o_orderkey", "c_custkey", "n_nationkey"), strict=True)]
    semantic = [c.check_domain(tables["orders"], "orders", "price", F.col("o_totalprice") >= 0)]
    return c.validate_all(tables, specs, [c.Link("orders", ("o_custkey",), "customer", ("c_custkey",))], semantic)


@query("d1_profile_tables", "SELECT 'orders' AS \"table\", count(*) AS n_rows, 6 AS n_cols FROM orders UNION ALL SELECT 'events', count(*), 6 FROM events UNION ALL SELECT 'documents', count(*), 5 FROM documents")
def d1(spark, sf):
    return p.profile_tables({t: load(spark, sf, t) for t in ("orders", "events", "documents")})


def _prof(col, q, bounds="NULL, NULL"):
    quant = ", ".join(f"round(quantile_cont({col}, {x}), 4)" for x in (0.01, 0.5, 0.99)) if q else "NULL, NULL, NULL"
    return f"SELECT count(*) AS n_rows, '{col}' AS \"column\", count(*) FILTER ({col} IS NULL) AS n_null, count(DISTINCT {col}) AS n_distinct, {bounds}, {quant} FROM orders"


@query("d2_profile_columns", f"""SELECT n_rows, "column", n_null, n_distinct, c5 AS low, c6 AS high, p01, p50, p99 FROM ({_prof('o_orderkey', False)} UNION ALL {_prof('o_orderstatus', False, 'min(o_orderstatus), max(o_orderstatus)')}
UNION ALL {_prof('o_totalprice', True, 'min(o_totalprice)::VARCHAR, max(o_totalprice)::VARCHAR')}) AS t(n_rows, "column", n_null, n_distinct, c5, c6, p01, p50, p99)""")
def d2(spark, sf):
    out = p.profile_columns(load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), ("o_orderkey",), exact=True)
    return out.select("n_rows", "column", "n_null", "n_distinct", "low", "high", *[F.round(q, 4).alias(q) for q in ("p01", "p50", "p99")])


@query("d3_top_k", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 5")
def d3(spark, sf):
    return p.top_k(load(spark, sf, "part"), "p_brand", 5)


def _ext(col, band, kind):
    s = f"length({col}::VARCHAR)"
    return f"SELECT '{col}' AS \"column\", count(*) FILTER ({col} IS NULL) AS n_null, count(DISTINCT {col}) AS n_distinct, max({s})::INT AS max_length, round(avg({s}), 6) AS mean_length, {band} AS in_band, {kind} AND avg({s}) > 64 AS free_text, count(DISTINCT {col}) = count(*) AS candidate_key FROM documents"


@query("d4_profile_external", " UNION ALL ".join([_ext("doc_id", "count(*) FILTER (doc_id BETWEEN 100 AND 200) > 0", "false"), _ext("text", "false", "true"), _ext("lang", "false", "true"), _ext("n_chars", "count(*) FILTER (n_chars BETWEEN 100 AND 200) > 0", "false")]))
def d4(spark, sf):
    return p.profile_external(load(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars"), 100, 200).withColumn("mean_length", F.round("mean_length", 6))


@query("d5_item_dictionary", """WITH d AS (SELECT p_brand AS item, count(*) AS n, NULL::VARCHAR AS kind FROM part GROUP BY 1 UNION ALL SELECT DISTINCT event_type, NULL, 'event' FROM events)
SELECT d.item, n, kind, CASE WHEN d.item IN ('click', 'error') THEN 'u' END AS curated FROM d""")
def d5(spark, sf):
    brands = load(spark, sf, "part").groupBy(F.col("p_brand").alias("item")).agg(F.count("*").alias("n"))
    kinds = load(spark, sf, "events").select(F.col("event_type").alias("item"), F.lit("event").alias("kind")).distinct()
    return p.item_dictionary([brands, kinds], kinds.where("item in ('click', 'error')").select("item", F.lit("u").alias("curated")), "item")


@query("d6_feature_dictionary", """WITH f AS (SELECT c_custkey, avg(o_totalprice) AS mean_price, count(o_orderkey) AS n_orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1)
SELECT 'mean_price' AS name, 'orders' AS source, 'double' AS dtype, round(avg((mean_price IS NULL)::INT), 6) AS missing, round(quantile_cont(mean_price, 0.5), 2) AS p50 FROM f
UNION ALL SELECT 'n_orders', 'orders', 'bigint', round(avg((n_orders IS NULL)::INT), 6), round(quantile_cont(n_orders, 0.5), 2) FROM f""")
def d6(spark, sf):
    o = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.avg("o_totalprice").alias("mean_price"), F.count("*").alias("n_orders"))
    f = load(spark, sf, "customer").select("c_custkey").join(o, "c_custkey", "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))
    spec = spark.createDataFrame([("mean_price", "orders"), ("n_orders", "orders")], "name string, source string")
    d = p.feature_dictionary(persisted(f.select("mean_price", "n_orders"), "features"), spec)
    return d.select("name", "source", "dtype", F.round("missing", 6).alias("missing"), F.round("p50", 2).alias("p50"))
