"""Profiles of tables and columns, top values, dictionaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.operators.sums import dealt, quantiles_of
from strandline.sources.tables import persisted

NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """table, n_rows, n_cols."""
    each = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).alias("n_cols")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, each)


def table_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """table, n_files, bytes of the files under each path, from their listing: no content is read."""
    each = [spark.read.format("binaryFile").option("recursiveFileLookup", True).load(at).agg(F.count("path").alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).select(F.lit(name).alias("table"), "n_files", "bytes") for name, at in paths.items()]
    return reduce(DataFrame.unionByName, each)


def profile_columns(df: DataFrame, identifiers: tuple[str, ...] = (), exact: bool = False) -> DataFrame:
    """column, n_null, n_distinct, low, high, p01, p50, p99; no bounds and quantiles of identifiers. One aggregate over the table; ``exact`` counts distinct values column by column and reads quantiles off at running counts of values, so that no buffer holds a column's values."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    kinds = dict(df.dtypes)
    shown = [c for c in df.columns if kinds[c] in NUMBERS and c not in identifiers]
    if exact and len(df.columns) > 8:
        df = persisted(df, "profile")  # it is read once a column
    for k, c in enumerate(df.columns):
        text = kinds[c] in ("string", "timestamp_ntz", "timestamp", "date") and c not in identifiers
        bound = (lambda f: f(c).cast("string")) if c in shown or text else (lambda f: F.lit(None).cast("string"))  # noqa: B023
        n = F.lit(None).cast("long") if exact else F.approx_count_distinct(c)
        p = [F.percentile_approx(c, q).cast("double") if c in shown and not exact else F.lit(None).cast("double") for q in (0.01, 0.5, 0.99)]
        aggs.append(F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("n_null"), n.alias("n_distinct"), bound(F.min).alias("low"), bound(F.max).alias("high"), p[0].alias("p01"), p[1].alias("p50"), p[2].alias("p99")).alias(f"c{k}"))
    told = df.agg(*aggs).select("n_rows", F.explode(F.array(*[f"c{k}" for k in range(len(df.columns))])).alias("x")).select("n_rows", "x.*")
    if not exact:
        return told
    rows = df.count()
    several = [dealt(df.select(c).where(F.col(c).isNotNull()), rows, c).distinct().agg(F.count("*").alias("n_distinct")).select(F.lit(c).alias("column"), "n_distinct") for c in df.columns]
    known = told.drop("n_distinct", "p01", "p50", "p99").join(F.broadcast(reduce(DataFrame.unionByName, several)), "column")
    if shown:
        each = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_v")) for c in shown])).alias("x")).select("x.*").where("_v is not null")
        counts = dealt(each, rows * len(shown), "column", "_v").groupBy("column", "_v").agg(F.count("*").alias("_n"))
        known = known.join(F.broadcast(quantiles_of(counts, [0.01, 0.5, 0.99], ["column"])), "column", "left")
    else:
        known = known.withColumn("q", F.lit(None).cast("array<double>"))
    return known.select("n_rows", "column", "n_null", "n_distinct", "low", "high", *[F.col("q")[k].alias(c) for k, c in enumerate(("p01", "p50", "p99"))])


def top_k(df: DataFrame, col: str, k: int) -> DataFrame:
    """The k most frequent values, ties to the smaller."""
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.col(col)).limit(k)


def distinct_counts(df: DataFrame) -> DataFrame:
    """k, n_distinct: different known values of the k-th column, told apart by 64-bit hashes of type and value. Hashes are made distinct where the rows are, so neither whole texts nor rows times columns are shuffled."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias("h")) for k, c in enumerate(df.columns)])).alias("x")
    return df.select(each).select("x.*").where("h is not null").distinct().groupBy("k").agg(F.count("*").alias("n_distinct"))


def level_counts(df: DataFrame, most: int = 50, top: int = 10) -> DataFrame:
    """column, level, n, rank: the ``top`` most frequent values (as text, ties to the smaller) of each column with at most ``most`` known values; a column with more has no rows. Nulls are no level.

    Columns are chosen by their distinct counts, one number a column; the second pass counts at most ``most`` levels a column before anything is shuffled."""
    few = sorted(r["k"] for r in distinct_counts(df).where(F.col("n_distinct") <= most).collect())
    if not few:
        return df.select(F.lit("").alias("column"), F.lit("").alias("level"), F.lit(0).cast("long").alias("n"), F.lit(0).alias("rank")).where("false")
    pairs = F.explode(F.array(*[F.struct(F.lit(df.columns[k]).alias("column"), F.col(df.columns[k]).cast("string").alias("level")) for k in few])).alias("x")
    counted = df.select(pairs).select("x.*").where("level is not null").groupBy("column", "level").agg(F.count("*").alias("n"))
    return counted.withColumn("rank", F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "level"))).where(F.col("rank") <= top)


def profile_external(df: DataFrame, low: int, high: int, long_text: int = 64) -> DataFrame:
    """column, n_null, n_distinct, max_length, mean_length, in_band, free_text, candidate_key of every column of a source not known yet."""
    aggs = []
    for k, (c, kind) in enumerate(df.dtypes):
        size = F.length(F.col(c).cast("string"))
        band = F.count_if(F.col(c).between(low, high)) if kind in ("int", "bigint", "smallint") else F.lit(0)
        aggs.append(F.struct(F.lit(k).alias("k"), F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("n_null"), F.count(F.lit(1)).alias("n"), F.max(size).alias("max_length"), F.avg(size).alias("mean_length"), (band > 0).alias("in_band"), (F.lit(kind == "string") & (F.avg(size) > long_text)).alias("free_text")).alias(f"c{k}"))
    told = df.agg(*aggs).select(F.explode(F.array(*[f"c{k}" for k in range(len(df.columns))])).alias("x")).select("x.*")
    d = told.join(distinct_counts(df), "k", "left").withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))
    return d.select("column", "n_null", "n_distinct", "max_length", "mean_length", "in_band", "free_text", (F.col("n_distinct") == F.col("n")).alias("candidate_key"))


def item_dictionary(dictionaries: list[DataFrame], curated: DataFrame, key: str) -> DataFrame:
    """Union of dictionaries (columns one lacks are NULL) with curation columns where there are any."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dictionaries)
    return every.join(curated, key, "left")


def feature_dictionary(features: DataFrame, spec: DataFrame) -> DataFrame:
    """The features' spec (name, source, window) with type, share missing and quantiles."""
    p = profile_columns(features, exact=True)
    kinds = features.sparkSession.createDataFrame(features.dtypes, "column string, dtype string")
    got = p.join(F.broadcast(kinds), "column").select(F.col("column").alias("name"), "dtype", (F.col("n_null") / F.col("n_rows")).alias("missing"), "p01", "p50", "p99")
    return spec.join(got, "name", "left")
