"""Small-cell disclosure control."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.sources.tables import persisted

K = 11


def small(n: Column, k: int = K) -> Column:
    """Counts from 1 to k - 1; zero is not small."""
    return (n > 0) & (n < k)


def suppress(df: DataFrame, counts: list[str], k: int = K) -> DataFrame:
    """Small counts become NULL; <count>_suppressed tells."""
    for c in counts:
        df = df.withColumn(f"{c}_suppressed", F.coalesce(small(F.col(c), k), F.lit(False))).withColumn(c, F.when(~small(F.col(c), k), F.col(c)))
    return df


def suppress_complementary(df: DataFrame, row: str, col: str, n: str, k: int = K, rounds: int = 100) -> DataFrame:
    """Hides small cells of a table with margins; while a row or column has exactly one hidden cell, the next smallest of that margin is hidden too, to a fixpoint.

    Rounds run on the aggregated table; one that doesn't settle in ``rounds`` raises.
    """
    now = persisted(df.withColumn("_hidden", F.coalesce(small(F.col(n), k), F.lit(False))), "cells")
    for _ in range(rounds):
        step = now
        for margin in (row, col):
            w = Window.partitionBy(margin)
            other = col if margin == row else row
            shown = F.when(~F.col("_hidden") & (F.col(n) > 0), F.struct(F.col(n).alias("n"), F.col(other).alias("o")))
            alone = F.count_if(F.col("_hidden")).over(w) == 1
            step = step.withColumn("_pick", alone & (shown == F.min(shown).over(w))).withColumn("_hidden", F.col("_hidden") | F.coalesce("_pick", F.lit(False))).drop("_pick")
        after = persisted(step, "cells")
        if after.agg(F.count_if("_hidden")).first()[0] == now.agg(F.count_if("_hidden")).first()[0]:
            return after.withColumn(f"{n}_suppressed", F.col("_hidden")).withColumn(n, F.when(~F.col("_hidden"), F.col(n))).drop("_hidden")
        now = after
    raise RuntimeError("suppression did not settle")


def suppress_chain(attrition: DataFrame, step: str, n: str, k: int = K) -> DataFrame:
    """Adds dropped (from the step before) and shown: where a drop is small it is hidden and both counts beside it are rounded to 10 and marked ~."""
    w = Window.orderBy(step)
    d = attrition.withColumn("dropped", F.lag(n).over(w) - F.col(n))
    hide = F.coalesce(small(F.col("dropped"), k), F.lit(False))
    d = d.withColumn("_h", hide).withColumn("_near", F.col("_h") | F.coalesce(F.lead("_h").over(w), F.lit(False)))
    shown = F.when(F.col("_near"), F.concat(F.lit("~"), (F.round(F.col(n) / 10) * 10).cast("long").cast("string"))).otherwise(F.col(n).cast("string"))
    return d.select(step, shown.alias("shown"), F.when(~F.col("_h"), F.col("dropped")).alias("dropped"))


def drop_small_rows(df: DataFrame, n: str, k: int = K) -> tuple[DataFrame, DataFrame]:
    """(rows without small ones, one row with rows_suppressed)."""
    return df.where(~small(F.col(n), k)), df.agg(F.count_if(small(F.col(n), k)).alias("rows_suppressed"))


def scan_output(df: DataFrame, low: int, high: int, identifiers: tuple[str, ...], most_rows: int = 10_000, long_text: int = 64, k: int = K) -> DataFrame:
    """finding, column, n: identifier columns, values within the protected band, long texts, small counts in columns named n or n_*, too many rows."""
    out = [F.struct(F.lit("too_many_rows").alias("finding"), F.lit("*").alias("column"), F.when(F.count(F.lit(1)) > most_rows, F.count(F.lit(1))).otherwise(0).alias("n"))]
    for c, kind in df.dtypes:
        tests = [("identifier", F.count(F.lit(1)) if c in identifiers else None), ("id_band", F.count_if(F.col(c).between(low, high)) if kind in ("int", "bigint") else None)]
        tests += [("long_text", F.count_if(F.length(c) > long_text) if kind == "string" else None), ("small_count", F.count_if(small(F.col(c), k)) if c == "n" or c.startswith("n_") else None)]
        out += [F.struct(F.lit(t).alias("finding"), F.lit(c).alias("column"), n.alias("n")) for t, n in tests if n is not None]
    one = df.agg(*[s.alias(f"f{i}") for i, s in enumerate(out)])
    return one.select(F.explode(F.array(*[f"f{i}" for i in range(len(out))])).alias("x")).select("x.*").where("n > 0")


def safe_aggregate(df: DataFrame, keys: list[str], aggs: dict[str, tuple[str, str]], identifiers: tuple[str, ...], k: int = K, most_rows: int = 1000) -> DataFrame:
    """Aggregates by ``keys`` with the mandatory count n; small rows left out; over ``most_rows`` rows raise. Identifiers may only be counted, and can't be keys."""
    known = {"count": F.count, "count_distinct": F.countDistinct, "mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max}
    for name, (f, c) in aggs.items():
        if f not in known or c not in df.columns:
            raise ValueError(f"{name}: {f}({c}) is not allowed")
        if c in identifiers and f not in ("count", "count_distinct"):
            raise ValueError(f"{name}: {c} identifies subjects and may only be counted")
    if bad := [c for c in keys if c in identifiers or c not in df.columns]:
        raise ValueError(f"keys {bad} are not allowed")
    out = df.groupBy(*keys).agg(F.count("*").alias("n"), *[known[f](c).alias(name) for name, (f, c) in aggs.items()])
    found = persisted(out.where(F.col("n") >= k), "safe-aggregate")
    if found.limit(most_rows + 1).count() > most_rows:
        raise ValueError(f"over {most_rows} rows: use fewer or coarser keys")
    return found.orderBy(*keys)


def filter_vocabulary(docs: DataFrame, doc: str, subject: str, text: str, least_docs: int = K, least_subjects: int = K) -> DataFrame:
    """term, n_docs, n_subjects of terms in at least so many texts of so many subjects; no blanked-out terms, no numbers of five or more digits.

    A text's terms are distinct where it lies, so texts with one row are counted by term and subject before anything is shuffled; only those with several rows are told apart by their terms."""
    several = persisted(docs.where(F.col(doc).isNotNull()).groupBy(doc).agg(F.count("*").alias("_n")).where("_n > 1").select(F.col(doc).alias("_d")), "several")
    ok = (F.col("term") != "") & ~F.col("term").rlike(r"^_+$") & ~F.col("term").rlike(r"^\d{5,}$")
    rows = docs.select(F.col(doc).alias("_d"), F.col(subject).alias("_s"), F.col(text).alias("_t"))
    terms = lambda d: d.select("_d", "_s", F.explode(F.array_distinct(F.split(F.lower("_t"), r"[^\p{L}\p{N}_]+"))).alias("term")).where(ok)
    pairs = lambda d: terms(d).groupBy("term", "_s").agg(F.count("_d").alias("n"))
    found = pairs(rows)
    if several.limit(1).count():
        again = terms(rows.join(several, "_d", "left_semi"))
        subjects = again.select("term", "_s").distinct().withColumn("n", F.lit(0).cast("long"))
        rest = again.groupBy("term").agg(F.countDistinct("_d").alias("n")).select("term", F.lit(None).cast(docs.schema[subject].dataType).alias("_s"), "n")
        found = pairs(rows.join(several, "_d", "left_anti")).unionByName(subjects).groupBy("term", "_s").agg(F.sum("n").alias("n")).unionByName(rest)
    found = found.groupBy("term").agg(F.sum("n").alias("n_docs"), F.count("_s").alias("n_subjects"))
    return found.where((F.col("n_docs") >= least_docs) & (F.col("n_subjects") >= least_subjects))
