"""Anchors, aligned events, bins, the events spine and marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.timesem import hours_since
from strandline.operators.disclosure import suppress
from strandline.operators.sums import quantiles_of, same_keys, with_quantiles
from strandline.sources.tables import persisted

SPINE = ["subject_id", "hadm_id", "time", "code", "numeric_value", "text_value", "source"]


def anchor(grain: DataFrame, key: str, events: DataFrame, time: str, which: str = "first") -> DataFrame:
    """One anchor time a grain key: the first or last event's; NULL without an event."""
    f = F.min if which == "first" else F.max
    return grain.select(key).distinct().join(events.groupBy(key).agg(f(time).alias("anchor")), key, "left")


def align(source: DataFrame, anchors: DataFrame, key: str, time: str, low: float, high: float, clip: tuple[str, str] | None = None) -> DataFrame:
    """Events with signed hours since the anchor in [low, high); with ``clip`` only those within the named columns of the anchors."""
    got = source.join(anchors, key).withColumn("hours_since_anchor", hours_since("anchor", time))
    got = got.where((F.col("hours_since_anchor") >= low) & (F.col("hours_since_anchor") < high))
    return got if clip is None else got.where((F.col(time) >= F.col(clip[0])) & (F.col(time) <= F.col(clip[1])))


def binned(aligned: DataFrame, keys: list[str], value: str, tiebreak: str, width: float = 1) -> DataFrame:
    """keys, bin, n, mean, low, high, last of each bin that has an event; last is by hours, then by the tiebreak."""
    b = F.floor(F.col("hours_since_anchor") / width).alias("bin")
    last = F.max_by(value, F.struct("hours_since_anchor", tiebreak)).alias("last")
    return aligned.groupBy(*keys, b).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high"), last)


def fill_bins(bins: DataFrame, keys: list[str], first: int, last: int) -> DataFrame:
    """Every bin from ``first`` to ``last`` of each key; empty ones have n 0 and NULLs."""
    grid = bins.select(*keys).distinct().withColumn("bin", F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long"))))
    return grid.join(bins, [*keys, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def population_summary(bins: DataFrame, unit: str, k: int = 11) -> DataFrame:
    """bin, n_units, n, mean of the units' means; small unit counts and their bins' values hidden."""
    s = bins.groupBy("bin").agg(F.countDistinct(unit).alias("n_units"), F.sum("n").alias("n"), F.avg("mean").alias("mean"))
    hidden = F.col("n_units").between(1, k - 1)
    return suppress(s.withColumn("n", F.when(~hidden, F.col("n"))).withColumn("mean", F.when(~hidden, F.col("mean"))), ["n_units"], k)


def event_source(df: DataFrame, name: str, subject: Column, hadm: Column, time: Column, code: list[Column], number: Column | None = None, text: Column | None = None) -> DataFrame:
    """A projection onto the spine's columns; the code is its parts joined by //."""
    none = lambda t: F.lit(None).cast(t)
    return df.select(
        subject.cast("long").alias("subject_id"), hadm.cast("long").alias("hadm_id"), time.alias("time"), F.concat_ws("//", *code).alias("code"),
        (none("double") if number is None else number.cast("double")).alias("numeric_value"), (none("string") if text is None else text).alias("text_value"), F.lit(name).alias("source"),
    )


def build_spine(sources: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, sources)


def spine_codes(spine: DataFrame) -> DataFrame:
    """prefix (the code's first part), n_events, n_subjects."""
    return spine.groupBy(F.substring_index("code", "//", 1).alias("prefix")).agg(F.count("*").alias("n_events"), F.countDistinct("subject_id").alias("n_subjects"))


def validate_spine(spine: DataFrame, subjects: DataFrame, longest: int = 64) -> DataFrame:
    """One row: missing times, unknown subjects, texts that are too long, codes without a prefix."""
    known = subjects.select(F.col(subjects.columns[0]).alias("subject_id")).distinct().withColumn("_k", F.lit(1))
    j = spine.join(known, "subject_id", "left")
    return j.agg(F.count_if(F.col("time").isNull()).alias("no_time"), F.count_if(F.col("_k").isNull()).alias("unknown_subject"), F.count_if(F.length("text_value") > longest).alias("long_text"), F.count_if(~F.col("code").contains("//")).alias("no_prefix"))


def first_day_mart(aligned: DataFrame, keys: list[str], item: str, value: str, items: list[str]) -> DataFrame:
    """One row a key: low, high and mean of each item within the aligned window, by conditional aggregates in one pass."""
    aggs = []
    for i in items:
        v = F.when(F.col(item) == i, F.col(value))
        aggs += [F.min(v).alias(f"{i}_low"), F.max(v).alias(f"{i}_high"), F.avg(v).alias(f"{i}_mean")]
    return aligned.groupBy(*keys).agg(F.count("*").alias("n"), *aggs)


def item_bins(aligned: DataFrame, keys: list[str], item: str, value: str, tiebreak: str, low: float, high: float, width: float = 24) -> DataFrame:
    """keys, item, bin, n, low, high, mean, first, last of plausible values, and n_implausible, which count for nothing else."""
    ok = F.col(value).between(low, high)
    v = F.when(ok, F.col(value))
    at = F.when(ok, F.struct("hours_since_anchor", tiebreak))
    b = F.floor(F.col("hours_since_anchor") / width).alias("bin")
    return aligned.groupBy(*keys, item, b).agg(F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean"), F.min_by(v, at).alias("first"), F.max_by(v, at).alias("last"), F.count_if(~ok).alias("n_implausible"))


def item_summary(df: DataFrame, item: str, value: str, unit: str, n_units: int) -> DataFrame:
    """item, n, n_units, share of units measured, p01, p50, p99 (exact)."""
    s = df.groupBy(item).agg(F.count("*").alias("n"), F.countDistinct(unit).alias("n_units"))
    s = with_quantiles(s, df, value, [0.01, 0.5, 0.99], [item], "p")
    return s.select(item, "n", "n_units", (F.col("n_units") / n_units).alias("share"), F.col("p")[0].alias("p01"), F.col("p")[1].alias("p50"), F.col("p")[2].alias("p99"))


def hourly_mart(bins: DataFrame, keys: list[str], item: str, items: list[str], cap: int) -> DataFrame:
    """One row a key and bin under ``cap``: n, mean, low, high, last of each item, by a pivot with a declared list."""
    p = bins.where((F.col("bin") >= 0) & (F.col("bin") < cap)).groupBy(*keys, "bin").pivot(item, items)
    return p.agg(*[F.max(c).alias(c) for c in ("n", "mean", "low", "high", "last")])


def hourly_population(df: DataFrame, hour: str, item: str, era: str, value: str) -> DataFrame:
    """Per hour, item and era, and over all eras (era 'all'): n, mean, p05, p50, p95 (exact)."""
    keys = [hour, item, "era"]
    one = df.select(hour, item, F.col(era).cast("string").alias("era"), F.col(value).cast("double").alias("_v")).groupBy(*keys, "_v").agg(F.count("*").alias("_n"))
    both = one.unionByName(one.groupBy(hour, item, "_v").agg(F.sum("_n").alias("_n")).withColumn("era", F.lit("all")))  # all eras, from the counts of each
    both = persisted(both, "values")
    s = both.groupBy(*keys).agg(F.sum(F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(0)).alias("n"), F.try_divide(F.sum(F.col("_v") * F.col("_n")), F.sum(F.when(F.col("_v").isNotNull(), F.col("_n")))).alias("mean"))
    q = quantiles_of(both.where("_v is not null"), [0.05, 0.5, 0.95], keys).withColumnRenamed("q", "p")
    s = s.join(q, same_keys(s, q, keys), "left").select(s["*"], q["p"])
    return s.select(hour, item, "era", "n", "mean", F.col("p")[0].alias("p05"), F.col("p")[1].alias("p50"), F.col("p")[2].alias("p95"))


def last_known(df: DataFrame, by: list[str], at: str, value: str, most: int) -> Column:
    """The last value not NULL within ``most`` units of the integer column ``at``."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*by).orderBy(at).rangeBetween(-most, 0))
