"""Linking external sources: key validation, coverage, keys inferred by time, reference coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.checks import check_fk, check_not_null, check_unique, graded
from strandline.operators.joins import interval_join
from strandline.operators.sums import prefix_sums


def validate_keys(source: DataFrame, name: str, key: str, core: DataFrame, core_key: str, warn: float = 0.001, fail: float = 0.05) -> DataFrame:
    """Uniqueness, NULLs and orphans of the source's key, graded by share."""
    rows = check_unique(source, name, [key]).unionByName(check_not_null(source, name, [key])).unionByName(check_fk(source, name, [key], core, [core_key]))
    return rows.withColumn("status", graded(F.try_divide(F.col("n_affected"), F.col("n_total")), warn, fail))


def coverage(source: DataFrame, core: DataFrame, key: str, era: str) -> DataFrame:
    """era, n_core, n_covered, share of core rows with a source row."""
    has = source.select(key).distinct().withColumn("_h", F.lit(1))
    s = core.join(has, key, "left").groupBy(era).agg(F.count("*").alias("n_core"), F.count("_h").alias("n_covered"))
    return s.withColumn("share", F.col("n_covered") / F.col("n_core"))


def infer_key_by_time(events: DataFrame, stays: DataFrame, by: str, time: str, start: str, end: str, stay: str) -> DataFrame:
    """Events with the stay that holds them, the earliest of several."""
    return interval_join(events, stays, [by], time, start, end, stay)


def match_counts(events: DataFrame, stays: DataFrame, by: str, time: str, start: str, end: str) -> DataFrame:
    """n_stays, n: how many events lie in so many stays [start, end) of their key. No event meets a stay: the stays open at a time are those begun less those ended, by running counts of the key, so overlapping stays make no pairs. Null keys and times lie in none."""
    edge = lambda df, at, kind, up: df.where(F.col(by).isNotNull()).select(F.col(by).alias("_k"), F.col(at).alias("_t"), F.lit(kind).alias("_kind"), F.lit(up).alias("_up"))
    real = stays.where(F.col(start) < F.col(end))
    each = edge(real, end, 0, -1).unionByName(edge(real, start, 1, 1)).unionByName(edge(events.where(F.col(time).isNotNull()), time, 2, 0))
    counted = each.groupBy("_k", "_t", "_kind").agg(F.sum("_up").alias("_up"), F.count("*").alias("_n"))
    open_ = prefix_sums(counted, ["_t", "_kind"], ["_up"], keys=["_k"]).where("_kind = 2")
    told = open_.groupBy(F.col("cum__up").alias("n_stays")).agg(F.sum("_n").alias("n"))
    lost = events.where(F.col(by).isNull() | F.col(time).isNull()).agg(F.lit(0).cast("long").alias("n_stays"), F.count("*").alias("n"))
    return told.unionByName(lost).groupBy("n_stays").agg(F.sum("n").alias("n")).where("n > 0")


def reference_coverage(dictionary: DataFrame, reference: DataFrame, events: DataFrame, code: str) -> DataFrame:
    """One row: shares of the dictionary's codes and of event rows that the reference maps."""
    r = reference.select(code).distinct().withColumn("_m", F.lit(1))
    d = dictionary.select(code).distinct().join(r, code, "left").agg((F.count("_m") / F.count("*")).alias("dictionary_share"))
    e = events.groupBy(code).agg(F.count("*").alias("n")).join(r, code, "left").agg((F.sum(F.when(F.col("_m") == 1, F.col("n")).otherwise(0)) / F.sum("n")).alias("event_share"))
    return d.crossJoin(e)  # one row each


def source_coverage(source: DataFrame, key: str, subject: str, core: DataFrame) -> DataFrame:
    """One row: n_rows, rows_linked, n_subjects, subjects_linked and the two shares: the source's rows whose key the core has (``core`` has ``key``), and its subjects with such a row. A null key isn't linked; shares of nothing are null."""
    has = core.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_h", F.lit(1))
    n = source.groupBy(subject, key).agg(F.count("*").alias("_n"))  # a hot key is one row before it meets the core
    s = n.join(has, key, "left").groupBy(subject).agg(F.sum("_n").alias("_n"), F.sum(F.when(F.col("_h") == 1, F.col("_n")).otherwise(0)).alias("_l"))
    t = s.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("_l"), F.lit(0)).alias("rows_linked"), F.count(subject).alias("n_subjects"), F.count_if((F.col("_l") > 0) & F.col(subject).isNotNull()).alias("subjects_linked"))
    return t.withColumn("row_share", F.try_divide("rows_linked", "n_rows")).withColumn("subject_share", F.try_divide("subjects_linked", "n_subjects"))


def temporal_consistency(source: DataFrame, key: str, time: str, core: DataFrame, start: str, end: str, era: str, slack_hours: float = 24) -> DataFrame:
    """era, n_linked, n_inside, share: linked source rows whose time lies in [start - slack, end + slack] of the core row of their key. ``core`` has one row a key; a row without time isn't inside."""
    slack = F.lit(int(slack_hours * 3600e6))
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    j = source.select(key, us(time).alias("_t")).join(core.select(key, us(start).alias("_a"), us(end).alias("_z"), F.col(era).alias("era")), key)
    inside = F.coalesce(F.col("_t").between(F.col("_a") - slack, F.col("_z") + slack), F.lit(False))
    return j.groupBy("era").agg(F.count("*").alias("n_linked"), F.count_if(inside).alias("n_inside")).withColumn("share", F.col("n_inside") / F.col("n_linked"))


def triage(df: DataFrame, keep: list[str], acuity: str, vitals: dict[str, tuple[float, float, float, float]]) -> DataFrame:
    """keep, acuity, each vital and implausible: acuity as an ordinal 1 to 5, else null; a vital (factor, shift, low, high) is harmonised and, outside its bounds, null. implausible: how many known vitals lay outside."""
    level = F.col(acuity).try_cast("int")
    made = {v: F.col(v).try_cast("double") * f + s for v, (f, s, _, _) in vitals.items()}
    fits = {v: made[v].between(lo, hi) for v, (_, _, lo, hi) in vitals.items()}
    out = sum((F.when(~F.coalesce(fits[v], F.lit(True)), 1).otherwise(0) for v in vitals), F.lit(0))
    return df.select(*keep, F.when(level.between(1, 5), level).alias("acuity"), *[F.when(fits[v], made[v]).alias(v) for v in vitals], out.alias("implausible"))


def normalized_drug(name: Column) -> Column:
    """Lower case, words of letters alone, one space between: doses, units behind a number and marks go."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(name), r"[0-9][0-9.,]*\s*(mg|mcg|g|ml|units?|%)?(?![a-z])", " "), r"[^a-z]+", " "))


def drug_flags(stays: DataFrame, stay: str, start: str, meds: DataFrame, time: str, name: str, drugs: list[str]) -> DataFrame:
    """stay, n_meds, n_flagged, first_flagged_hours for each stay: medications, those whose normalised name holds a drug of the list (whole words in a row, thousands of drugs at most), and hours from the stay's start to the first such (null if none or untimed).

    Distinct names, not rows, meet the list, by an equi-join on their runs of words; medications are folded to a row a stay before they meet the stays. A null name is a medication that isn't flagged; a repeated stay gives its row again."""
    listed = sorted({" ".join(d.lower().split()) for d in drugs} - {""})
    words = meds.sparkSession.createDataFrame([(d,) for d in listed], "_g string")
    names = meds.select(F.col(name).alias("_d")).where(F.col(name).isNotNull()).distinct().withColumn("_w", F.split(normalized_drug(F.col("_d")), " "))
    run = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.size("_w") - n + 1, F.lit(1))), lambda at: F.array_join(F.slice("_w", at, n), " "))
    runs = [run(n) for n in sorted({len(d.split()) for d in listed} or {1})]
    hit = names.select("_d", F.explode(F.flatten(F.array(*runs))).alias("_g")).join(F.broadcast(words), "_g", "left_semi").select("_d").distinct().withColumn("_f", F.lit(1))
    m = meds.select(stay, time, F.col(name).alias("_d")).join(hit, "_d", "left").groupBy(stay).agg(F.count("*").alias("n_meds"), F.count("_f").alias("n_flagged"), F.min(F.when(F.col("_f") == 1, F.col(time))).alias("_at"))
    hours = (F.unix_micros(F.col("_at").cast("timestamp")) - F.unix_micros(F.col(start).cast("timestamp"))) / 3600e6
    return stays.select(stay, start).join(m, stay, "left").select(stay, F.coalesce("n_meds", F.lit(0)).alias("n_meds"), F.coalesce("n_flagged", F.lit(0)).alias("n_flagged"), hours.alias("first_flagged_hours"))
