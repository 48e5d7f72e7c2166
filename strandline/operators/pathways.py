"""Endpoints, utilisation, pathways, exposure and series on per-unit time lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.timesem import seconds
from strandline.operators.sums import lookup, prefix_sums, with_quantiles
from strandline.sources.tables import persisted


def repeats_within(subject: str, time: str, days: int) -> Column:
    """Number of the subject's later rows within the days after the row's time; rows of equal time don't count."""
    w = Window.partitionBy(subject).orderBy(F.unix_micros(F.col(time).cast("timestamp"))).rangeBetween(1, days * 86400 * 1_000_000)
    return F.count("*").over(w)


def endpoint_ordinal(x: Column, order: list[str]) -> Column:
    """Position in the order from 0; unmapped levels are missing."""
    out = F.lit(None).cast("int")
    for k, v in enumerate(order):
        out = F.when(x == v, k).otherwise(out)
    return out


def length_of_stay(start: str, end: str) -> Column:
    """Days; a length of zero or less is missing."""
    d = (seconds(end) - seconds(start)) / 86400
    return F.when(d > 0, d)


def time_to_event(origin: str, event: str, competing: str, censor: Column, cap_days: float) -> tuple[Column, Column]:
    """(days, code): 1 event, 2 competing event, 0 censored, by whichever is first; the event wins a tie."""
    t = lambda c: (seconds(c) - seconds(origin)) / 86400
    end = F.least(censor, F.lit(cap_days))
    days = F.least(F.coalesce(t(event), end), F.coalesce(t(competing), end), end)
    code = F.when(t(event) <= days, 1).when(t(competing) <= days, 2).otherwise(0)
    return days, code


def readmissions(df: DataFrame, subject: str, start: str, end: str, tiebreak: str, days: int) -> DataFrame:
    """Adds days_to_next (from this encounter's end to the next one's start) and readmitted within the days; overlapping encounters are not readmissions."""
    w = Window.partitionBy(subject).orderBy(start, tiebreak)
    gap = (F.lead(seconds(start)).over(w) - seconds(end)) / 86400
    return df.withColumn("days_to_next", gap).withColumn("readmitted", F.coalesce(F.col("days_to_next").between(0, days), F.lit(False)))


def utilization_rates(df: DataFrame, by: list[str], subject: str, person_days: str, bed_days: str) -> DataFrame:
    s = df.groupBy(*by).agg(F.count("*").alias("n"), F.countDistinct(subject).alias("n_subjects"), F.sum(person_days).alias("_p"), F.sum(bed_days).alias("_b"))
    return s.select(*by, "n", "n_subjects", F.try_divide(100 * F.col("n"), F.col("_p") / 365.25).alias("per_100_years"), F.try_divide(1000 * F.col("n"), F.col("_b")).alias("per_1000_bed_days"))


def sequences(df: DataFrame, subject: str, time: str, tiebreak: str, unit: str, collapse: bool = True, most: int = 20) -> DataFrame:
    """subject, path (the first ``most`` units in order, runs of one unit collapsed), n_steps before the cut."""
    w = Window.partitionBy(subject).orderBy(time, tiebreak)
    rows = df.withColumn("_p", F.lag(unit).over(w)).where(F.col("_p").isNull() | (F.col("_p") != F.col(unit))) if collapse else df
    ranked = rows.withColumn("_r", F.row_number().over(w)).groupBy(subject).agg(F.count("*").alias("n_steps"), F.array_sort(F.collect_list(F.when(F.col("_r") <= most, F.struct("_r", unit)))).alias("_l"))
    return ranked.select(subject, F.transform("_l", lambda x: x[unit]).alias("path"), "n_steps")


def top_pathways(paths: DataFrame, k: int, least: int = 1) -> DataFrame:
    return paths.groupBy(F.concat_ws(">", "path").alias("pathway")).agg(F.count("*").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "pathway").limit(k)


def transition_matrix(df: DataFrame, subject: str, time: str, tiebreak: str, unit: str) -> DataFrame:
    """state, following, n, share of the state's transitions."""
    t = df.select(F.col(unit).alias("state"), F.lead(unit).over(Window.partitionBy(subject).orderBy(time, tiebreak)).alias("following")).where("following is not null")
    n = t.groupBy("state", "following").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("state")))


def first_after(df: DataFrame, subject: str, time: str, a: Column, b: Column) -> DataFrame:
    """subject, hours from the first a to the first b after it; NULL where there is none."""
    first = df.where(a).groupBy(subject).agg(F.min(time).alias("_a"))
    later = df.where(b).join(first, subject).where(F.col(time) > F.col("_a")).groupBy(subject).agg(F.min(time).alias("_b"))
    return first.join(later, subject, "left").select(subject, ((seconds("_b") - seconds("_a")) / 3600).alias("hours"))


def delay_summary(delays: DataFrame, by: list[str]) -> DataFrame:
    s = with_quantiles(delays.groupBy(*by).agg(F.count("*").alias("n"), F.count("hours").alias("n_reached")), delays, "hours", [0.25, 0.5, 0.75], by)
    return s.select(*by, "n", "n_reached", F.col("q")[1].alias("median"), (F.col("q")[2] - F.col("q")[0]).alias("iqr"))


def loops(paths: DataFrame) -> DataFrame:
    """Adds n_returns: steps to a unit already visited."""
    return paths.withColumn("n_returns", F.size("path") - F.size(F.array_distinct("path")))


def dose_summary(df: DataFrame, by: list[str], rate: str, start: str, end: str) -> DataFrame:
    """by, highest rate, time-weighted mean rate, cumulative dose (rate times hours)."""
    h = (seconds(end) - seconds(start)) / 3600
    return df.groupBy(*by).agg(F.max(rate).alias("highest"), F.try_divide(F.sum(F.col(rate) * h), F.sum(h)).alias("weighted_mean"), F.sum(F.col(rate) * h).alias("cumulative"))


def exposure_order(df: DataFrame, subject: str, time: str, tiebreak: str, agent: str) -> DataFrame:
    """subject, first_agent, second_agent: the first two different agents by first use."""
    f = df.groupBy(subject, agent).agg(F.min(F.struct(time, tiebreak)).alias("_t"))
    r = f.withColumn("_r", F.row_number().over(Window.partitionBy(subject).orderBy("_t")))
    return r.groupBy(subject).agg(F.max(F.when(F.col("_r") == 1, F.col(agent))).alias("first_agent"), F.max(F.when(F.col("_r") == 2, F.col(agent))).alias("second_agent"))


def trajectory_features(df: DataFrame, by: str, time: str, tiebreak: str, value: str, threshold: float) -> DataFrame:
    """by, n, slope per hour (least squares), sd, cv, rmssd, crossings of the threshold, hours to the first value at or below it, trapezoid area, peak and its hour, values a day."""
    w = Window.partitionBy(by).orderBy(time, tiebreak)
    h = (seconds(time) - F.min(seconds(time)).over(Window.partitionBy(by))) / 3600
    d = df.withColumn("_h", h).withColumn("_pv", F.lag(value).over(w)).withColumn("_ph", F.lag("_h").over(w))
    v, hours = F.col(value), F.col("_h")
    step = v - F.col("_pv")
    crossed = (v > threshold) != (F.col("_pv") > threshold)
    peak = F.max_by("_h", F.struct(v, -hours))
    return d.groupBy(by).agg(
        F.count("*").alias("n"), F.regr_slope(v, hours).alias("slope"), F.stddev_samp(v).alias("sd"), F.try_divide(F.stddev_samp(v), F.avg(v)).alias("cv"), F.sqrt(F.avg(step * step)).alias("rmssd"), F.count_if(crossed).alias("crossings"),
        F.min(F.when(v <= threshold, hours)).alias("hours_to_normal"), F.sum((hours - F.col("_ph")) * (v + F.col("_pv")) / 2).alias("auc"), F.max(v).alias("peak"), peak.alias("peak_hour"), F.try_divide(F.count("*"), F.max(hours) / 24).alias("per_day"),
    )


def cumulative(by: str, time: str, tiebreak: str, x: Column) -> Column:
    return F.sum(x).over(Window.partitionBy(by).orderBy(time, tiebreak).rowsBetween(Window.unboundedPreceding, 0))


def fill_series(grid: DataFrame, by: list[str], at: str, value: str, policy: str, most: int = 10**9) -> DataFrame:
    """Adds filled: none; ffill from at most ``most`` bins back; linear between the neighbours on both sides."""
    w = Window.partitionBy(*by).orderBy(at)
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    point = F.when(F.col(value).isNotNull(), F.struct(F.col(at).alias("t"), F.col(value).alias("v")))
    p, n = F.last(point, ignorenulls=True).over(back), F.first(point, ignorenulls=True).over(ahead)
    if policy == "none":
        return grid.withColumn("filled", F.col(value))
    d = grid.withColumn("_p", p).withColumn("_n", n)
    if policy == "ffill":
        out = F.when(F.col(at) - F.col("_p.t") <= most, F.col("_p.v"))
    else:
        out = F.when(F.col("_p.t") == F.col("_n.t"), F.col("_p.v")).otherwise(F.col("_p.v") + F.try_divide((F.col("_n.v") - F.col("_p.v")) * (F.col(at) - F.col("_p.t")), F.col("_n.t") - F.col("_p.t")))
    return d.withColumn("filled", out).drop("_p", "_n")


def rolling_mean(by: list[str], order: list[str], value: str, n: int) -> Column:
    """Mean of the row and the n - 1 before it."""
    return F.avg(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(1 - n, 0))


def ewma(df: DataFrame, by: str, order: list[str], value: str, alpha: float) -> DataFrame:
    """by, n, last_ewma: rows, and the exponentially weighted mean after each series' last known value; NULL values are passed over.

    Series are cut into ranges of key and order. A range is folded to one row: its weighted sum, and by how much it fades what came before; these rows, one a range and series, fold alike.
    """
    series, fade = Window.partitionBy(by), 1 - alpha
    v = F.col(value).cast("double")
    ranges = persisted(df.select(by, *order, v.alias("_v")).repartitionByRange(by, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    own = Window.partitionBy("_part", by).orderBy(*[F.desc(c) for c in order])
    later = F.count("_v").over(own.rowsBetween(Window.unboundedPreceding, 0)) - 1  # known values after this one in its range
    known = ranges.withColumn("_w", F.when(F.col("_v").isNotNull(), F.pow(F.lit(fade), later)))
    part = known.groupBy(by, "_part").agg(F.count("*").alias("n"), F.count("_v").alias("_k"), F.coalesce(F.sum(F.col("_w") * F.col("_v")), F.lit(0.0)).alias("_s"), F.min_by("_v", F.when(F.col("_v").isNotNull(), F.struct(*order))).alias("_f"))
    beyond = F.coalesce(F.sum("_k").over(series.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    s = part.withColumn("_x", F.pow(F.lit(fade), beyond) * F.col("_s"))
    one = s.groupBy(by).agg(F.sum("n").alias("n"), F.sum("_k").alias("_k"), F.sum("_x").alias("_x"), F.min_by("_f", F.when(F.col("_k") > 0, F.col("_part"))).alias("_f"))
    # the first value stands for all before it, so it weighs fade ** (k - 1), not alpha times that
    return one.select(by, F.col("n").cast("int").alias("n"), F.when(F.col("_k") > 0, alpha * F.col("_x") + F.pow(F.lit(fade), F.col("_k")) * F.col("_f")).alias("last_ewma"))


def ccf(bins: DataFrame, by: str, at: str, x: str, y: str, most: int) -> DataFrame:
    """lag, n, r: correlation of x at t with y at t + lag within a unit, pooled over units."""
    left = bins.where(F.col(x).isNotNull()).select(by, F.explode(F.sequence(F.lit(-most).cast("long"), F.lit(most).cast("long"))).alias("lag"), F.col(at).alias("_t"), F.col(x).alias("_x"))
    right = bins.where(F.col(y).isNotNull()).select(by, F.col(at).alias("_t2"), F.col(y).alias("_y"))
    j = left.withColumn("_t2", F.col("_t") + F.col("lag")).join(right, [by, "_t2"])
    return j.groupBy("lag").agg(F.count("*").alias("n"), F.corr("_x", "_y").alias("r"))


def rolling_origin(filled: DataFrame, by: str, at: str, value: str, first: int, every: int, horizon: int) -> DataFrame:
    """model (naive, mean, drift), n, mae, rmse: forecasts from every origin to ``horizon`` bins ahead on complete series."""
    w = Window.partitionBy(by).orderBy(at)
    past = w.rowsBetween(Window.unboundedPreceding, 0)
    o = filled.withColumn("_mean", F.avg(value).over(past)).withColumn("_first", F.first(value).over(past)).withColumn("_t0", F.first(at).over(past))
    o = o.where((F.col(at) >= first) & ((F.col(at) - first) % every == 0)).select(by, F.col(at).alias("_o"), F.col(value).alias("_last"), "_mean", F.try_divide(F.col(value) - F.col("_first"), F.col(at) - F.col("_t0")).alias("_slope"), F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_h"))
    j = o.withColumn(at, F.col("_o") + F.col("_h")).join(filled.select(by, at, F.col(value).alias("_y")), [by, at])
    models = F.explode(F.array(F.struct(F.lit("naive").alias("model"), F.col("_last").alias("f")), F.struct(F.lit("mean").alias("model"), F.col("_mean").alias("f")), F.struct(F.lit("drift").alias("model"), (F.col("_last") + F.col("_slope") * F.col("_h")).alias("f"))))
    e = j.select("_y", models.alias("m")).where("m.f is not null")
    err = F.col("_y") - F.col("m.f")
    return e.groupBy("m.model").agg(F.count("*").alias("n"), F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"))


def change_point(df: DataFrame, by: str, order: list[str], value: str, least: int = 2) -> DataFrame:
    """by, at (rows before the change), gain: the split into two means that lowers the squared error most, from prefix sums; ties to the earlier."""
    w = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    t = Window.partitionBy(by)
    d = df.withColumn("_n", F.count("*").over(w)).withColumn("_s", F.sum(value).over(w)).withColumn("_all_n", F.count("*").over(t)).withColumn("_all_s", F.sum(value).over(t))
    d = d.where((F.col("_n") >= least) & (F.col("_all_n") - F.col("_n") >= least))
    gain = F.col("_s") ** 2 / F.col("_n") + (F.col("_all_s") - F.col("_s")) ** 2 / (F.col("_all_n") - F.col("_n")) - F.col("_all_s") ** 2 / F.col("_all_n")
    best = F.max_by(F.struct("_n", "_g"), F.struct(F.round("_g", 6), -F.col("_n")))
    return d.withColumn("_g", gain).groupBy(by).agg(best.alias("b")).select(by, F.col("b._n").alias("at"), F.col("b._g").alias("gain"))


def change_points(df: DataFrame, by: str, order: list[str], value: str, penalty: float, least: int = 2, rounds: int | None = None) -> DataFrame:
    """by, at (rows before the change), gain, round: binary segmentation. In every round each open segment is split where two means lower its squared error most (ties to the earlier), if that is at least ``penalty``
    times the variance of its series; other segments are closed.

    A series' running sums are built once, by ranges; a segment's are their differences from its start, so rounds shuffle one row a segment and task, and no series is one task. Values must be known; a null series is
    a series. Runs until no segment is open, or for ``rounds``.
    """
    d = df.select(F.coalesce(F.col(by).cast("string"), F.lit("")).alias("_k"), F.col(by).alias("_by"), *order, F.col(value).cast("double").alias("_x"))
    d = d.withColumn("_k", F.concat(F.when(F.col("_by").isNull(), "0").otherwise("1"), "_k")).withColumn("_one", F.lit(1)).withColumn("_q", F.col("_x") * F.col("_x"))
    s = prefix_sums(d, order, ["_one", "_x", "_q"], keys=["_k"], totals=True)
    n, total = F.col("all__one"), F.col("all__x")
    bar = F.greatest((F.col("all__q") - total * total / n) / F.greatest(n - 1, F.lit(1)), F.lit(0.0)) * penalty
    rows = s.select("_k", "_by", F.col("cum__one").alias("_n"), F.col("cum__x").alias("_s"), bar.alias("_bar"), F.lit(0).cast("long").alias("_n0"), F.lit(0.0).alias("_s0"), n.cast("long").alias("_n1"), total.alias("_s1"))
    done, turn = [], 0
    while True:
        rows = persisted(rows, "segments")
        left, right = F.col("_n") - F.col("_n0"), F.col("_n1") - F.col("_n")
        sl, sr = F.col("_s") - F.col("_s0"), F.col("_s1") - F.col("_s")
        gain = sl * sl / left + F.try_divide(sr * sr, right) - (sl + sr) * (sl + sr) / (left + right)
        may = (left >= least) & (right >= least) & (gain >= F.col("_bar")) & (F.round(gain, 6) > 0)
        best = rows.withColumn("_g", F.when(may, gain)).groupBy("_k", "_n0").agg(F.max_by(F.struct("_n", "_s", "_g", "_by"), F.when(F.col("_g").isNotNull(), F.struct(F.round("_g", 6), -F.col("_n")))).alias("_b"), F.count("*").alias("_m"))
        best = persisted(best.select("_k", "_n0", "_m", F.col("_b._by").alias("_of"), F.col("_b._n").alias("_at"), F.col("_b._s").alias("_cut"), F.col("_b._g").alias("_g")), "splits")
        turn += 1
        done.append(best.where("_at is not null").select(F.col("_of").alias(by), F.col("_at").alias("at"), F.col("_g").alias("gain"), F.lit(turn).alias("round")))
        if turn == rounds or best.where("_at is not null").limit(1).count() == 0:
            return reduce(DataFrame.unionByName, done)
        met = lookup(rows, best.select("_k", "_n0", "_m", "_at", "_cut"), ["_k", "_n0"], "_m").where("_at is not null")
        low = F.col("_n") <= F.col("_at")
        pick = lambda inside, outside: F.when(low, F.col(inside)).otherwise(F.col(outside))
        rows = met.select("_k", "_by", "_n", "_s", "_bar", pick("_n0", "_at").alias("_n0"), pick("_s0", "_cut").alias("_s0"), pick("_at", "_n1").alias("_n1"), pick("_cut", "_s1").alias("_s1"))


def rolling_median(by: list[str], order: list[str], value: str, n: int) -> Column:
    """Median of the known values among the row and the n - 1 before it."""
    x = F.array_sort(F.collect_list(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(1 - n, 0)))
    m = F.size(x)
    return F.when(m > 0, (F.element_at(x, F.greatest(F.floor((m + 1) / 2).cast("int"), F.lit(1))) + F.element_at(x, F.greatest(F.floor(m / 2).cast("int") + 1, F.lit(1)))) / 2)


def rolling_origin_units(filled: DataFrame, by: str, at: str, value: str, first: int, every: int, horizon: int, season: int) -> DataFrame:
    """model (naive, seasonal, mean, drift), units, median mae and median mase over units: errors of a unit's forecasts, scaled by the mean step of its series. seasonal: the value a whole number of seasons before the target."""
    w = Window.partitionBy(by).orderBy(at)
    past = w.rowsBetween(Window.unboundedPreceding, 0)
    v = F.col(value)
    o = filled.withColumn("_mean", F.avg(v).over(past)).withColumn("_first", F.first(v).over(past)).withColumn("_t0", F.first(at).over(past))
    o = o.where((F.col(at) >= first) & ((F.col(at) - first) % every == 0)).select(by, F.col(at).alias("_o"), v.alias("_last"), "_mean", F.try_divide(v - F.col("_first"), F.col(at) - F.col("_t0")).alias("_slope"), F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_h"))
    o = o.withColumn("_s", F.col("_o") + F.col("_h") - season * F.ceil(F.col("_h") / season))
    j = o.withColumn(at, F.col("_o") + F.col("_h")).join(filled.select(by, at, v.alias("_y")), [by, at]).join(filled.select(by, F.col(at).alias("_s"), v.alias("_season")), [by, "_s"], "left")
    f = {"naive": F.col("_last"), "seasonal": F.col("_season"), "mean": F.col("_mean"), "drift": F.col("_last") + F.col("_slope") * F.col("_h")}
    e = j.select(by, "_y", F.explode(F.array(*[F.struct(F.lit(k).alias("model"), x.alias("f")) for k, x in f.items()])).alias("m")).where("m.f is not null")
    per = e.groupBy(by, "m.model").agg(F.avg(F.abs(F.col("_y") - F.col("m.f"))).alias("mae"))
    scale = filled.withColumn("_d", F.abs(v - F.lag(v).over(w))).groupBy(by).agg(F.avg("_d").alias("_scale"))
    s = per.join(scale, by).withColumn("mase", F.try_divide("mae", "_scale"))
    s = persisted(s, "errors")
    medians = with_quantiles(with_quantiles(s.groupBy("model").agg(F.count("*").alias("units")), s, "mae", [0.5], ["model"], "a"), s, "mase", [0.5], ["model"], "b")
    return medians.select("model", "units", F.col("a")[0].alias("mae"), F.col("b")[0].alias("mase"))
