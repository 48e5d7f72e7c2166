"""Joins that Spark has no operator for: as-of, within a time window, into intervals, on prefixes; join cardinality, crosswalks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.timesem import seconds
from strandline.sources.tables import persisted


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str, values: list[str], tiebreak: str, direction: str = "backward", tolerance_hours: float | None = None, hot: bool = False) -> DataFrame:
    """``left`` with ``values`` of the last right row at or before its time (``backward``) or the first at or after it (``forward``), and matched_at.

    Both sides are laid in one order by key and time, and each left row takes the nearest right row before it: one shuffle on the key, no pairs.
    Equal times match; among right rows of equal time the largest ``tiebreak`` (backward) or smallest (forward) wins. NULL keys or times match nothing.
    A key's rows are ordered in one task; with ``hot``, for keys that hold a large share of all rows, both sides are written in ranges of key and time instead, and the last row is carried from range to range.
    """
    sign = 1 if direction == "backward" else -1
    payload = F.struct(F.col(right_on).alias("_at"), *[F.col(v) for v in values])
    names = left.columns
    a = left.select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(by)], F.col(left_on).alias("_t"), F.lit(1 if sign > 0 else -1).alias("_side"), F.struct(*names).alias("_row"))
    b = right.where(F.col(right_on).isNotNull()).select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(by)], F.col(right_on).alias("_t"), F.lit(0).alias("_side"), F.col(tiebreak).alias("_tie"), payload.alias("_hit"))
    both = a.unionByName(b, allowMissingColumns=True)
    keys = [f"_k{n}" for n in range(len(by))]
    if hot:
        begun = F.when(F.col("_side") == 0, F.struct("_t", "_tie", "_hit"))
        time = F.col("_t").asc_nulls_first() if sign > 0 else F.col("_t").desc_nulls_first()
        w = Window.partitionBy("_part", *keys).orderBy(time, F.abs("_side")).rowsBetween(Window.unboundedPreceding, 0)
        pick, of_both = (F.max, F.greatest) if sign > 0 else (F.min, F.least)
        met = carry(dealt(both, keys, "_t"), keys, begun, sign).withColumn("_last", of_both(pick(begun).over(w), F.col("_carried"))["_hit"])
    elif sign > 0:
        w = Window.partitionBy(*keys).orderBy(F.col("_t").asc_nulls_first(), "_side", F.col("_tie").asc()).rowsBetween(Window.unboundedPreceding, 0)
        met = both.withColumn("_last", F.last("_hit", ignorenulls=True).over(w))
    else:
        w = Window.partitionBy(*keys).orderBy(F.col("_t").desc_nulls_first(), F.desc("_side"), F.col("_tie").desc()).rowsBetween(Window.unboundedPreceding, 0)
        met = both.withColumn("_last", F.last("_hit", ignorenulls=True).over(w))
    found = met.where("_row is not null")
    ok = F.col("_t").isNotNull()
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    if tolerance_hours is not None:
        ok = ok & (sign * (seconds("_t") - seconds(F.col("_last._at"))) <= tolerance_hours * 3600)
    hit = F.when(ok, F.col("_last"))
    return found.select("_row.*", hit["_at"].alias("matched_at"), *[hit[v].alias(v) for v in values])


def event_at(source: DataFrame, anchors: DataFrame, by: list[str], anchor: str, time: str, values: list[str], tiebreak: str, tolerance_hours: float | None = None) -> DataFrame:
    """Each anchor with the last source row at or before it."""
    return asof_join(anchors, source, by, anchor, time, values, tiebreak, "backward", tolerance_hours)


def window_join(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str, before_hours: float, after_hours: float) -> DataFrame:
    """All pairs of equal key whose right time lies in [left - before, left + after], and hours from left to right.

    Time is cut into buckets as wide as the window; each left row looks into the two buckets its window touches. Both sides shuffle on key and bucket, so a hot key is spread over time.
    Other columns of the two sides must have different names.
    """
    width = max(before_hours + after_hours, 1e-6) * 3600
    a = left.withColumn("_lo", seconds(left_on) - before_hours * 3600).withColumn("_hi", seconds(left_on) + after_hours * 3600)
    a = a.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("_lo") / width), F.floor(F.col("_hi") / width))))
    b = right.withColumn("_s", seconds(right_on)).withColumn("_bucket", F.floor(F.col("_s") / width))
    pairs = a.join(b, [*by, "_bucket"]).where((F.col("_s") >= F.col("_lo")) & (F.col("_s") <= F.col("_hi")))
    return pairs.withColumn("lag_hours", (F.col("_s") - seconds(left_on)) / 3600.0).drop("_lo", "_hi", "_s", "_bucket")


def dealt(df: DataFrame, by: list[str], time: str) -> DataFrame:
    """``df`` written in ranges of key and time, with _part, the number of its range: a hot key lies in many ranges, rows of equal key and time in one."""
    return persisted(df.repartitionByRange(*by, time).withColumn("_part", F.spark_partition_id()), "ranges")


def carry(ranges: DataFrame, by: list[str], value: Column, sign: int = 1) -> DataFrame:
    """``ranges`` with _carried: the largest ``value`` of the key in its ranges before this one (``sign`` -1: the smallest in those after it). Only a key that runs over an edge of ranges has one, so at most two rows a range are broadcast."""
    keys, pick = Window.partitionBy(*by), F.max if sign > 0 else F.min
    tops = ranges.groupBy(*by, "_part").agg(pick(value).alias("_top"))
    before = pick("_top").over(keys.orderBy("_part" if sign > 0 else F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1))
    over = tops.select(*by, "_part", before.alias("_carried"), F.count("*").over(keys).alias("_parts")).where(F.col("_parts") > 1).drop("_parts")
    return ranges.join(F.broadcast(over), [*by, "_part"], "left")


def interval_join(points: DataFrame, intervals: DataFrame, by: list[str], time: str, start: str, end: str, interval_id: str) -> DataFrame:
    """Every row of ``points`` (repeated ones too) with the interval [start, end) of its key that holds it, of several the earliest (of equally early ones the first to end, then the smallest id); NULLs where none does.

    What an interval holds alone begins where those before it have ended; these pieces don't overlap, so the last one to begin at or before a point is the only one that can hold it.
    Both steps run in ranges of key and time and carry the edge over: no pairs, and no key in one task.
    """
    keys = [f"_k{n}" for n in range(len(by))]
    named = [F.col(k).alias(n) for k, n in zip(by, keys, strict=True)]
    known = F.col("_s").isNotNull() & (F.col("_s") < F.col("_e"))
    for k in keys:
        known = known & F.col(k).isNotNull()
    i = dealt(intervals.select(*named, F.col(start).alias("_s"), F.col(end).alias("_e"), F.col(interval_id).alias("_i")).where(known), keys, "_s")
    own = Window.partitionBy("_part", *keys)
    ended = F.greatest(F.max("_e").over(own.orderBy("_s", "_e", "_i").rowsBetween(Window.unboundedPreceding, -1)), "_carried")
    pieces = carry(i, keys, F.col("_e")).withColumn("_ended", ended).where(F.col("_ended").isNull() | (F.col("_e") > F.col("_ended")))
    pieces = pieces.select(*keys, F.greatest("_s", "_ended").alias("_t"), F.lit(0).alias("_side"), F.struct("_s", "_e", "_i").alias("_hit"))
    rows = points.select(*named, F.col(time).alias("_t"), F.lit(1).alias("_side"), F.struct(*points.columns).alias("_row"))
    both = dealt(pieces.unionByName(rows, allowMissingColumns=True), keys, "_t")
    begun = F.when(F.col("_side") == 0, F.struct("_t", "_hit"))
    last = F.greatest(F.max(begun).over(own.orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)), "_carried")
    found = carry(both, keys, begun).withColumn("_best", last["_hit"]).where("_side = 1")
    hit = F.when(F.col("_t") < F.col("_best._e"), F.col("_best"))
    return found.select("_row.*", hit["_i"].alias(interval_id), hit["_s"].alias(start), hit["_e"].alias(end))


def prefix_join(codes: DataFrame, code: str, prefixes: DataFrame, prefix: str, lengths: list[int]) -> DataFrame:
    """codes x prefixes where the code starts with the prefix: an equi-join on the code's leading parts, one for each prefix length in use."""
    parts = codes.withColumn(prefix, F.explode(F.array_distinct(F.array(*[F.substring(code, 1, n) for n in lengths]))))
    return parts.join(prefixes, prefix)


def join_cardinality(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: relation (1:1, 1:n, n:1, n:m over matched keys), max rows a key on either side, keys on one side alone, share of matched keys with several rows."""
    a = left.groupBy(key).agg(F.count("*").alias("a"))
    b = right.groupBy(key).agg(F.count("*").alias("b"))
    j = a.join(b, key, "full")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    most_a, most_b = F.max(F.when(both, F.col("a"))), F.max(F.when(both, F.col("b")))
    name = F.concat(F.when(most_a > 1, "n").otherwise("1"), F.lit(":"), F.when(most_b > 1, F.when(most_a > 1, "m").otherwise("n")).otherwise("1"))
    return j.agg(name.alias("relation"), F.max("a").alias("max_left"), F.max("b").alias("max_right"), F.count_if(F.col("b").isNull()).alias("left_only"), F.count_if(F.col("a").isNull()).alias("right_only"), F.avg(F.when(both, ((F.col("a") > 1) | (F.col("b") > 1)).cast("double"))).alias("share_multiple"))


def crosswalk(codes: DataFrame, code: str, mapping: DataFrame) -> DataFrame:
    """codes with their targets; ``mapping`` (source, target, approximate). Adds no_map and combination (several targets for a code)."""
    m = mapping.select(F.col("source").alias(code), "target", "approximate")
    n = m.groupBy(code).agg(F.count("target").alias("_n"))
    got = codes.join(m, code, "left").join(n, code, "left")
    return got.withColumn("no_map", F.col("target").isNull()).withColumn("combination", F.coalesce(F.col("_n") > 1, F.lit(False))).drop("_n")

