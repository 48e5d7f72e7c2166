"""Index events, grains, episodes, rolling statistics and counting-process rows, all by windows within a subject."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.timesem import seconds


def index_event(df: DataFrame, subject: str, time: str, tiebreak: str, rule: str = "first") -> DataFrame:
    """``first`` or ``last`` row of each subject, or ``each`` row."""
    if rule == "each":
        return df
    order = [F.col(time), F.col(tiebreak)] if rule == "first" else [F.desc(time), F.desc(tiebreak)]
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(subject).orderBy(*order))).where("_r = 1").drop("_r")


def stay_index(df: DataFrame, encounter: str, time: str, tiebreak: str) -> DataFrame:
    """Adds seq (from 1 within the encounter) and first."""
    n = F.row_number().over(Window.partitionBy(encounter).orderBy(time, tiebreak))
    return df.withColumn("seq", n).withColumn("first", F.col("seq") == 1)


def explode_units(stays: DataFrame, start: str, end: str, hours: float, name: str, cap: int | None = None) -> DataFrame:
    """One row for each begun unit of ``hours`` hours of a stay, from 0, ``cap`` units at most; a stay that doesn't last gives one."""
    n = F.greatest(F.ceil((seconds(end) - seconds(start)) / (hours * 3600)), F.lit(1)).cast("int")
    n = F.least(n, F.lit(cap)) if cap else n
    return stays.withColumn(name, F.explode(F.sequence(F.lit(0), n - 1)))


def person_time(df: DataFrame, subject: str, start: str, end: str) -> DataFrame:
    """subject, person_days: total length of its [start, end) intervals."""
    return df.groupBy(subject).agg((F.sum(seconds(end) - seconds(start)) / 86400).alias("person_days"))


def merge_gaps(df: DataFrame, by: list[str], start: str, end: str, gap_hours: float, tiebreak: str, dose: str | None = None) -> DataFrame:
    """Episodes: intervals of a key that overlap or follow within the gap. start, stop, n, hours, days_of_therapy and total_dose if ``dose`` is named."""
    w = Window.partitionBy(*by).orderBy(start, tiebreak)
    reach = F.max(seconds(end)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = (reach.isNull() | (seconds(start) - reach > gap_hours * 3600)).cast("int")
    flagged = df.withColumn("_new", new).withColumn("episode", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    span = (F.max(seconds(end)) - F.min(seconds(start))) / 3600
    aggs = [F.min(start).alias("start"), F.max(end).alias("stop"), F.count("*").alias("n"), span.alias("hours"), F.countDistinct(F.to_date(F.col(start))).alias("days_of_therapy")]
    return flagged.groupBy(*by, "episode").agg(*aggs, *([F.sum(dose).alias("total_dose")] if dose else []))


def sessions(events: DataFrame, gap_hours: float = 24) -> DataFrame:
    """Events with session (from 1 within the user): a new one begins when the gap to the user's previous event is longer."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = seconds("ts") - F.lag(seconds("ts")).over(w)
    new = (gap.isNull() | (gap > gap_hours * 3600)).cast("int")
    return events.withColumn("_new", new).withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def recurrent_episodes(df: DataFrame, subject: str, time: str, tiebreak: str, gap_hours: float, followed_from: DataFrame, followed_to: str = "last", origin: str = "first") -> DataFrame:
    """Counting-process rows (subject, no, start, stop, event) in hours from ``origin``: one an episode, and a censored one up to the end of follow-up if time is left.

    Episodes begin with events more than the gap after the previous event of the subject.
    """
    w = Window.partitionBy(subject).orderBy(time, tiebreak)
    gap = seconds(time) - F.lag(seconds(time)).over(w)
    begins = df.withColumn("_gap", gap).where(F.col("_gap").isNull() | (F.col("_gap") > gap_hours * 3600)).select(subject, F.col(time).alias("_t"))
    ends = begins.withColumn("event", F.lit(1)).unionByName(followed_from.select(subject, F.col(followed_to).alias("_t"), F.lit(0).alias("event")))
    timed = ends.join(followed_from.select(subject, F.col(origin).alias("_o")), subject).withColumn("stop", (seconds("_t") - seconds("_o")) / 3600)
    order = Window.partitionBy(subject).orderBy("stop", F.desc("event"))
    rows = timed.withColumn("start", F.coalesce(F.lag("stop").over(order), F.lit(0.0))).withColumn("no", F.row_number().over(order))
    return rows.where("event = 1 or stop > start").select(subject, "no", "start", "stop", "event")


def rolling(by: list[str], time: str, hours: float, stat: Column) -> Column:
    """``stat`` (an aggregate) over the rows of the key from ``hours`` before up to the row's time, rows of equal time included."""
    return stat.over(Window.partitionBy(*by).orderBy(F.unix_micros(F.col(time).cast("timestamp"))).rangeBetween(-int(hours * 3600e6), 0))


def neighbours(df: DataFrame, subject: str, time: str, tiebreak: str, value: str) -> DataFrame:
    """Adds previous, following, delay_hours to the following row, and the subject's first and last value."""
    w = Window.partitionBy(subject).orderBy(time, tiebreak)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    delay = (F.lead(seconds(time)).over(w) - seconds(time)) / 3600
    return df.select("*", F.lag(value).over(w).alias("previous"), F.lead(value).over(w).alias("following"), delay.alias("delay_hours"), F.first(value).over(whole).alias("first_value"), F.last(value).over(whole).alias("last_value"))


def start_stop(df: DataFrame, subject: str, time: str, tiebreak: str, state: str, terminal: Column) -> DataFrame:
    """Counting-process rows: from each of a subject's times to the next, with the state that holds meanwhile and whether the row ends in the terminal event. Times that coincide give one row, the last state."""
    one = df.groupBy(subject, time).agg(F.max_by(state, tiebreak).alias("state"), F.max(terminal.cast("int")).alias("_t"))
    w = Window.partitionBy(subject).orderBy(time)
    return one.select(subject, F.col(time).alias("start"), F.lead(time).over(w).alias("stop"), "state", F.lead("_t").over(w).alias("event")).where("stop is not null")


def validate_start_stop(rows: DataFrame, subject: str) -> DataFrame:
    """One row: rows of no length, rows that begin before the previous one ends, subjects with several terminal events."""
    w = Window.partitionBy(subject).orderBy("start", "stop")
    r = rows.withColumn("_p", F.lag("stop").over(w)).withColumn("_n", F.sum("event").over(Window.partitionBy(subject)))
    return r.agg(F.count_if(F.col("stop") <= F.col("start")).alias("no_length"), F.count_if(F.col("_p") > F.col("start")).alias("overlaps"), F.countDistinct(F.when(F.col("_n") > 1, F.col(subject))).alias("many_terminal"))


def event_window_flags(df: DataFrame, subject: str, start: str, end: str, tiebreak: str, back_hours: float, after_hours: float) -> DataFrame:
    """Adds bounce_back (begins within the hours after the previous one ended) and late_next (the next begins at least the hours after this one began)."""
    w = Window.partitionBy(subject).orderBy(start, tiebreak)
    since = (seconds(start) - F.lag(seconds(end)).over(w)) / 3600
    until = (F.lead(seconds(start)).over(w) - seconds(start)) / 3600
    return df.withColumn("bounce_back", F.coalesce(since.between(0, back_hours), F.lit(False))).withColumn("late_next", F.coalesce(until >= after_hours, F.lit(False)))
