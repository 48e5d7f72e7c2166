"""Cohorts: each criterion once as a boolean column, membership and attrition from the flags."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.timesem import definition_hash, seconds


@dataclass(frozen=True)
class Criterion:
    """A named test: a Column over the base, or a table of grains (``members``) whose rows pass (or, negated, fail)."""

    name: str
    test: Column | None = None
    members: DataFrame | None = None
    negate: bool = False


@dataclass(frozen=True)
class CohortSpec:
    name: str
    version: int
    grain: str
    subject: str
    criteria: list[Criterion] = field(default_factory=list)

    def hash(self) -> str:
        return definition_hash({"name": self.name, "version": self.version, "grain": self.grain, "criteria": [(c.name, str(c.test), c.negate) for c in self.criteria]})


def flag_criteria(base: DataFrame, spec: CohortSpec) -> DataFrame:
    """``base`` with a boolean column crit_<n> for each criterion; an unknown test fails."""
    out = base
    for k, c in enumerate(spec.criteria):
        if c.members is not None:
            out = out.join(c.members.select(spec.grain).distinct().withColumn("_m", F.lit(True)), spec.grain, "left")
            test = F.coalesce("_m", F.lit(False))
        else:
            test = F.coalesce(c.test, F.lit(False))
        out = out.withColumn(f"crit_{k}", ~test if c.negate else test).drop("_m")
    return out


def compile_cohort(base: DataFrame, spec: CohortSpec) -> DataFrame:
    """The rows of ``base`` that meet every criterion."""
    flagged = flag_criteria(base, spec)
    for k in range(len(spec.criteria)):
        flagged = flagged.where(F.col(f"crit_{k}"))
    return flagged.select(*base.columns)


def attrition(base: DataFrame, spec: CohortSpec) -> DataFrame:
    """step, name, n_units, n_subjects, dropped after each criterion in order, from one aggregate over the flagged base."""
    flagged = flag_criteria(base, spec)
    aggs, met = [], F.lit(True)
    for k in range(len(spec.criteria) + 1):
        met = met if k == 0 else met & F.col(f"crit_{k - 1}")
        aggs += [F.count_if(met).alias(f"u{k}"), F.countDistinct(F.when(met, F.col(spec.subject))).alias(f"s{k}")]
    names = ["base", *[c.name for c in spec.criteria]]
    before = lambda k: F.lit(0).cast("long") if k == 0 else F.col(f"u{k - 1}") - F.col(f"u{k}")
    steps = [F.struct(F.lit(k).alias("step"), F.lit(n).alias("name"), F.col(f"u{k}").alias("n_units"), F.col(f"s{k}").alias("n_subjects"), before(k).alias("dropped")) for k, n in enumerate(names)]
    return flagged.agg(*aggs).select(F.explode(F.array(*steps)).alias("x")).select("x.*")


def washout(df: DataFrame, subject: str, start: str, end: str, tiebreak: str, days: int) -> Column:
    """True where the subject has no earlier encounter that ended within the days."""
    w = Window.partitionBy(subject).orderBy(start, tiebreak).rowsBetween(Window.unboundedPreceding, -1)
    last = F.max(seconds(end)).over(w)
    return last.isNull() | (seconds(start) - last > days * 86400)


def prior_events(base: DataFrame, grain: str, subject: str, time: str, events: DataFrame, event_time: str, days: int | None = None) -> DataFrame:
    """Grains with an event of the subject before their time (within the days): each base row looks at the subject's latest event before it."""
    from strandline.operators.joins import asof_join

    e = events.select(F.col(subject), F.col(event_time).alias("_et")).withColumn("_tie", F.lit(0))
    hit = asof_join(base.select(grain, subject, (F.col(time) - F.expr("interval 1 microsecond")).alias("_bt")), e, [subject], "_bt", "_et", ["_tie"], "_tie", "backward", None if days is None else days * 24)
    return hit.where("matched_at is not null").select(grain).distinct()


def ranges_to_filter(ranges: dict[str, tuple[float | None, float | None]]) -> Column:
    """Brushed ranges as one predicate: closed below, open above; None leaves a side open."""
    out = F.lit(True)
    for c, (lo, hi) in ranges.items():
        out = out & (F.lit(True) if lo is None else F.col(c) >= lo) & (F.lit(True) if hi is None else F.col(c) < hi)
    return out


def materialize_cohort(cohort: DataFrame, spec: CohortSpec, path: str, force: bool = False) -> None:
    """Writes the cohort in order of its grain with the definition's hash; another definition under the same path raises unless forced."""
    spark = cohort.sparkSession
    try:
        old = spark.read.json(f"{path}/manifest").first()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = None
    if old is not None and old["hash"] != spec.hash() and not force:
        raise ValueError(f"{spec.name} version {spec.version} exists with another definition")
    cohort.repartitionByRange(spec.grain).sortWithinPartitions(spec.grain).write.mode("overwrite").parquet(f"{path}/rows")
    spark.createDataFrame([(spec.name, spec.version, spec.hash())], "name string, version int, hash string").coalesce(1).write.mode("overwrite").json(f"{path}/manifest")


def demographic(low: float | None = None, high: float | None = None, age: str = "age", levels: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Age in [low, high) and each named column among its allowed levels."""
    out = ranges_to_filter({age: (low, high)})
    for c, allowed in (levels or {}).items():
        out = out & F.col(c).isin(*allowed)
    return out


def data_available(base: DataFrame, grain: str, subject: str, start: str, rows: DataFrame, time: str, item: str, items: list[str], hours: float, least: int = 1) -> DataFrame:
    """Grains with at least ``least`` rows of every named item within the hours from their start."""
    from strandline.operators.joins import window_join

    r = rows.where(F.col(item).isin(*items)).select(F.col(subject), F.col(time).alias("_rt"), F.col(item).alias("_item"))
    hit = window_join(base.select(grain, subject, F.col(start).alias("_st")), r, [subject], "_st", "_rt", 0, hours)
    per = hit.groupBy(grain, "_item").agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    return per.groupBy(grain).agg(F.count("*").alias("_k")).where(F.col("_k") == len(items)).select(grain)


def prior_admissions(subject: str, start: str, tiebreak: str) -> Column:
    """Number of the subject's earlier encounters."""
    return F.row_number().over(Window.partitionBy(subject).orderBy(start, tiebreak)) - 1
