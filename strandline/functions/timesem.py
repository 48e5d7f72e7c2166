"""Time semantics, bands, units, codes and hashes as Columns."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def micros(t: Column | str) -> Column:
    """Microseconds since the epoch of a naive timestamp taken as UTC."""
    return F.unix_micros((F.col(t) if isinstance(t, str) else t).cast("timestamp"))


def seconds(t: Column | str) -> Column:
    """Seconds since the epoch with fractions, of a naive timestamp taken as UTC."""
    return micros(t) / F.lit(1e6)


def hours_since(anchor: Column | str, t: Column | str) -> Column:
    return (micros(t) - micros(anchor)) / 3600e6


def days_since(anchor: Column | str, t: Column | str) -> Column:
    return (micros(t) - micros(anchor)) / 86400e6


def hour_bin(hours: Column, width: float = 1) -> Column:
    """[start, end) bins: the floor of hours / width."""
    return F.floor(hours / width)


def icu_day(hours: Column) -> Column:
    return F.floor(hours / 24)


def age_at(anchor_age: Column, anchor_year: Column, t: Column, cap: int = 91) -> Column:
    """Age in the year of ``t``, at most ``cap``."""
    return F.least(anchor_age + F.year(t) - anchor_year, F.lit(cap))


def age_capped(age: Column, cap: int = 91) -> Column:
    return age >= cap


def era_index(year: Column, starts: tuple[int, ...]) -> Column:
    """0 for years before starts[1], and so on; NULL for NULL."""
    out = F.lit(len(starts) - 1)
    for k in range(len(starts) - 1, 0, -1):
        out = F.when(year < starts[k], k - 1).otherwise(out)
    return F.when(year.isNull(), F.lit(None)).otherwise(out).cast("int")


def code_system(df: DataFrame, key: str, version: str) -> DataFrame:
    """key, code_system: the only version among its codes, else 'mixed'."""
    lo, hi = F.min(version), F.max(version)
    return df.groupBy(key).agg(F.when(lo == hi, lo).otherwise("mixed").alias("code_system"))


def follow_up_end(anchor: Column, last_contact: Column, horizon_days: int, cap_days: int = 365) -> Column:
    """min(anchor + horizon, last contact + cap)."""
    return F.least(anchor + F.expr(f"interval {horizon_days} days"), last_contact + F.expr(f"interval {cap_days} days"))


def censor_reason(anchor: Column, last_contact: Column, horizon_days: int, cap_days: int = 365) -> Column:
    early = last_contact + F.expr(f"interval {cap_days} days") < anchor + F.expr(f"interval {horizon_days} days")
    return F.when(early, "last-contact").otherwise("horizon")


def band(x: Column, cuts: list[float]) -> Column:
    """Number of cuts at or below x: half-open bands [cut, next cut). NULL stays NULL."""
    return sum(((x >= c).cast("int") for c in cuts[1:]), (x >= cuts[0]).cast("int"))


def collapse(x: Column, levels: dict[str, str], other: str = "other") -> Column:
    """Level-collapse map; NULL stays NULL, unknown levels become ``other``."""
    out = F.lit(other)
    for k, v in levels.items():
        out = F.when(x == k, v).otherwise(out)
    return F.when(x.isNull(), F.lit(None)).otherwise(out)


def harmonize(df: DataFrame, item: str, value: str, unit: str, rules: DataFrame) -> DataFrame:
    """Adds harmonized: struct(value, unit, converted, plausible). ``rules`` (item, unit, factor, shift, to_unit, low, high) is a dictionary of at most thousands of rows;
    a pair without a rule passes through, not converted, plausibility unknown."""
    r = rules.select(F.col("item").alias(item), F.col("unit").alias(unit), "factor", "shift", "to_unit", "low", "high")
    got = df.join(r, [item, unit], "left")
    new = F.when(F.col("factor").isNotNull(), F.col(value) * F.col("factor") + F.col("shift")).otherwise(F.col(value))
    out = F.struct(new.alias("value"), F.coalesce("to_unit", unit).alias("unit"), F.col("factor").isNotNull().alias("converted"), new.between(F.col("low"), F.col("high")).alias("plausible"))
    return got.withColumn("harmonized", out).drop("factor", "shift", "to_unit", "low", "high")


def plausible(x: Column, low: float, high: float) -> Column:
    return x.between(low, high)


def clip_to_plausible(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def parse_value(text: Column) -> Column:
    """struct(kind, low, high) of value texts: a number or a bound such as <0.01 (low and high are the number), a range 1-2, a pair 120/80; other texts have kind 'text'."""
    number = r"\s*(-?\d+(?:\.\d+)?)\s*"
    one, bound, span, pair = f"^{number}$", rf"^\s*[<>]=?{number}$", f"^{number}-{number}$", f"^{number}/{number}$"
    part = lambda p, k: F.regexp_extract(text, p, k).try_cast("double")
    kind = F.when(text.rlike(one), "number").when(text.rlike(bound), "bound").when(text.rlike(span), "range").when(text.rlike(pair), "pair").otherwise("text")
    low = F.coalesce(part(one, 1), part(bound, 1), part(span, 1), part(pair, 1))
    high = F.coalesce(part(one, 1), part(bound, 1), part(span, 2), part(pair, 2))
    return F.when(text.isNotNull(), F.struct(kind.alias("kind"), low.alias("low"), high.alias("high")))


def normalize_code(code: Column) -> Column:
    """Upper case, without dots and outer blanks."""
    return F.upper(F.regexp_replace(F.trim(code), r"\.", ""))


def sensitive_scan(df: DataFrame, low: int, high: int, digits: int | None = None) -> DataFrame:
    """column, n_hits, n_total: integers within the protected band, and in text columns rows with a token of ``digits`` digits. One aggregate over the table."""
    aggs, names = [], []
    for c, kind in df.dtypes:
        if kind in ("smallint", "int", "bigint"):
            aggs.append(F.count_if(F.col(c).between(low, high)))
        elif kind == "string" and digits:
            aggs.append(F.count_if(F.col(c).rlike(rf"(^|\D)\d{{{digits}}}(\D|$)")))
        else:
            continue
        names.append(c)
    one = df.agg(F.count("*").alias("n_total"), *[a.alias(f"h{k}") for k, a in enumerate(aggs)])
    return one.select("n_total", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"h{k}").alias("n_hits")) for k, c in enumerate(names)])).alias("x")).select("x.column", "x.n_hits", "n_total")


def definition_hash(spec: dict) -> str:
    """SHA-256 of a definition's canonical JSON."""
    return hashlib.sha256(json.dumps(spec, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def hash_partition(key: Column, seed: int, k: int) -> Column:
    """A fold from 0 to k - 1 that depends on key and seed alone."""
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(k)).cast("int")


def md5_unit(key: Column, seed: str) -> Column:
    """A number in [0, 1) from key and seed that other engines can compute as well."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.lit(":"), key.cast("string"))), 1, 12), 16, 10).cast("double") / float(16**12)


def stratified_sample(df: DataFrame, unit: str, strata: str, n: int, seed: str) -> DataFrame:
    """All rows of the n units of each stratum with the smallest hashes; a unit's stratum is the smallest of its rows'."""
    units = df.groupBy(unit).agg(F.min(strata).alias("_s")).withColumn("_h", md5_unit(F.col(unit), seed))
    picked = units.withColumn("_r", F.row_number().over(Window.partitionBy("_s").orderBy("_h", unit))).where(F.col("_r") <= n)
    return df.join(picked.select(unit), unit, "left_semi")
