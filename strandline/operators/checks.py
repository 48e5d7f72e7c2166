"""Data-quality and integrity checks. Each gives rows (check_id, table, column, n_affected, n_total, status): counts, never data."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.sums import dealt
from strandline.sources.tables import TableSpec

RESULT = ["check_id", "table", "column", "n_affected", "n_total", "status"]
#: Rows that lie behind one another are compared in runs of 2^RUN.
RUN = 17


def _row(df: DataFrame, check: str, table: str, column: str, affected: Column, total: Column | None = None) -> DataFrame:
    one = df.agg(F.coalesce(affected, F.lit(0)).cast("long").alias("n_affected"), (F.count(F.lit(1)) if total is None else total).cast("long").alias("n_total"))
    return _named(one, check, table, column)


def _named(one: DataFrame, check: str, table: str, column: str) -> DataFrame:
    status = F.when(F.col("n_affected") == 0, "ok").otherwise("fail")
    return one.select(F.lit(check).alias("check_id"), F.lit(table).alias("table"), F.lit(column).alias("column"), "n_affected", "n_total", status.alias("status"))


def check_schema(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row a contract column: rows that don't cast to its type, all rows if the column isn't there; and one row for the column order."""
    there = [f for f in spec.schema.fields if f.name in df.columns]
    aggs = [F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f"x{k}") for k, f in enumerate(there)]
    one = df.agg(F.count(F.lit(1)).alias("n_total"), *aggs)
    entries = [F.struct(F.lit(f.name).alias("column"), F.col(f"x{k}").alias("n_affected")) for k, f in enumerate(there)]
    entries += [F.struct(F.lit(f.name).alias("column"), F.col("n_total").alias("n_affected")) for f in spec.schema.fields if f not in there]
    wrong = [c for c in df.columns if c in spec.schema.names] != [c for c in spec.schema.names if c in df.columns] or any(c not in spec.schema.names for c in df.columns)
    entries.append(F.struct(F.lit("*").alias("column"), F.lit(int(wrong)).cast("long").alias("n_affected")))
    rows = one.select("n_total", F.explode(F.array(*entries)).alias("x")).select("n_total", "x.*")
    return rows.select(F.lit("schema").alias("check_id"), F.lit(spec.name).alias("table"), "column", "n_affected", "n_total", F.when(F.col("n_affected") == 0, "ok").otherwise("fail").alias("status"))


def check_not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    one = df.agg(F.count(F.lit(1)).alias("n_total"), *[F.count_if(F.col(c).isNull()).alias(f"x{k}") for k, c in enumerate(columns)])
    x = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"x{k}").alias("n_affected")) for k, c in enumerate(columns)]))
    rows = one.select("n_total", x.alias("x")).select("n_total", "x.*")
    return rows.select(F.lit("not_null").alias("check_id"), F.lit(table).alias("table"), "column", "n_affected", "n_total", F.when(F.col("n_affected") == 0, "ok").otherwise("fail").alias("status"))


def check_unique(df: DataFrame, table: str, keys: list[str], check: str = "unique") -> DataFrame:
    """Rows beyond the first of each key; a NULL in a key counts as a value."""
    return _row(df.groupBy(*keys).agg(F.count("*").alias("n")), check, table, ",".join(keys), F.sum(F.col("n") - 1), F.coalesce(F.sum("n"), F.lit(0)))


def check_fk(child: DataFrame, table: str, columns: list[str], parent: DataFrame, parent_columns: list[str], check: str = "fk") -> DataFrame:
    """Distinct non-null child keys without a parent, of the distinct non-null child keys."""
    n = max(child.count(), parent.count())  # both sides are dealt alike: neither distinct nor join shuffles again
    keys = dealt(child.select(*columns).dropna(), n, *columns).distinct()
    parents = dealt(parent.select(*[F.col(p).alias(c) for p, c in zip(parent_columns, columns, strict=True)]), n, *columns).distinct().withColumn("_there", F.lit(1))
    return _row(keys.join(parents, columns, "left"), check, table, ",".join(columns), F.count_if(F.col("_there").isNull()))


@dataclass(frozen=True)
class Link:
    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


def check_all_fks(tables: dict[str, DataFrame], links: list[Link]) -> DataFrame:
    return union([check_fk(tables[x.child], x.child, list(x.columns), tables[x.parent], list(x.parent_columns)) for x in links])


def check_pair(df: DataFrame, table: str, pair: list[str], parent: DataFrame, parent_pair: list[str]) -> DataFrame:
    """Distinct non-null pairs that don't exist as a pair in the parent."""
    return check_fk(df, table, pair, parent, parent_pair, "pair")


def check_sorted(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Rows that lie before their predecessor in the same file by ``keys``; rows are numbered as they are read. Runs of up to 2^RUN rows are compared each alone, then a run's first row with the last of the run before it: no task holds a file, and tasks grow in number, not in size."""
    placed = df.select(F.struct(*keys).alias("k"), F.input_file_name().alias("file"), F.input_file_block_start().alias("start"), F.monotonically_increasing_id().alias("at"))
    run = ["file", "start", "piece"]
    placed = dealt(placed.withColumn("piece", F.shiftright("at", RUN)), df.count(), *run)  # ids have their partition from bit 33 on
    each = placed.withColumn("p", F.lag("k").over(Window.partitionBy(*run).orderBy("at")))
    runs = each.groupBy(*run).agg(F.count_if(F.col("p") > F.col("k")).alias("bad"), F.count("*").alias("n"), F.min_by("k", "at").alias("first"), F.max_by("k", "at").alias("last"))
    before = F.lag("last").over(Window.partitionBy("file").orderBy("start", "piece"))
    met = runs.withColumn("bad", F.col("bad") + F.coalesce((before > F.col("first")).cast("int"), F.lit(0)))
    return _row(met, "sorted", table, ",".join(keys), F.sum("bad"), F.coalesce(F.sum("n"), F.lit(0)))


def check_order(df: DataFrame, table: str, first: str, then: str) -> DataFrame:
    return _row(df.where(F.col(first).isNotNull() & F.col(then).isNotNull()), "order", table, f"{first}<={then}", F.count_if(F.col(first) > F.col(then)))


def check_flag_agrees(df: DataFrame, table: str, flag: Column, present: Column, name: str) -> DataFrame:
    return _row(df, "flag", table, name, F.count_if(F.coalesce(flag, F.lit(False)) != present))


def check_against_group_max(parent: DataFrame, table: str, key: str, date: str, child: DataFrame, child_key: str, child_time: str) -> DataFrame:
    """Parents whose date lies before their latest child; parents without a child pass."""
    top = child.groupBy(F.col(child_key).alias(key)).agg(F.max(child_time).alias("_last"))
    return _row(parent.join(top, key, "left"), "group_max", table, date, F.count_if(F.col(date) < F.col("_last")))


def check_domain(df: DataFrame, table: str, name: str, rule: Column) -> DataFrame:
    """Rows on which the rule is false; NULL passes."""
    return _row(df, "domain", table, name, F.count_if(~rule))


def check_contained(child: DataFrame, table: str, parent: DataFrame, key: str, inner: tuple[str, str], outer: tuple[str, str], slack_hours: float = 6) -> DataFrame:
    """Child intervals that leave their parent's interval by more than the slack; children without a parent aren't counted."""
    from strandline.functions.timesem import seconds

    p = parent.select(key, F.col(outer[0]).alias("_lo"), F.col(outer[1]).alias("_hi"))
    out = (seconds(inner[0]) < seconds("_lo") - slack_hours * 3600) | (seconds(inner[1]) > seconds("_hi") + slack_hours * 3600)
    return _row(child.join(p, key), "contained", table, f"{inner[0]},{inner[1]}", F.count_if(out))


def check_derived(df: DataFrame, table: str, name: str, stored: Column, computed: Column, tolerance: float = 1e-6) -> DataFrame:
    return _row(df.where(stored.isNotNull() & computed.isNotNull()), "derived", table, name, F.count_if(F.abs(stored - computed) > tolerance))


def check_exactly_one(df: DataFrame, table: str, keys: list[str], other: DataFrame, other_keys: list[str]) -> DataFrame:
    """Rows whose key matches none or several rows of ``other``."""
    n = other.groupBy(*[F.col(o).alias(k) for o, k in zip(other_keys, keys, strict=True)]).agg(F.count("*").alias("_n"))
    return _row(df.join(n, keys, "left"), "exactly_one", table, ",".join(keys), F.count_if(F.coalesce("_n", F.lit(0)) != 1))


def check_dictionary_link(df: DataFrame, table: str, item: str, dictionary: DataFrame, dictionary_item: str, linked: Column | None = None) -> DataFrame:
    """Distinct items that aren't in the dictionary, or whose entry doesn't name this table (``linked``, over the dictionary's columns)."""
    d = dictionary.select(F.col(dictionary_item).alias(item), (F.lit(True) if linked is None else linked).alias("_ok"))
    return _row(df.select(item).dropna().distinct().join(d, item, "left"), "dictionary", table, item, F.count_if(~F.coalesce("_ok", F.lit(False))))


def check_duplicates(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    return check_unique(df, table, keys, "duplicates")


def graded(share: Column, warn: float, fail: float) -> Column:
    return F.when(share > fail, "fail").when(share > warn, "warn").otherwise("ok")


def check_null_share(df: DataFrame, table: str, columns: list[str], warn: float = 0.05, fail: float = 0.5) -> DataFrame:
    rows = check_not_null(df, table, columns)
    return rows.withColumn("check_id", F.lit("null_share")).withColumn("status", graded(F.col("n_affected") / F.col("n_total"), warn, fail))


def check_era_coverage(df: DataFrame, table: str, era: Column, n_eras: int) -> DataFrame:
    """Eras without a row."""
    return _row(df.select(era.alias("e")).dropna().distinct(), "era_coverage", table, "era", F.lit(n_eras) - F.count("e"), F.lit(n_eras))


def check_share(df: DataFrame, table: str, check: str, name: str, bad: Column, warn: float = 0.01, fail: float = 0.05) -> DataFrame:
    """Rows that are ``bad``, graded by their share: values at a cap, values outside bounds."""
    return _row(df, check, table, name, F.count_if(bad)).withColumn("status", graded(F.col("n_affected") / F.col("n_total"), warn, fail))


def check_implausible_share(df: DataFrame, table: str, value: str, low: float, high: float) -> DataFrame:
    return check_share(df.where(F.col(value).isNotNull()), table, "implausible", value, ~F.col(value).between(low, high))


def unit_variants(df: DataFrame, item: str, unit: str, dominant: float = 0.95) -> DataFrame:
    """item, unit, n, share, mixed: the units of each item; mixed where no unit holds ``dominant`` of the item's rows."""
    n = df.groupBy(item, unit).agg(F.count("*").alias("n"))
    w = Window.partitionBy(item)
    share = F.col("n") / F.sum("n").over(w)
    return n.withColumn("share", share).withColumn("mixed", F.max("share").over(w) < dominant)


def union(rows: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def qc_report(checks: DataFrame) -> DataFrame:
    """table, status, n_checks, n_affected."""
    return checks.groupBy("table", "status").agg(F.count("*").alias("n_checks"), F.sum("n_affected").alias("n_affected"))


def validate_all(tables: dict[str, DataFrame], specs: list[TableSpec], links: list[Link], semantic: list[DataFrame]) -> DataFrame:
    """Structural checks; foreign keys and the semantic checks only if the structure is clean."""
    structure = []
    for s in specs:
        structure.append(check_schema(tables[s.name], s))
        if s.primary_key:
            structure += [check_not_null(tables[s.name], s.name, list(s.primary_key)), check_unique(tables[s.name], s.name, list(s.primary_key))]
    found = union(structure)
    if found.where("status = 'fail'").limit(1).count():
        return found
    return union([found, check_all_fks(tables, links), *semantic])
