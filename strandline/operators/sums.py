"""Running sums by key without a task for any key, the quantiles that they give, and lookups that bear hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.sources.tables import persisted


#: Rows that a task gets where rows are dealt by their number.
TASK = 1 << 20


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` by hashes of ``keys`` in as many partitions as its ``rows`` ask for: tasks grow in number, not in size, whatever the session's shuffle partitions are. Groups and joins on the keys that follow need no further shuffle."""
    return df.repartition(rows // TASK + 1, *keys)


def same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    """Rows agree in all keys, null agreeing with null."""
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def prefix_sums(df: DataFrame, order: str | Sequence[str], columns: list[str], descending: bool = False, keys: Sequence[str] = (), totals: bool = False) -> DataFrame:
    """Adds cum_<column>: running sums in the order of ``order`` (a column or several, distinct within ``keys``), restarted for every key; with ``totals`` also all_<column>, the sum over the key.

    Rows are dealt by ranges of keys and order, so one key that holds any share of the rows spreads over many ranges. Each range is summed up on its own; only keys that lie in several ranges need offsets,
    at most two rows a range, which are broadcast. The dealt rows are written first, so both passes see the same ranges. Null keys are a key of their own.
    """
    by = [F.desc(c) if descending else F.col(c) for c in ([order] if isinstance(order, str) else order)]
    dealt = persisted(df.repartitionByRange(*keys, *by).withColumn("_part", F.spark_partition_id()), "ranges")
    of = Window.partitionBy("_part", *keys)
    own = of.orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    parts = dealt.groupBy("_part", *keys).agg(*[F.sum(c).alias(f"_t{k}") for k, c in enumerate(columns)])
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    over = parts.withColumn("_pieces", F.count("*").over(whole)).where("_pieces > 1")
    offsets = over.select("_part", *keys, *[F.coalesce(F.sum(f"_t{k}").over(before), F.lit(0)).alias(f"_o{k}") for k in range(len(columns))], *[F.sum(f"_t{k}").over(whole).alias(f"_a{k}") for k in range(len(columns)) if totals])
    run = dealt.select("*", *[F.sum(c).over(own).alias(f"_r{k}") for k, c in enumerate(columns)], *[F.sum(c).over(of).alias(f"_w{k}") for k, c in enumerate(columns) if totals])
    met = run.join(F.broadcast(offsets), same_keys(run, offsets, ["_part", *keys]), "left").select(run["*"], *[offsets[c] for c in offsets.columns if c not in ("_part", *keys)])
    sums = [(F.col(f"_r{k}") + F.coalesce(f"_o{k}", F.lit(0))).alias(f"cum_{c}") for k, c in enumerate(columns)]
    return met.select(*df.columns, *sums, *[F.coalesce(f"_a{k}", f"_w{k}").alias(f"all_{c}") for k, c in enumerate(columns) if totals])


def quantiles_of(counts: DataFrame, probs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """keys and q, the exact quantiles (linear between neighbours) of values _v that occur _n times, distinct within their keys."""
    t = prefix_sums(counts, "_v", ["_n"], keys=keys, totals=True)
    rank = [(F.col("all__n") - 1) * float(p) for p in probs]
    at = lambda r: F.max(F.when((r < F.col("cum__n")) & (r >= F.col("cum__n") - F.col("_n")), F.col("_v")))
    picks = [x for k, r in enumerate(rank) for x in (at(F.floor(r)).alias(f"_l{k}"), at(F.ceil(r)).alias(f"_h{k}"), F.max(r - F.floor(r)).alias(f"_f{k}"))]
    q = [F.when(F.col(f"_l{k}") == F.col(f"_h{k}"), F.col(f"_l{k}")).otherwise((1 - F.col(f"_f{k}")) * F.col(f"_l{k}") + F.col(f"_f{k}") * F.col(f"_h{k}")) for k in range(len(rank))]
    return t.groupBy(*keys).agg(*picks).select(*keys, F.array(*q).alias("q"))


def quantiles(df: DataFrame, value: str | Column, probs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """keys and q: exact quantiles (linear between neighbours) of the values not null, one row a key that has any. Values are counted, and a quantile is read off at a running count: no key's values meet in one task."""
    v = F.col(value) if isinstance(value, str) else value
    return quantiles_of(df.select(*keys, v.cast("double").alias("_v")).where("_v is not null").groupBy(*keys, "_v").agg(F.count("*").alias("_n")), probs, keys)


def column_quantiles(df: DataFrame, cols: list[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Exact quantiles of each column, in one pass over all of them; a column without values is left out. One row a column reaches the driver."""
    each = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("x")).select("x.*")
    return {r["column"]: list(r["q"]) for r in quantiles(each, "v", probs, ["column"]).collect()}


def with_quantiles(groups: DataFrame, df: DataFrame, value: str | Column, probs: Sequence[float], keys: Sequence[str], name: str = "q") -> DataFrame:
    """``groups`` (a row a key) with the array ``name`` of quantiles of ``df``'s values, null for a key without any."""
    q = quantiles(df, value, probs, keys).withColumnRenamed("q", name)
    if not keys:
        return groups.crossJoin(F.broadcast(q.agg(F.first(name).alias(name))))  # one row each
    return groups.join(q, same_keys(groups, q, keys), "left").select(groups["*"], q[name])


#: A key is hot when it holds over 1/HOT_SHARE of all rows, so there are never more than HOT_SHARE hot keys to broadcast.
HOT_SHARE = 1000


def lookup(df: DataFrame, found: DataFrame, keys: Sequence[str], rows: str) -> DataFrame:
    """``df`` joined to ``found``, which has one row for every key of ``df``; its column ``rows`` counts the key's rows in ``df``. Rows of hot keys meet a broadcast, the others are shuffled: no key fills a task. Keys aren't null."""
    gets = [c for c in found.columns if c not in keys and c != rows]
    found = persisted(found, "lookup")
    total = found.agg(F.sum(rows)).first()[0] or 0
    hot = F.col(rows) * HOT_SHARE > total
    met = df.join(F.broadcast(found.where(hot).select(*keys, F.struct(*gets).alias("_hot"))), list(keys), "left")
    cold = met.where("_hot is null").drop("_hot").join(found.where(~hot).drop(rows), list(keys))
    return cold.unionByName(met.where("_hot is not null").select(*df.columns, *[F.col("_hot")[c].alias(c) for c in gets]))
