"""Mixing sources to target weights: repetition rates by source, whole copies plus one hash-seeded Bernoulli copy a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.llm.shared import lookup, table, word_count, written

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
SEED = "mix-1"


def unit_hash(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 12 hex digits of an MD5, alike in any engine."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), key.cast("string"))), 1, 12), 16, 10).cast("double") / float(16**12)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """From (source, source_size), one row a source: its target by weight, none above ``most`` times its size, the excess shared again by weight.

    Sources stand in code-point order, null last; weights repeat along it. Filling up to the caps has a closed form: with sources ordered by cap / weight,
    the level after the first k are capped is (total - their caps) / weight of the rest, and the first k whose level fits the next source is the answer.
    The table holds a row a source, so its one-task windows see aggregates only.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(most)
    ratio = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    up_to = ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    filled = (
        sizes.withColumn("_w", cycle)
        .withColumn("_cap", cap.cast("double"))
        .withColumn("_ratio", F.col("_cap") / F.col("_w"))
        .withColumn("_total", F.sum("source_size").over(every).cast("double"))
        .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(up_to), F.lit(0.0))) / F.sum("_w").over(onward))
        .withColumn("_final", F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_level"))).over(every)["_level"])
    )
    target = F.least(F.col("_cap"), F.coalesce(F.col("_final"), F.lit(0.0)) * F.col("_w"))
    return filled.select("source", "source_size", "n_docs", target.alias("target"))


def mix_rates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each document's id, size, source_size, target and copies, with the columns ``keep`` beside.

    copies = floor(rate) + 1 with probability the rate's fraction, decided by a hash of the id (a null id counts as the text 'null'), so reruns agree
    and rows that repeat an id are copied alike. A null or empty text has size 0; a source of size 0 has target 0 and rate 0. A null source is a source of its own.
    """
    _source, _id = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")), docs[id_col]
    sized = docs.select(_id.alias("_id"), _source.alias("_source"), word_count(text_col).alias("_size"), *[docs[c].alias(f"_keep_{c}") for c in keep])
    sized = written(sized, "sizes") if not keep else sized
    by_source = sized.groupBy("_source").agg(F.sum("_size").alias("source_size"), F.count("*").alias("n_docs"))
    by_source = by_source.withColumn("source", F.when(F.col("_source") != "", F.substring("_source", 2, 2**31 - 1)))
    targets = written(source_targets(by_source, weights, most).withColumn("_source", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).drop("source"), "targets")
    total = targets.agg(F.sum("n_docs")).first()[0] or 0
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(0.0)
    chance = F.when(unit_hash(F.coalesce(F.col("_id").cast("string"), F.lit("null")), seed) < rate - F.floor(rate), 1).otherwise(0)
    mixed = lookup(sized, targets, ["_source"], "n_docs", total).withColumn("copies", (F.floor(rate) + chance).cast("int"))
    return mixed.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), "source_size", "target", "copies", *[F.col(f"_keep_{c}").alias(f"_keep_{c}") for c in keep])


def mix(docs: DataFrame, **params) -> DataFrame:
    """The mixed corpus: the columns of ``docs``, each document as many times as it is taken."""
    kept = mix_rates(docs, keep=tuple(docs.columns), **params).where("copies > 0")
    return kept.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*[F.col(f"_keep_{c}").alias(c) for c in docs.columns])


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_rates(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies")


OP10_SQL = r"""
WITH sized AS (SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
w AS (SELECT *, list_extract([5.0::DOUBLE, 2.0, 1.0], ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT) AS w, (source_size * 3)::DOUBLE AS cap FROM s),
l AS (SELECT *, cap / w AS ratio, (sum(source_size) OVER ())::DOUBLE AS total,
  (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(w) OVER (ORDER BY cap / w, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT coalesce(arg_min(level, ratio), 0) AS final FROM l WHERE level <= ratio),
t AS (SELECT source, source_size, least(cap, (SELECT final FROM f) * w) AS target FROM l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 3.0::DOUBLE) ELSE 0 END AS rate
  FROM sized d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, (floor(rate) + CASE WHEN ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END)::INT AS copies FROM r)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies FROM c
"""
