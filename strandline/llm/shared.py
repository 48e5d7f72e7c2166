"""What several operators of this subpackage need: written tables, lookups that bear hot keys, words."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: space and the five ASCII controls from tab to carriage return. ``bytes.split()`` splits on the same six.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a session in one process may name none, as in tests, and gets a local one."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="strandline-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage and outlives executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: str) -> Column:
    """Number of words of a text column; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


#: A table of at most so many rows is broadcast whole.
SMALL = 50_000
#: A key is hot when it holds over 1/HOT_SHARE of all rows, so there are never more than HOT_SHARE hot keys: that bounds what is broadcast beyond SMALL.
HOT_SHARE = 1000


def lookup(df: DataFrame, found: DataFrame, keys: list[str], rows: str, total: int, small: int = SMALL) -> DataFrame:
    """``df`` left-joined to ``found`` (one row a key; its column ``rows`` counts the rows of ``df`` with that key) without a hot task.

    If ``found`` has over ``small`` rows, rows of hot keys meet a broadcast of HOT_SHARE rows at most and the others are shuffled. Null keys match nothing.
    """
    gets = [c for c in found.columns if c not in keys and c != rows]
    if found.limit(small + 1).count() <= small:
        return df.join(F.broadcast(found.drop(rows)), keys, "left")
    floor = max(total // HOT_SHARE, 1000)
    hot = found.where(F.col(rows) > floor).select(*keys, F.struct(*gets).alias("_hot"))
    cold = found.where(F.col(rows) <= floor).select(*keys, *gets)
    met = df.join(F.broadcast(hot), keys, "left")
    plain = met.where(F.col("_hot").isNull()).drop("_hot").join(cold, keys, "left")
    return plain.unionByName(met.where(F.col("_hot").isNotNull()).select(*df.columns, *[F.col("_hot")[c].alias(c) for c in gets]))
