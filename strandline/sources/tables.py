"""Typed reading and writing: declared schemas, column maps, rejects, bucketed layout, inventories, ledgers."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """A table's contract: declared types, keys and layout. Keys are metadata: checks read them, nothing enforces them."""

    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    subject: str | None = None
    time: str | None = None
    sort_keys: tuple[str, ...] = ()
    multiline: bool = False


@dataclass(frozen=True)
class ColumnMap:
    """rename: source name to target name; drop: source names; add: target names to be added as typed NULL."""

    rename: dict[str, str] = field(default_factory=dict)
    drop: tuple[str, ...] = ()
    add: tuple[str, ...] = ()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh path in the folder that driver and executors share; a session in one process may name none, as in tests, and gets a local one."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="strandline-")
        spark.conf.set("spark.checkpoint.dir", at)
    return f"{at.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def persisted(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, which cuts its lineage."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once, in the shared folder, without its lineage; partitions and their order stay, for steps whose results or shuffles depend on them."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(scratch(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def header_report(spark: SparkSession, spec: TableSpec, path: str) -> dict[str, list[str]]:
    """Columns of a CSV's header against the contract: missing, extra, and whether the order differs."""
    seen = spark.read.option("header", True).csv(path).columns
    wanted = spec.schema.names
    return {"missing": [c for c in wanted if c not in seen], "extra": [c for c in seen if c not in wanted], "reordered": [] if [c for c in seen if c in wanted] == [c for c in wanted if c in seen] else seen}


def read_contract(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """CSV or CSV.gz read with declared types, never sniffed; quote and escape are both a double quote, empty is NULL. A header that doesn't fit raises."""
    report = header_report(spark, spec, path)
    if any(report.values()):
        raise ValueError(f"{spec.name}: {report}")
    reader = spark.read.schema(spec.schema).option("header", True).option("quote", '"').option("escape", '"').option("nullValue", "").option("multiLine", spec.multiline)
    return reader.option("timestampFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").option("mode", "PERMISSIVE").csv(path)


def write_contract(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("quote", '"').option("escape", '"').option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)


def apply_column_map(df: DataFrame, cmap: ColumnMap, spec: TableSpec) -> DataFrame:
    """One projection onto the contract's columns; two sources for a target, unknown sources or undeclared gaps raise."""
    source_of: dict[str, str] = {}
    for c in df.columns:
        if c in cmap.drop:
            continue
        target = cmap.rename.get(c, c)
        if target not in spec.schema.names:
            raise ValueError(f"{spec.name}: unexpected column {c}")
        if target in source_of:
            raise ValueError(f"{spec.name}: {source_of[target]} and {c} both give {target}")
        source_of[target] = c
    gaps = [c for c in spec.schema.names if c not in source_of and c not in cmap.add]
    if gaps:
        raise ValueError(f"{spec.name}: missing {gaps}")
    return df.select([df[source_of[f.name]].cast(f.dataType).alias(f.name) if f.name in source_of else F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema.fields])


def split_rejects(raw: DataFrame, spec: TableSpec, max_rejects: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejects): a row is rejected if any text column doesn't cast to its declared type; rejects keep the raw values and name the columns at fault. More than ``max_rejects`` raise."""
    faults = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name)) for f in spec.schema.fields]
    marked = raw.withColumn("_faults", F.array_compact(F.array(*faults)))
    good = marked.where(F.size("_faults") == 0).select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in spec.schema.fields])
    bad = marked.where(F.size("_faults") > 0).withColumnRenamed("_faults", "faults")
    if max_rejects is not None and (n := bad.count()) > max_rejects:
        raise ValueError(f"{spec.name}: {n} rows rejected, {max_rejects} allowed")
    return good, bad


def reject_report(bad: DataFrame) -> DataFrame:
    """column, n: rejected rows by the columns at fault."""
    return bad.select(F.explode("faults").alias("column")).groupBy("column").agg(F.count("*").alias("n"))


def text_inventory(spark: SparkSession, path: str, header: str) -> DataFrame:
    """file, bytes, n_lines, content_hash, header_ok of every text file under ``path``: the hash of its lines doesn't depend on how they are read in parts; header_ok: its first line is ``header``."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_n"))
    first = F.min_by(F.when(F.col("_at") == 0, F.col("value")), F.when(F.col("_at") == 0, F.col("_n")))
    found = lines.groupBy("file", "bytes").agg(F.count("*").alias("n_lines"), F.bit_xor(F.xxhash64("value")).alias("_x"), F.sum(F.pmod(F.xxhash64("value", F.lit(1)), F.lit(2**31))).alias("_s"), first.alias("_first"))
    return found.select("file", "bytes", "n_lines", F.sha1(F.concat_ws("/", "n_lines", "_x", "_s").cast("binary")).alias("content_hash"), F.coalesce(F.col("_first") == header, F.lit(False)).alias("header_ok"))


def write_bucketed(df: DataFrame, key: str, path: str, sort: tuple[str, ...] = (), buckets: int = 100) -> None:
    """Hive partitions subject_bucket = key mod ``buckets``, sorted within each file; a rerun overwrites only the buckets it holds."""
    bucketed = df.withColumn("subject_bucket", F.pmod(F.col(key), F.lit(buckets)).cast("int"))
    laid = bucketed.repartition("subject_bucket").sortWithinPartitions("subject_bucket", *(sort or (key,)))
    laid.write.option("partitionOverwriteMode", "dynamic").option("compression", "zstd").mode("overwrite").partitionBy("subject_bucket").parquet(path)


def write_committed(df: DataFrame, key: str, path: str, source: str, sort: tuple[str, ...] = (), buckets: int = 100, sweep: int | None = None) -> list[int]:
    """As ``write_bucketed``, with a commit for each bucket once its rows have been read back and counted; gives the buckets written now.

    Buckets are written in sweeps of ``sweep`` (all at once if None), lowest first, each by one pass over the source; a broken run loses the sweep it was in, and a rerun writes the buckets without a commit.
    Commits (source, bucket, n_rows; at most a line a bucket) lie under ``path``/_commits, which readers of the table don't see. A path holds one ``source``: another raises. A sweep whose counts don't agree raises and isn't committed. A bucket without rows is committed too; a null key has no bucket and raises."""
    spark = df.sparkSession
    done = {r["bucket"]: r["source"] for r in commits(spark, path).collect()}
    if other := set(done.values()) - {source}:
        raise ValueError(f"{path} holds {sorted(other)[0]}, not {source}")
    open_ = [b for b in range(buckets) if b not in done]
    if not open_:
        return []
    bucketed = df.withColumn("subject_bucket", F.pmod(F.col(key), F.lit(buckets)).cast("int"))
    wanted = {r[0]: r[1] for r in bucketed.groupBy("subject_bucket").count().collect()}
    if None in wanted:
        raise ValueError(f"{wanted[None]} rows without {key}")
    step = sweep or len(open_)
    for at in range(0, len(open_), step):
        part = open_[at : at + step]
        rows = bucketed if len(part) == buckets else bucketed.where(F.col("subject_bucket").isin(part))
        laid = rows.repartition("subject_bucket").sortWithinPartitions("subject_bucket", *(sort or (key,)))
        laid.write.option("partitionOverwriteMode", "dynamic").option("compression", "zstd").mode("overwrite").partitionBy("subject_bucket").parquet(path)
        full = [b for b in part if wanted.get(b)]
        got = {r[0]: r[1] for r in spark.read.parquet(path).where(F.col("subject_bucket").isin(full)).groupBy("subject_bucket").count().collect()} if full else {}
        if wrong := [b for b in part if got.get(b, 0) != wanted.get(b, 0)]:
            raise ValueError(f"buckets {wrong} of {path} don't hold the rows of {source}")
        spark.createDataFrame([(source, b, wanted.get(b, 0)) for b in part], COMMIT).coalesce(1).write.mode("append").parquet(f"{path}/_commits")
    return open_


COMMIT = "source string, bucket int, n_rows long"


def commits(spark: SparkSession, path: str) -> DataFrame:
    """source, bucket, n_rows of the buckets committed under ``path``; none where nothing is there yet."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_commits")
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(COMMIT).parquet(f"{path}/_commits") if there else spark.createDataFrame([], COMMIT)


def read_committed(spark: SparkSession, path: str, buckets: list[int]) -> DataFrame:
    """The named buckets, pruned at the scan; raises if one of them isn't committed."""
    have = {r[0] for r in commits(spark, path).select("bucket").collect()}
    if lacking := sorted(set(buckets) - have):
        raise ValueError(f"buckets {lacking} of {path} are not committed")
    return spark.read.parquet(path).where(F.col("subject_bucket").isin(sorted(buckets)))


def write_dim(df: DataFrame, keys: list[str], path: str) -> None:
    """A dimension, unpartitioned and ordered by its key."""
    df.orderBy(*keys).write.option("compression", "zstd").mode("overwrite").parquet(path)


def read_buckets(spark: SparkSession, path: str, below: int | None = None) -> DataFrame:
    """The buckets under ``below`` (all if None); the filter prunes partitions."""
    df = spark.read.parquet(path)
    return df if below is None else df.where(F.col("subject_bucket") < below)


def file_inventory(spark: SparkSession, path: str, known: DataFrame | None = None) -> DataFrame:
    """Per file: path, bytes, modification time and rows; with ``known`` only files that are new or changed since."""
    meta = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"), F.col("_metadata.file_modification_time").alias("modified"))
    found = meta.groupBy("path", "bytes", "modified").agg(F.count("*").alias("n_rows"))
    return found if known is None else found.join(known, ["path", "bytes", "modified"], "left_anti")


def snapshot_id(manifest: DataFrame, cols: list[str]) -> DataFrame:
    """One row: a hash of the manifest's rows (thousands at most) whatever their order; NULL while any value is missing."""
    row = F.struct(*cols)
    ready = F.count_if(F.greatest(*[F.col(c).isNull().cast("int") for c in cols]) > 0) == 0
    return manifest.agg(F.when(ready, F.sha2(F.to_json(F.array_sort(F.collect_list(row))), 256)).alias("snapshot_id"))


def table_fingerprint(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: count, xor and sum of row hashes; independent of order and partitioning."""
    h = F.xxhash64(*cols)
    return df.select(h.alias("h")).agg(F.count("*").alias("n_rows"), F.bit_xor("h").alias("hash_xor"), F.sum(F.pmod("h", F.lit(2**31))).alias("hash_sum"))


def reconcile(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """name, expected, observed, delta, status (match, mismatch, pending, no-expectation) of row counts by table."""
    e, o = expected.select("name", F.col("n_rows").alias("expected")), observed.select("name", F.col("n_rows").alias("observed"))
    status = F.when(F.col("observed").isNull(), "pending").when(F.col("expected").isNull(), "no-expectation").when(F.col("expected") == F.col("observed"), "match").otherwise("mismatch")
    return e.join(o, "name", "full").withColumn("delta", F.col("observed") - F.col("expected")).withColumn("status", status)


def register_views(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """Registers a temporary view a table; name and whether it was there."""
    rows = []
    for name in names:
        try:
            spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)
            rows.append((name, True))
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            rows.append((name, False))
    return spark.createDataFrame(rows, "name string, registered boolean")


def append_ledger(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All JSON lines under ``path``; columns are the union over files."""
    return spark.read.json(path)


def mapped_view(df: DataFrame, mapping: dict[str, tuple[str, str]]) -> DataFrame:
    """target: (source, type). Values that don't cast become NULL, and the raw text is kept beside as target_raw."""
    out: list[Column] = []
    for target, (source, kind) in mapping.items():
        out.append(df[source].try_cast(kind).alias(target))
        if dict(df.dtypes)[source] == "string" and kind != "string":
            out.append(df[source].alias(f"{target}_raw"))
    return df.select(*out)
