"""Exact top-k search by inner product: term-at-a-time accumulation over whole blocks of vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.llm.shared import table

SCALE, K, EVERY = 1024, 10, 100
#: A block of queries and a tile of rows hold so many on average; a task scores so many of the one against so many of the other at a time.
BLOCK, TILE, QUERIES, ROWS = 16_384, 16_384, 256, 4096
#: A tile holds at least about so many rows where more tiles than shuffle partitions aren't needed.
LEAST = 1024


def quantized(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part, and floor(SCALE * x) of their components as [row, term]; shorter vectors end in zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    n = len(vectors)
    sizes = np.where(np.asarray(vectors.is_valid()), np.asarray(pa.compute.fill_null(pa.compute.list_value_length(vectors), 0)), 0).astype(np.int64)
    flat = (pa.array([], pa.float64()) if not n else vectors.flatten()).to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = np.full((n, int(sizes.max(initial=0))), 0.0)
    matrix[np.arange(matrix.shape[1]) < sizes[:, None]] = flat
    good = np.flatnonzero(np.isfinite(matrix).all(axis=1) & np.asarray(vectors.is_valid()))
    return good, np.floor(SCALE * matrix[good]).astype(np.int64)


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """[query, row] inner products: for each term, its postings' weights times each query's weight are added into dense score arrays."""
    out = np.zeros((len(queries), len(rows)), np.int64)
    for term in range(min(queries.shape[1], rows.shape[1])):
        asks = np.flatnonzero(queries[:, term])
        postings = np.flatnonzero(rows[:, term])
        if not len(asks) or not len(postings):
            continue
        added = queries[asks, term][:, None] * rows[postings, term]
        if len(asks) == len(queries) and len(postings) == len(rows):
            out += added
        else:
            out[np.ix_(asks, postings)] += added
    return out


def once(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows without repeated (id, vector)."""
    if len(np.unique(ids)) == len(ids):
        return ids, values
    keep = np.sort(np.unique(np.column_stack([ids, values]), axis=0, return_index=True)[1])
    return ids[keep], values[keep]


def best(found: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, id, score) of each query's k highest, ties to smaller ids, its own id left out, an id with one score counted once. Partition selection finds the score that k different ids are sure to reach, all equal to it compete by id."""
    allowed = ids[None, :] != own[:, None]
    lowest = np.iinfo(np.int64).min
    shown = np.where(allowed, found, lowest)
    take = min(k * int(np.unique(ids, return_counts=True)[1].max(initial=1)), shown.shape[1])
    bound = np.partition(shown, shown.shape[1] - take, axis=1)[:, shown.shape[1] - take]
    q, r = np.nonzero((shown >= bound[:, None]) & allowed)
    return tuple(merge(q, ids[r], shown[q, r], k))


def top_k(base: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """query_id, rank, vec_id, score of the k rows of ``base`` with the highest integer inner product for each row of ``queries``.

    Vectors that are null or hold a null or non-finite component take no part, nor do null ids. A query that repeats an id is one query; base rows with its id are its own row.
    A base row that is repeated counts once an id. An empty base or query set gives no row. Products are 64-bit integers.
    Hashes deal queries to blocks and different rows to tiles; every block meets every tile in a group of its own, of that bounded size, which keeps k rows a query. Nothing passes through the driver but two counts.
    """
    spark = base.sparkSession
    plain = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where("id is not null and v is not null")
    asked = plain(queries).dropDuplicates(["id"])
    rows = plain(base).dropDuplicates(["id", "v"])  # copies are dropped before the shuffle too, so that a row with many of them makes no large tile
    n, blocks = rows.count(), -(-asked.count() // block)
    if not n or not blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    tiles = max(-(-n // tile), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // LEAST)))
    left = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))))
    right = rows.withColumn("tile", F.pmod(F.xxhash64("id", "v"), F.lit(tiles))).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        use, weights = quantized(queries.column("v"))
        own = queries.column("id").to_numpy()[use]
        kept = [np.zeros(0, np.int64)] * 3  # query number, id, score
        for at in range(0, rows.num_rows if len(own) else 0, ROWS):
            part = rows.slice(at, ROWS)
            good, values = quantized(part.column("v"))
            ids, values = once(part.column("id").to_numpy()[good], values)
            for a in range(0, len(own) if len(ids) else 0, QUERIES):
                q, i, s = best(scores(weights[a : a + QUERIES], values), ids, own[a : a + QUERIES], k)
                kept = [np.concatenate(x) for x in zip(kept, (q + a, i, s), strict=True)]
            if len(kept[0]) > 4 * k * len(own):
                kept = merge(*kept, k)
        q, i, s = merge(*kept, k)
        return pa.table({"query_id": pa.array(own[q] if len(q) else q, pa.int64()), "vec_id": pa.array(i, pa.int64()), "score": pa.array(s, pa.int64())})

    found = left.groupBy("block", "tile").cogroup(right.groupBy("block", "tile")).applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # one shuffle by query serves both: k rows a tile and query
    ranked = found.repartition("query_id").dropDuplicates(["query_id", "vec_id", "score"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def merge(q: np.ndarray, i: np.ndarray, s: np.ndarray, k: int) -> list[np.ndarray]:
    """The k best (query, id, score) of each query, each id once."""
    order = np.lexsort((i, -s, q))
    q, i, s = q[order], i[order], s[order]
    new = np.ones(len(q), bool)
    new[1:] = (q[1:] != q[:-1]) | (i[1:] != i[:-1]) | (s[1:] != s[:-1])
    q, i, s = q[new], i[new], s[new]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return [q[keep], i[keep], s[keep]]


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "embeddings")
    return top_k(base, base.where(F.col("vec_id") % EVERY == 0))


OP5_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM e q JOIN e c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
