"""Merkle dataset manifest: one tree a language under one root, and for every tampered document a version of the tree that copies only the nodes on its path."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.shared import table, written

#: Children of a node, and levels that one task builds of an aligned block: 4,096 nodes.
ARITY, LEVELS = 8, 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text: bytes) -> bytes:
    return hashlib.sha256(text).hexdigest().encode()


def leaf(*fields: Column) -> Column:
    """Digest of one row, as 32 bytes: of each field its UTF-8 byte count, a colon and its value, or ``-`` for null."""
    return F.unhex(F.sha2(F.concat(*[F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in fields]).cast("binary"), 256))


def numbered(nodes: DataFrame, order: list[str], rise: int) -> DataFrame:
    """``nodes`` (``tree`` and others) with ``block`` and ``i``, their place in blocks of ARITY**rise: each tree's nodes are counted from 0 by ``order``, nulls first.

    Rows are dealt by ranges of tree and order, so a tree of any size spreads; rows that agree in all of these are alike and are spread too. A tree's count goes on over the edge of a range: one row a
    partition reaches the driver.
    """
    spark = nodes.sparkSession
    by = ["tree", *order]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n, part = None, 0, TaskContext.get().partitionId()
        for b in batches:
            at = []
            for tree in b.column(0).to_pylist():
                if tree != last:
                    last, n = tree, 0
                at.append(n)
                n += 1
            yield b.append_column("at", pa.array(at, pa.int64())).append_column("part", pa.array([part] * len(at), pa.int32()))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields)
    dealt = nodes.withColumn("_copy", F.monotonically_increasing_id()).repartitionByRange(*by, "_copy").sortWithinPartitions(*by)
    counted = written(dealt.select("tree", *[c for c in nodes.columns if c != "tree"]).mapInArrow(count, f"tree string, {kinds.replace('tree string, ', '', 1)}, at long, part int"), "counted")
    sums = counted.groupBy("part", "tree").agg(F.count("*").alias("n"))
    edges = sums.groupBy("part").agg(F.min("tree").alias("first"), F.min_by("n", "tree").alias("n_first"), F.max("tree").alias("last"), F.max_by("n", "tree").alias("n_last")).orderBy("part").collect()
    offsets, open_tree, held = [], None, 0
    for e in edges:
        before = held if e["first"] == open_tree else 0
        offsets.append((e["part"], e["first"], before))
        open_tree, held = e["last"], e["n_last"] + (before if e["first"] == e["last"] else 0)
    starts = F.broadcast(spark.createDataFrame(offsets, "part int, _first string, _before long"))
    size = ARITY**rise
    index = F.col("at") + F.when(F.col("tree") == F.col("_first"), F.col("_before")).otherwise(0)
    return counted.join(starts, "part").withColumn("_i", index).select(*nodes.columns, F.floor(F.col("_i") / size).alias("block"), (F.col("_i") % size).alias("i"))


def levels_of(block: int, digests: list[bytes], rise: int) -> list[list[bytes]]:
    """The levels of an aligned block, from its nodes to its one root. Blocks behind the first have neighbours, so they rise by ``rise`` levels, alone or not; the first ends at a single node."""
    out = [digests]
    while len(out) <= rise and (block or len(out[-1]) > 1):
        at = out[-1]
        out.append([sha(b"".join(at[k : k + ARITY])) for k in range(0, len(at), ARITY)])
    return out


def path(levels: list[list[bytes]], i: int) -> list[tuple[bytes, bytes]]:
    """What stands left and right of node i, and then of its ancestors, in their runs."""
    steps = []
    for at in levels[:-1]:
        run = i - i % ARITY
        steps.append((b"".join(at[run:i]), b"".join(at[i + 1 : run + ARITY])))
        i //= ARITY
    return steps


def copied(digest: bytes, steps: list[tuple[bytes, bytes]]) -> list[bytes]:
    """The nodes that a version with ``digest`` in this place copies, upwards; all others are those of the tree that it starts from."""
    out = []
    for left, right in steps:
        digest = sha(left + digest + right)
        out.append(digest)
    return out


STEPS = pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))


def raised(nodes: DataFrame, rise: int) -> DataFrame:
    """tree, i, digest: the roots of the blocks, numbered by their block."""

    def root(key, rows):
        rows = rows.sort_by("i")
        top = levels_of(key[1].as_py(), [d.hex().encode() for d in rows["digest"].to_pylist()], rise)[-1][0]
        return pa.table({"tree": pa.array([key[0].as_py()], pa.string()), "i": pa.array([key[1].as_py()], pa.int64()), "digest": pa.array([bytes.fromhex(top.decode())], pa.binary())})

    return nodes.select("tree", "block", "i", "digest").groupBy("tree", "block").applyInArrow(root, "tree string, i long, digest binary")


def ladder(leaves: DataFrame, rise: int) -> tuple[list[DataFrame], DataFrame]:
    """The stored layers of all trees (``leaves``, then the block roots below them, as long as any tree has several) and the root of every tree."""
    layers, size = [leaves], ARITY**rise
    while True:
        up = written(raised(layers[-1], rise), "block-roots")
        if not up.where("i > 0").limit(1).count():
            return layers, up.select("tree", "digest")
        layers.append(up.select("tree", F.floor(F.col("i") / size).alias("block"), (F.col("i") % size).alias("i"), "digest"))


def lowered(layers: list[DataFrame], tops: DataFrame, rise: int) -> DataFrame:
    """tree, block, steps and the carried columns for the blocks of the first layer: ``tops`` (tree, steps, ...) goes down the upper layers, each node adding its own steps in front."""
    ctx = tops.withColumn("block", F.lit(0).cast("long"))
    carried = [c for c in tops.columns if c not in ("tree", "steps")]
    for layer in reversed(layers[1:]):
        kinds = ", ".join(f"{c} {tops.schema[c].dataType.simpleString()}" for c in carried)

        def below(key, rows, above):
            rows = rows.sort_by("i")
            block, n = key[1].as_py(), rows.num_rows
            levels = levels_of(block, [d.hex().encode() for d in rows["digest"].to_pylist()], rise)
            upper = above["steps"][0].as_py()
            steps = [[{"l": a.decode(), "r": z.decode()} for a, z in path(levels, i)] + upper for i in range(n)]
            size = ARITY**rise
            return pa.table({"tree": pa.array([key[0].as_py()] * n, pa.string()), "block": pa.array([block * size + i for i in range(n)], pa.int64()), "steps": pa.array(steps, STEPS), **{c: pa.concat_arrays(above[c].chunks * n) if n else above[c] for c in carried}})

        ctx = layer.groupBy("tree", "block").cogroup(ctx.groupBy("tree", "block")).applyInArrow(below, f"tree string, block long, steps array<struct<l: string, r: string>>{', ' + kinds if kinds else ''}")
        ctx = written(ctx, "block-paths")
    return ctx


RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, copies array<string>"


def manifest(docs: DataFrame, tampered: Column, text: Column, rise: int = LEVELS) -> DataFrame:
    """Per row: doc_id, leaf, its language's subroot, root, proof_sha256, folded_root, verified, copies.

    ``tampered`` tells rows that are read as if their text were ``text``. Each makes a version of the tree: ``copies`` holds the nodes that it copies, from the leaf's parent to its own root; it shares every other
    node. For other rows ``copies`` is null and the root is recomputed from the row's own leaf. Trees are built in aligned blocks of 8**``rise`` nodes, block roots in blocks again, subroots likewise; a version's upper
    copies are made where its leaf is, from the path that its block was handed down.

    Null fields are ``-``; null languages are one tree and come first, null ids come first in theirs, rows with the same id go by leaf; repeated rows are leaves of their own. An empty table gives no rows. Other columns are ignored.
    """
    string = lambda c: F.col(c).cast("string")
    fields = [string(c) for c in FIELDS]
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("1"), string("lang")), F.lit("0")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf(*fields).alias("digest"),
        F.when(tampered, leaf(*fields[:-1], text)).alias("other"),
    )
    leaves = numbered(written(leaves, "leaves"), ["doc_id", "digest"], rise)
    layers, subroots = ladder(leaves, rise)
    heads = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest"), ["of"], rise)
    upper, root = ladder(heads, rise)
    no_steps = F.array().cast("array<struct<l: string, r: string>>")
    tops = lowered(upper, root.select("tree", no_steps.alias("steps"), F.hex("digest").alias("root")), rise)

    def head_paths(key, rows, above):
        rows = rows.sort_by("i")
        digests = [d.hex().encode() for d in rows["digest"].to_pylist()]
        levels, upper_steps, n = levels_of(key[1].as_py(), digests, rise), above["steps"][0].as_py(), rows.num_rows
        steps = [[{"l": a.decode(), "r": z.decode()} for a, z in path(levels, i)] + upper_steps for i in range(n)]
        return pa.table({"tree": rows["of"], "steps": pa.array(steps, STEPS), "subroot": pa.array([d.decode() for d in digests]), "root": pa.array([above["root"][0].as_py().lower()] * n)})

    paths = heads.groupBy("tree", "block").cogroup(tops.groupBy("tree", "block")).applyInArrow(head_paths, "tree string, steps array<struct<l: string, r: string>>, subroot string, root string")
    blocks = lowered(layers, written(paths, "subroot-paths"), rise)
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_()), ("copies", pa.list_(pa.string()))])

    def proofs(key, rows, above):
        rows = rows.sort_by("i")
        digests = [d.hex().encode() for d in rows["digest"].to_pylist()]
        levels = levels_of(key[1].as_py(), digests, rise)
        upper_steps = [(s["l"].encode(), s["r"].encode()) for s in above["steps"][0].as_py()]
        rest = b"".join(a + z for a, z in upper_steps)
        subroot, top, out = above["subroot"][0].as_py(), above["root"][0].as_py(), []
        for i, (doc, own, other) in enumerate(zip(rows["doc_id"].to_pylist(), digests, rows["other"].to_pylist(), strict=True)):
            inner = path(levels, i)
            new = own if other is None else other.hex().encode()
            nodes = copied(new, inner + upper_steps)
            folded = (nodes[-1] if nodes else new).decode()
            out.append((doc, own.decode(), subroot, top, hashlib.sha256(b"".join(a + z for a, z in inner) + rest).hexdigest(), folded, folded == top, None if other is None else [x.decode() for x in nodes]))
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), schema.types)], schema=schema) if out else schema.empty_table()

    return leaves.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(proofs, RESULT)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 3 divides the checksum of the decimal doc_id, the text is read with its A-Z in lower case."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 3 == 0
    return manifest(docs, tampered, F.translate(F.col("text").cast("string"), UPPER, LOWER)).drop("copies")


def crc32_sql(text: str) -> str:
    """DuckDB has no CRC-32: the table-driven sum over the bytes of an ASCII text. Wants a CTE ``crc(tab)`` with the table."""
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"


CRC_TABLE = "crc AS (SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab FROM range(256) r(i))"


def _levels_sql(name: str, key: str, depth: int) -> str:
    """From ``{name}0(key, i, h)`` up: ``{name}l`` has the nodes of level l, ``{name}s l`` what stands left and right of each in its run; a level of one node stays as it is."""
    out = []
    for k in range(depth):
        out.append(f"{name}m{k} AS (SELECT *, count(*) OVER (PARTITION BY {key}) > 1 AS many, i // 8 AS up FROM {name}{k})")
        out.append(f"{name}{k + 1} AS (SELECT {key}, up AS i, CASE WHEN any_value(many) THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h FROM {name}m{k} GROUP BY {key}, up)")
        out.append(f"{name}s{k} AS (SELECT {key}, i, many, coalesce(string_agg(h, '') OVER (PARTITION BY {key}, up ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(h, '') OVER (PARTITION BY {key}, up ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}m{k})")
    return ",\n".join(out)


def _folds_sql(start: str, name: str, key: str, depth: int, out: str) -> str:
    """Carries x (the digest) and p (the siblings so far) of ``start`` through the levels."""
    parts, before = [], start
    for k in range(depth):
        now = f"{out}{k}"
        parts.append(f"{now} AS (SELECT f.* REPLACE (CASE WHEN many THEN sha256(l || x || r) ELSE x END AS x, CASE WHEN many THEN p || l || r ELSE p END AS p, pos // 8 AS pos) FROM {before} f JOIN {name}s{k} s ON s.{key} = f.{key} AND s.i = f.pos)")
        before = now
    return ",\n".join(parts)


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END" for c in (*FIELDS[:-1], text)) + ")"


#: Deep enough for 8**6 documents of a language and 8**2 languages.
OP12_SQL = f"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, coalesce('1' || lang, '0') AS tree, {_leaf_sql("text")} AS h, CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} END AS other FROM documents, crc),
e AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM d),
a0 AS (SELECT tree, pos AS i, h FROM e),
{_levels_sql("a", "tree", 6)},
b0 AS (SELECT 0 AS one, row_number() OVER (ORDER BY tree) - 1 AS i, h, tree FROM a6),
{_levels_sql("b", "one", 2)},
f AS (SELECT e.tree, 0 AS one, e.doc_id, e.h AS leaf, e.pos, coalesce(e.other, e.h) AS x, '' AS p FROM e),
{_folds_sql("f", "a", "tree", 6, "fa")},
g AS (SELECT fa5.* REPLACE (b0.i AS pos), b0.h AS subroot FROM fa5 JOIN b0 USING (tree)),
{_folds_sql("g", "b", "one", 2, "fb")}
SELECT doc_id, leaf, subroot, b2.h AS root, sha256(p) AS proof_sha256, x AS folded_root, x = b2.h AS verified FROM fb1, b2
"""
