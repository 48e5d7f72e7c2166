"""Truncated singular values of sparse row-by-code tables by block Krylov iteration; nothing as large as codes by codes is ever made, and no task or driver holds all codes or all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.sums import prefix_sums
from strandline.sources.tables import checkpointed, persisted

#: Codes of a tile: a block of vectors is stored in tiles of whole codes.
TILE = 1 << 14
#: Entries of a part: rows are dealt to parts by ranges, a row with more entries is split by tiles of codes.
PART = 1 << 20
#: Tiles that a task gets.
DEAL = 4
#: A pass moves this many rows of vectors for each code at most (or PART rows, if that is more), and no part gets over HOLD numbers; where parts ask for more, a block's vectors go in turns.
MOVE, HOLD = 4, 1 << 23
#: Pairs of a part that are multiplied at once.
ONCE = 1 << 16


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


def _matrix(data, columns: int) -> np.ndarray:
    return np.frombuffer(data, np.float64).reshape(-1, columns)


def _packed(values: np.ndarray) -> pa.Array:
    """One cell; places and values take a third of their bytes so."""
    return pa.array([pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)], pa.binary())


def _unpacked(cell, n: int, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(cell, n * np.dtype(kind).itemsize, codec="zstd"), kind)


def _cells(table: pa.Table, name: str) -> list:
    """Buffers of a binary column, not copied."""
    return [x.as_buffer() for chunk in table.column(name).chunks for x in chunk]


def _sum_by(at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places and the sums of their rows of values."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[starts], np.add.reduceat(values[order], starts, axis=0)


@contextmanager
def _set(spark, name: str, value: str) -> Iterator[None]:
    """A setting of the session, put back afterwards."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class _Block(NamedTuple):
    """Orthonormal vectors over codes, as what a pass gave and the small matrices that make the vectors of it and of the blocks before; so a block is written once."""

    stored: DataFrame
    columns: int
    steps: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    width: int


class _Blocks:
    """Tables (tile, m) of which m holds the tile's codes by vectors as doubles; they lie in the shared folder by tile, so that they meet without a shuffle."""

    def __init__(self, n_codes: int):
        self.n_codes, self.tiles = n_codes, -(-n_codes // TILE)
        self.tasks = self.tiles // DEAL + 2  # of one partition no key is known

    def keep(self, df: DataFrame, tasks: int | None = None, key: str = "tile") -> DataFrame:
        """``df`` by ``key`` in the shared folder, without its lineage. A checkpoint keeps what is known of its partitions, if the plan isn't an adaptive one."""
        with _set(df.sparkSession, "spark.sql.adaptive.enabled", "false"):
            return checkpointed(df.repartition(tasks or self.tasks, key))

    def together(self, tables: list[DataFrame]) -> DataFrame:
        """(tile, m0, m1, ...)."""
        first, *rest = [b.select("tile", F.col("m").alias(f"m{j}")) for j, b in enumerate(tables)]
        return reduce(lambda a, b: a.join(b.hint("merge"), "tile"), rest, first)

    def vectors(self, blocks: list[_Block]) -> Callable[[list], np.ndarray]:
        """A function of a tile's cells m0, m1, ... that gives the vectors of all ``blocks``."""
        columns, steps, ends = [b.columns for b in blocks], [b.steps for b in blocks], np.cumsum([0, *[b.width for b in blocks]]).tolist()

        def made(cells: list) -> np.ndarray:
            every = [_matrix(m, w) for m, w in zip(cells, columns, strict=True)]
            out = np.empty((len(every[0]) if every else 0, ends[-1]))
            for m, (g, turn, g2, last), a, b in zip(every, steps, ends[:-1], ends[1:], strict=True):
                k = out[:, :a]
                out[:, a:b] = ((m - k @ g) @ turn - k @ g2) @ last
            return out

        return made

    def each(self, blocks: list[_Block], new: DataFrame | None, columns: int, step: Callable, schema: str) -> DataFrame:
        """``step`` over an iterator of (tile, basis, new) of a task's tiles; it gives record batches. Without ``new`` it gets none."""
        n, made = len(blocks), self.vectors(blocks)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def tiles():
                for b in batches:
                    for r in range(b.num_rows):
                        cells = [b.column(f"m{j}")[r].as_buffer() for j in range(b.num_columns - 1)]
                        now = _matrix(cells[n], columns) if n < len(cells) else None
                        yield b.column("tile")[r].as_py(), made(cells[:n]) if n else np.zeros((len(now), 0)), now

            yield from step(tiles())

        return self.together([b.stored for b in blocks] + ([] if new is None else [new])).mapInArrow(run, schema)

    def gathered(self, blocks: list[_Block], new: DataFrame, columns: int, begin: Callable, add: Callable) -> list[np.ndarray]:
        """One small matrix for each task: begin() carried on by add(matrix, basis, new)."""

        def step(tiles):
            out = begin()
            for _, basis, now in tiles:
                out = add(out, basis, now)
            yield _batch(rows=pa.array([len(out)], pa.int32()), m=pa.array([np.ascontiguousarray(out).tobytes()], pa.binary()))

        got = self.each(blocks, new, columns, step, "rows int, m binary").collect()
        return [np.frombuffer(r["m"], np.float64).reshape(r["rows"], -1) for r in got if r["rows"]]


def _products(at: _Blocks, blocks: list[_Block], new: DataFrame, columns: int) -> np.ndarray:
    """Products of the basis, and of ``new`` below it, with ``new``."""
    wide = sum(b.width for b in blocks)
    return sum(at.gathered(blocks, new, columns, lambda: np.zeros((wide + columns, columns)), lambda out, k, w: out + np.column_stack([k, w]).T @ w))


def _orthonormal(at: _Blocks, blocks: list[_Block], new: DataFrame, columns: int, most: int) -> tuple[_Block | None, np.ndarray]:
    """(block, products of the basis with ``new``): the span of ``new`` that is orthogonal to the basis, at most ``most`` vectors. Directions under 1e-12 of the largest are rounding and go."""
    wide = sum(b.width for b in blocks)
    gram = _products(at, blocks, new, columns)
    g, size = gram[:wide], np.sqrt(max(np.trace(gram[wide:]), 0))
    if most <= 0 or not size:
        return None, g
    top = np.linalg.qr(np.vstack(at.gathered(blocks, new, columns, lambda: np.zeros((columns, columns)), lambda r, k, w: np.linalg.qr(np.vstack([r, w - k @ g]), mode="r"))), mode="r")
    _, s, vt = np.linalg.svd(top)
    keep = int((s > 1e-12 * size).sum())
    width = min(keep, most)
    if not width:
        return None, g
    # as a QR of the columns in their order would: where only some find room, the first ones do
    turn = vt[:keep].T / s[:keep] if keep < columns or width == columns else np.linalg.inv(top)[:, :width]
    turn = turn[:, :width]
    both = sum(at.gathered(blocks, new, columns, lambda: np.zeros((wide + width, width)), lambda out, k, w: out + np.column_stack([k, (w - k @ g) @ turn]).T @ ((w - k @ g) @ turn)))
    g2 = both[:wide]
    last = np.linalg.inv(np.linalg.cholesky(both[wide:] - g2.T @ g2)).T
    return _Block(new, columns, (g, turn, g2, last), width), g


def sparse_svd(pairs: DataFrame, row: str, code: str, value: str, k: int, steps: int = 6, extra: int = 10, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(component, sigma, share of the squared total) and (code, component, loading) of the ``k`` largest singular values of the table of (row, code, value); repeated pairs add up, nulls are left out.

    A pass multiplies a block of k + extra vectors over codes by the table and back; ``steps`` such blocks span the Krylov space in which the small problem is solved. Rows are dealt to parts of about PART entries by ranges, in the one shuffle that all entries go through,
    and a part gets the vectors' rows of its own codes only and returns their sums. Where parts share few codes, a block's vectors go in turns, so a pass moves MOVE rows of vectors for each code at most at once, whatever the order of the keys. A row with over PART entries is summed tile of codes by tile of codes.
    What a pass gives is written once, in tiles of TILE codes; the vectors are made of it where they are read. A job's shuffled files go when it ends. Matrices of the width of the basis reach the driver, one for each task. Signs: the largest loading of a component is positive.
    """
    spark = pairs.sparkSession
    with _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):  # a job's shuffled files go with it, not when the driver's heap happens to be collected
        return _sparse_svd(spark, pairs.select(F.col(row).alias("r"), F.col(code).cast("string").alias("c"), F.col(value).cast("double").alias("v")).dropna(), k, steps, extra, seed)


def _sparse_svd(spark, entries: DataFrame, k: int, steps: int, extra: int, seed: int) -> tuple[DataFrame, DataFrame]:
    kinds = "component int, sigma double, share double", "code string, component int, loading double"
    parts = _parts(entries)
    if parts is None:
        return spark.createDataFrame([], kinds[0]), spark.createDataFrame([], kinds[1])
    packed, long, n_parts = parts
    square = packed.agg(F.sum("square")).first()[0] or 0
    named = packed.select("part", F.posexplode("own").alias("first", "c"))
    names = named.select("c")
    if long is not None:
        square += long.agg(F.sum(F.col("v") * F.col("v"))).first()[0]
        names = names.unionByName(long.select("c"))
    codes = persisted(prefix_sums(names.distinct().withColumn("one", F.lit(1)), "c", ["one"]).select("c", (F.col("cum_one") - 1).alias("i")), "codes")
    n_codes = codes.count()
    block = min(k + extra, n_codes)
    width = min(block * (steps + 1), n_codes)
    at = _Blocks(n_codes)
    multiply = _product(at, packed, n_parts, named.join(codes, "c").select("part", "first", "i"), None if long is None else long.join(codes, "c").select("r", "i", "v"))
    q, _ = _orthonormal(at, [], _drawn(at, spark, block, seed), block, block)
    blocks, wide = [q], q.width
    small = np.zeros((width, width))
    while True:
        w = blocks[-1].width
        new = multiply(blocks)
        more, g = _orthonormal(at, blocks, new, w, width - wide if len(blocks) <= steps else 0)
        small[:wide, wide - w : wide] = g
        if more is None:
            break
        blocks.append(more)
        wide += more.width
    small = np.triu(small[:wide, :wide])  # what lies below is the same by symmetry
    values, vectors = np.linalg.eigh(small + np.triu(small, 1).T)
    order = np.argsort(-values)[:k]
    sigma, turn = np.sqrt(np.maximum(values[order], 0)), vectors[:, order]
    one = spark.createDataFrame([(j, float(s), float(s * s / square) if square else None) for j, s in enumerate(sigma)], kinds[0])
    return one, _loadings(at, blocks, turn, codes)


def _parts(entries: DataFrame) -> tuple[DataFrame, DataFrame | None, int] | None:
    """(parts, entries of the rows that no part may hold, number of parts) of (r, c, v), or None without entries; entries are shuffled once. A part is one row: its codes in order, and for each pair, by rows, its code's place and value (repeated pairs are added up), and rows by their first pairs."""
    if dict(entries.dtypes)["r"] in ("double", "float"):
        entries = entries.withColumn("r", F.col("r") + F.lit(0).cast(dict(entries.dtypes)["r"]))  # 0.0 and -0.0 are one row
    slot = F.pmod(F.xxhash64("r"), F.lit(1 << 16))
    slots = persisted(entries.groupBy(slot.alias("slot")).count(), "slots")
    n, most = slots.agg(F.sum("count"), F.max("count")).first()
    if not n:
        return None
    long = None
    if most > PART:  # else no row can have so many
        full = entries.withColumn("slot", slot).join(F.broadcast(slots.where(F.col("count") > PART)), "slot", "left_semi")
        rows = persisted(full.groupBy("r").count().where(F.col("count") > PART).select("r"), "rows")  # n / PART rows at most
        if rows.count():
            long = persisted(entries.join(F.broadcast(rows), "r", "left_semi").groupBy("r", "c").agg(F.sum("v").alias("v")), "long")
            entries = entries.join(F.broadcast(rows), "r", "left_anti")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        every = [b for b in batches if b.num_rows]
        if not every:
            return
        got = pa.Table.from_batches(every)
        r = pa.concat_arrays(got.column("r").chunks).dictionary_encode().indices.to_numpy().astype(np.int64)
        c = pa.concat_arrays(got.column("c").chunks).dictionary_encode()
        order = pc.sort_indices(c.dictionary).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        pairs, v = _sum_by(r * len(order) + place[c.indices.to_numpy()], got.column("v").to_numpy())
        r = pairs // len(order)
        starts = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        own = c.dictionary.take(pa.array(order))
        cells = {"place": _packed((pairs % len(order)).astype(np.int32)), "starts": _packed(starts.astype(np.int32)), "v": _packed(v)}
        sizes = {"codes": len(order), "pairs": len(v), "rows": len(starts)}
        yield _batch(part=pa.array([TaskContext.get().partitionId()], pa.int32()), own=pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own), square=pa.array([float(v @ v)]), **{x: pa.array([y], pa.int32()) for x, y in sizes.items()}, **cells)

    parts = n // PART + 1
    schema = "part int, own array<string>, square double, codes int, pairs int, rows int, place binary, starts binary, v binary"
    return persisted(entries.repartitionByRange(parts, "r").mapInArrow(pack, schema), "parts"), long, parts


def _drawn(at: _Blocks, spark, block: int, seed: int) -> DataFrame:
    """The start, normal numbers in the order of codes. They are one stream, so they don't depend on tiles or tasks: a task runs through it up to its own tiles, tile by tile."""
    n_codes, tile = at.n_codes, TILE

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, done = np.random.default_rng(seed), 0
        for b in batches:
            for t in b.column(0).to_pylist():
                while done <= t:
                    m = stream.normal(size=(min(tile, n_codes - done * tile), block))
                    done += 1
                yield _batch(tile=pa.array([t], pa.int32()), m=pa.array([m.tobytes()], pa.binary()))

    return at.keep(spark.range(0, at.tiles, 1, min(at.tasks, 64)).mapInArrow(draw, "tile int, m binary"))


def _product(at: _Blocks, packed: DataFrame, parts: int, places: DataFrame, far: DataFrame | None) -> Callable[[list[_Block]], DataFrame]:
    """A function that gives A'A q of the last block q, of the parts and of the rows ``far`` that no part holds; ``places`` tells the number of each code of a part."""
    tile, once = TILE, ONCE

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Codes of a tile and a part, which follow one another in both."""
        for b in batches:
            t, part, first, i = (b.column(c).to_numpy() for c in ("tile", "part", "first", "i"))
            edges = np.concatenate([np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (part[1:] != part[:-1])])), [len(t)]]) if len(t) else []
            for a, z in zip(edges[:-1], edges[1:], strict=True):
                yield _batch(tile=t[a : a + 1], part=part[a : a + 1], first=first[a : a + 1], at=pa.array([(i[a:z] - int(t[a]) * tile).astype(np.int32).tobytes()], pa.binary()))

    sorted_ = places.withColumn("tile", F.expr(f"int(i div {tile})")).repartition(at.tasks, "tile").sortWithinPartitions("tile", "part", "first")
    asked = at.keep(sorted_.mapInArrow(runs, "tile int, part int, first int, at binary"))
    moved, most = packed.agg(F.sum(F.col("codes").cast("long")), F.max("codes")).first()
    packed = at.keep(packed.drop("own", "square"), parts, "part")
    split, n_long = None, 0
    if far is not None:
        long = far.select("r").distinct()  # n / PART rows at most
        number = persisted(prefix_sums(long.withColumn("one", F.lit(1)), "r", ["one"]).select("r", (F.col("cum_one") - 1).cast("int").alias("h")), "long")
        n_long = number.count()

        def pack_long(key, got):
            i = got.column("i").to_numpy() - key[0].as_py() * tile
            return pa.table({"tile": pa.array([key[0].as_py()], pa.int32()), **{c: pa.array([x.tobytes()], pa.binary()) for c, x in (("h", got.column("h").to_numpy()), ("at", i.astype(np.int32)), ("v", got.column("v").to_numpy()))}})

        each = far.join(F.broadcast(number), "r").select(F.expr(f"int(i div {tile})").alias("tile"), "h", "i", "v")  # a tile's codes by n / PART rows at most
        split = at.keep(each.groupBy("tile").applyInArrow(pack_long, "tile int, h binary, at binary, v binary"))

    def columns(blocks: list[_Block], a: int, z: int) -> DataFrame:
        """A'A of the columns a to z of the last block, not written yet."""
        made, n, back, w = at.vectors(blocks), len(blocks), blocks[-1].width, z - a

        def q_of(tiles: pa.Table) -> np.ndarray:
            return np.ascontiguousarray(made([_cells(tiles, f"m{j}")[0] for j in range(n)])[:, -back:][:, a:z])

        def cut(tiles: pa.Table, asked: pa.Table) -> pa.Table:
            """Each part's rows of the tile, which no part may hold."""
            m = q_of(tiles) if asked.num_rows else None
            rows = [m[np.frombuffer(x, np.int32)].tobytes() for x in _cells(asked, "at")]
            return pa.table({**{c: asked.column(c) for c in ("part", "tile", "first", "at")}, "m": pa.array(rows, pa.binary())})

        def through(packed: pa.Table, given: pa.Table) -> pa.Table:
            """The part's share of A'A q, by tiles."""
            codes, pairs, rows = (packed.column(c)[0].as_py() for c in ("codes", "pairs", "rows"))
            place, starts, v = (_unpacked(_cells(packed, c)[0], size, kind) for c, size, kind in (("place", pairs, np.int32), ("starts", rows, np.int32), ("v", pairs, np.float64)))
            x, firsts = np.empty((codes, w)), given.column("first").to_pylist()
            for first, m in zip(firsts, _cells(given, "m"), strict=True):
                m = _matrix(m, w)
                x[first : first + len(m)] = m
            out = np.zeros((codes, w))
            heads = np.searchsorted(starts, np.arange(0, pairs, once))  # rows are taken whole, about ``once`` pairs at a time
            for a, z in zip(heads, [*heads[1:], rows], strict=True):
                if a < z:
                    here = slice(starts[a], starts[z] if z < rows else pairs)
                    p, u, s = place[here], v[here, None], starts[a:z] - starts[a]
                    y = np.add.reduceat(x[p] * u, s, axis=0)
                    to, sums = _sum_by(p, y[np.repeat(np.arange(z - a), np.diff(np.append(s, len(p))))] * u)
                    out[to] += sums
            return pa.table({"tile": given.column("tile"), "at": given.column("at"), "m": pa.array([out[first : first + len(m) // 4].tobytes() for first, m in zip(firsts, _cells(given, "at"), strict=True)], pa.binary())})

        n_codes = at.n_codes

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Pieces, sorted by tile, to tiles."""
            now, out = None, None
            for b in batches:
                for t, places, m in zip(b.column("tile").to_pylist(), b.column("at"), b.column("m"), strict=True):
                    if t != now:
                        if now is not None:
                            yield _batch(tile=pa.array([now], pa.int32()), m=pa.array([out.tobytes()], pa.binary()))
                        now, out = t, np.zeros((min(tile, n_codes - t * tile), w))
                    out[np.frombuffer(places.as_buffer(), np.int32)] += _matrix(m.as_buffer(), w)  # a piece's places are distinct
            if now is not None:
                yield _batch(tile=pa.array([now], pa.int32()), m=pa.array([out.tobytes()], pa.binary()))

        q = at.together([b.stored for b in blocks])
        given = q.groupBy("tile").cogroup(asked.groupBy("tile")).applyInArrow(lambda a, b: cut(a, b), "part int, tile int, first int, at binary, m binary")
        pieces = packed.groupBy("part").cogroup(given.groupBy("part")).applyInArrow(lambda a, b: through(a, b), "tile int, at binary, m binary")
        if split is not None:
            pieces = pieces.unionByName(_split_product(q, q_of, w, split, n_long))
        return pieces.repartition(at.tasks, "tile").sortWithinPartitions("tile").mapInArrow(add, "tile int, m binary")

    def multiply(blocks: list[_Block]) -> DataFrame:
        w = blocks[-1].width
        turns = max(1, min(w, max(-(-(moved or 0) // max(MOVE * at.n_codes, PART)), -(-(most or 0) * w // HOLD))))
        cuts = [w * j // turns for j in range(turns + 1)]
        got = [at.keep(columns(blocks, a, z)) for a, z in zip(cuts[:-1], cuts[1:], strict=True)]
        if turns == 1:
            return got[0]
        widths = np.diff(cuts).tolist()

        def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in range(b.num_rows):
                    m = np.column_stack([_matrix(b.column(f"m{j}")[r].as_buffer(), x) for j, x in enumerate(widths)])
                    yield _batch(tile=pa.array([b.column("tile")[r].as_py()], pa.int32()), m=pa.array([m.tobytes()], pa.binary()))

        return at.keep(at.together(got).mapInArrow(joined, "tile int, m binary"))

    return multiply


def _split_product(q: DataFrame, q_of: Callable[[pa.Table], np.ndarray], w: int, split: DataFrame, n_long: int) -> DataFrame:
    """Pieces of A'A q of the rows that no part holds whole: their sums by tile come together first, n_long by w numbers."""

    def entries(given: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(np.frombuffer(_cells(given, c)[0], t) for c, t in (("h", np.int32), ("at", np.int32), ("v", np.float64)))

    def ahead(tiles: pa.Table, given: pa.Table) -> pa.Table:
        if not given.num_rows:
            return pa.table({"h": pa.array([], pa.int32()), **{f"y{j}": pa.array([], pa.float64()) for j in range(w)}})
        h, places, v = entries(given)
        rows, y = _sum_by(h, q_of(tiles)[places] * v[:, None])
        return pa.table({"h": pa.array(rows, pa.int32()), **{f"y{j}": pa.array(y[:, j]) for j in range(w)}})

    got = q.groupBy("tile").cogroup(split.groupBy("tile")).applyInArrow(lambda a, b: ahead(a, b), ", ".join(["h int", *[f"y{j} double" for j in range(w)]])).groupBy("h").agg(*[F.sum(f"y{j}").alias(f"y{j}") for j in range(w)]).toArrow()
    y = np.zeros((n_long, w))
    y[got["h"].to_numpy()] = np.column_stack([got[f"y{j}"].to_numpy() for j in range(w)])

    def back(key, given):
        h, places, v = entries(given)
        codes, m = _sum_by(places, y[h] * v[:, None])
        return pa.table({"tile": pa.array([key[0].as_py()], pa.int32()), "at": pa.array([codes.tobytes()], pa.binary()), "m": pa.array([m.tobytes()], pa.binary())})

    return split.groupBy("tile").applyInArrow(back, "tile int, at binary, m binary")


def _loadings(at: _Blocks, blocks: list[_Block], turn: np.ndarray, codes: DataFrame) -> DataFrame:
    """(code, component, loading), signed so that a component's first largest loading is positive."""
    k, tile = turn.shape[1], TILE

    def largest(tiles):
        """For each component the largest size, where, and the sign there."""
        best = np.zeros((3, k))
        for t, basis, _ in tiles:
            v = basis @ turn
            row = np.abs(v).argmax(axis=0)
            found = np.vstack([np.abs(v)[row, np.arange(k)], t * tile + row, np.sign(v[row, np.arange(k)])])
            best = np.where((found[0] > best[0]) | ((found[0] == best[0]) & (found[1] < best[1])), found, best)
        yield _batch(m=pa.array([best.tobytes()], pa.binary()))

    found = np.stack([np.frombuffer(r["m"], np.float64).reshape(3, k) for r in at.each(blocks, None, 0, largest, "m binary").collect()])
    sign = np.array([min(((-size, place, s) for size, place, s in found[:, :, j] if size), default=(0, 0, 1))[2] for j in range(k)])

    def spread(tiles):
        for t, basis, _ in tiles:
            v = basis @ turn * sign
            yield _batch(i=np.repeat(np.arange(t * tile, t * tile + len(v)), k), component=pa.array(np.tile(np.arange(k), len(v)), pa.int32()), loading=v.ravel())

    return at.each(blocks, None, 0, spread, "i long, component int, loading double").join(codes, "i").select(F.col("c").alias("code"), "component", "loading")
