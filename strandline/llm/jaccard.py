"""N-gram Jaccard join in the metric space of shingle sets: pivots, distance windows, exact joins of small regions, components of the links."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.llm.shared import HOT_SHARE, lookup, table, written

#: A region of at most so many documents and shingles is joined by one task; larger ones are split.
LEAF, LEAF_SHINGLES = 1024, 2_000_000
#: A region that is split takes at most so many new pivots at a time.
PIVOTS = 32
#: Words whose hashes a worker keeps.
CACHED = 500_000
_P, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit numbers."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Turns texts into sorted arrays of distinct 64-bit shingle hashes."""

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()  # bytes: lower() touches A-Z alone and split() the six ASCII white spaces
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > CACHED:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        k = min(self.words, len(h))
        n = len(h) - k + 1
        s = h[:n].copy()
        for i in range(1, k):
            s = s * _P + h[i : i + n]
        return np.unique(mixed(s, k))


class Likeness:
    """Links where 100 * intersection >= percent * union; what follows from it for sets of n elements."""

    def __init__(self, percent: int = 85, salt: int = 0):
        self.percent, self.salt = percent, salt
        share = (100 - percent) / percent
        #: Slices are that many powers of two finer, so that far more of them than ``differing`` have content; None: a shingle is a slice.
        self.finer = next((k for k, most in enumerate((0.19, 0.33, 0.55)) if share <= most), None)

    def linked(self, both: int | np.ndarray, union: int | np.ndarray) -> bool | np.ndarray:
        return 100 * both >= self.percent * union

    def ring(self, both: int, union: int) -> int:
        """The distance in whole windows of the join radius: linked sets lie in the same or in neighbouring rings around any third set."""
        return (union - both) * 100 // (union * max(100 - self.percent, 1))

    def differing(self, n: int) -> int:
        """At most so many elements differ between a set of n elements and any set that it links to."""
        return (100 - self.percent) * n // self.percent

    def sketch(self, u: np.ndarray) -> bytes:
        """A byte for each of 2**c slices of the shingle space, c the size class: a set's content there; behind it 2**(c + 1) bytes if it is keyed in the next class as well.

        Sets differ by at least as many shingles as sketches do by slices of the same class.
        """
        out = b""
        for c in self.classes(len(u)):
            slices = np.zeros(1 << c, np.uint64)
            np.add.at(slices, (mixed(u, 131) >> np.uint64(20)).astype(np.int64) & ((1 << c) - 1), mixed(u, 137))
            out += (slices >> np.uint64(56)).astype(np.uint8).tobytes()
        return out

    def classes(self, n: int) -> tuple[int, ...]:
        """The size class of n elements (a power of two), and the next one if a set within reach has it."""
        c = n.bit_length() - 1
        return (c, c + 1) if 100 * n >= self.percent << c + 1 else (c,)

    def apart(self, n: int | np.ndarray, m: int | np.ndarray) -> int | np.ndarray:
        """At most so many elements differ between linked sets of n and m elements."""
        return (n + m) * (100 - self.percent) // (100 + self.percent)

    def cells(self, u: np.ndarray) -> list[int] | None:
        """The keys under which a set meets every set that it links to; None if too few slices have content (a chance under 1e-11), so that another salt is needed.

        A set is projected onto k slices of the shingle space. Of two linked sets all but ``differing`` of the slices with content are equal, so among the
        ``differing + 1`` first slices of each, in any order that both share, there is a common one; the fullest slices come first, as they are the rarest. k goes by the set's size class (a power of two); a set within reach of the next class is keyed there as well.
        """
        n = len(u)
        if not n:
            return []
        out: list[int] = []
        for c in self.classes(n):
            if c < 4 or self.finer is None:
                keys = np.sort(mixed(u, c))
            else:
                k = np.uint64(1 << (c - 1 + self.finer + (c < 6)))
                where = (mixed(u, 97 + 1000 * self.salt) >> np.uint64(20)) % k
                order = np.argsort(where, kind="stable")
                edge = np.flatnonzero(np.r_[True, np.diff(where[order]) > 0])
                keys = mixed(np.add.reduceat(mixed(u[order], 61), edge) + where[order][edge], c)
                if len(keys) <= self.differing(n):
                    return None
                keys = keys[np.lexsort((keys, -np.diff(np.r_[edge, n])))]
            out += keys[: self.differing(n) + 1].view(np.int64).tolist()
        return out


def projected(docs: DataFrame, id_col: str, text_col: str, words: int, likeness: Likeness) -> DataFrame:
    """doc_id, n (size of the set), s1 and s2 (128 bits that stand for the set; null if empty), cells (null where the likeness needs another salt)."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                sets = [shingler.of(t) for t in part.column(1).to_pylist()]
                s1, s2 = ([int(mixed(u, salt).sum().view(np.int64)) if len(u) else None for u in sets] for salt in (7, 11))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(map(len, sets), pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array([likeness.cells(u) for u in sets], pa.list_(pa.int64()))],
                    names=["doc_id", "n", "s1", "s2", "cells"],
                )

    return docs.select(docs[id_col].cast("long").alias("i"), docs[text_col].alias("t")).mapInArrow(project, "doc_id long, n long, s1 long, s2 long, cells array<long>")


def shingle_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, words: int, likeness: Likeness) -> DataFrame:
    """doc, n, sketch, items (the sorted shingle hashes as bytes) of the documents in ``ids`` (column doc)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                sets = [shingler.of(t) for t in part.column(1).to_pylist()]
                columns = [pa.array(map(len, sets), pa.int64()), pa.array(map(likeness.sketch, sets), pa.binary()), pa.array([u.tobytes() for u in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["doc", "n", "sketch", "items"])

    texts = docs.select(docs[id_col].cast("long").alias("doc"), docs[text_col].alias("t"))
    return texts.join(ids.hint("shuffle_hash"), "doc", "left_semi").mapInArrow(make, "doc long, n long, sketch binary, items binary")


def sketches(n: int, sketch: pa.Scalar, likeness: Likeness) -> dict[int, np.ndarray]:
    """The slices of a sketch by size class."""
    raw, out = np.frombuffer(sketch.as_buffer(), np.uint8), {}
    for c in likeness.classes(n):
        out[c], raw = raw[: 1 << c], raw[1 << c :]
    return out


def maybe_linked(pairs: DataFrame, sets: DataFrame, likeness: Likeness) -> DataFrame:
    """pivot, doc, n (of doc's set), maybe: whether the sketches of pivot and doc leave it open that they link."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, m = b.column(2).to_pylist(), b.column(4).to_pylist()
            maybe = []
            for k in range(b.num_rows):
                x, p = sketches(n[k], b.column(3)[k], likeness), sketches(m[k], b.column(5)[k], likeness)
                both = x.keys() & p.keys()
                maybe.append(bool(both) and int((x[c := max(both)] != p[c]).sum()) <= likeness.apart(n[k], m[k]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(maybe, pa.bool_())], names=["pivot", "doc", "n", "maybe"])

    x, p = sets.select("doc", "n", "sketch"), sets.select(F.col("doc").alias("pivot"), F.col("n").alias("m"), F.col("sketch").alias("other"))
    return pairs.join(x, "doc").join(p, "pivot").select("pivot", "doc", "n", "sketch", "m", "other").mapInArrow(compare, "pivot long, doc long, n long, maybe boolean")


def measured(pairs: DataFrame, sets: DataFrame, likeness: Likeness) -> DataFrame:
    """pivot, doc, n (of doc's set), linked, ring: the distance to the pivot in whole windows of the join radius."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, linked, ring = [], [], []
            for k in range(b.num_rows):
                p, x = (np.frombuffer(b.column(c)[k].as_buffer(), np.uint64) for c in (2, 3))
                both = overlap(p, x)
                union = len(p) + len(x) - both
                size.append(len(x))
                linked.append(bool(likeness.linked(both, union)))
                ring.append(likeness.ring(both, union))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(size, pa.int64()), pa.array(linked, pa.bool_()), pa.array(ring, pa.int32())], names=["pivot", "doc", "n", "linked", "ring"])

    p, x = sets.select(F.col("doc").alias("pivot"), F.col("items").alias("a")), sets.select("doc", F.col("items").alias("b"))
    return pairs.join(x, "doc").join(p, "pivot").select("pivot", "doc", "a", "b").mapInArrow(measure, "pivot long, doc long, n long, linked boolean, ring int")


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct numbers."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0


def leaf_links(ids: np.ndarray, sets: list[np.ndarray], linked: np.ndarray, ring: np.ndarray, likeness: Likeness) -> list[tuple[int, int]]:
    """Links among the documents of one small region, as a forest: enough of them to connect whatever is connected.

    Documents linked to the pivot are connected already. By the triangle inequality only documents in the same or neighbouring rings can link;
    sizes bound the overlap likewise. What is left is counted exactly, all partners of a document at once, through the postings of its shingles.
    """
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    items = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), n)
    order = np.argsort(items, kind="stable")
    items, owner = items[order], owner[order]
    new = np.r_[True, items[1:] != items[:-1]]
    starts = np.flatnonzero(new)
    ends = np.r_[starts[1:], len(items)]
    which = np.empty(len(items), np.int64)
    which[order] = np.cumsum(new) - 1
    offset = np.r_[0, np.cumsum(n)]
    group = np.arange(len(sets))
    if linked.any():
        group[linked] = np.flatnonzero(linked)[0]
    found: list[tuple[int, int]] = []
    for x in np.flatnonzero(~linked):
        terms = which[offset[x] : offset[x + 1]]
        terms = terms[ends[terms] - starts[terms] > 1]
        if not len(terms):
            continue
        size = ends[terms] - starts[terms]
        at = np.repeat(starts[terms] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        both = np.bincount(owner[at], minlength=len(sets))
        near = likeness.linked(both, n + n[x] - both) & (np.abs(ring - ring[x]) <= 1)
        for y in np.flatnonzero(near & (group != group[x])):
            if group[y] != group[x]:
                found.append((int(ids[x]), int(ids[y])))
                group[group == group[y]] = group[x]
    return found


def sizes(members: DataFrame) -> DataFrame:
    """region, m, w, open: documents and shingles of each region, and whether one of them isn't linked to the first pivot."""
    return members.groupBy("region").agg(F.count("*").alias("m"), F.sum("n").alias("w"), F.max((~F.col("linked")).cast("int")).alias("open"))


def dealt(members: DataFrame, plan: DataFrame, total: int) -> DataFrame:
    """``members`` with the struct ``plan`` of their region (columns region, m, plan), null for a region without one; hot regions meet a broadcast."""
    return lookup(members, plan.select("region", "m", "plan"), ["region"], "m", total)


def blocks_of(placed: DataFrame) -> DataFrame:
    """Adds ``part`` to members with a ``plan`` (small, cuts: blocks by ring): a small region is one part. A larger one is cut by ring and hash into blocks, and the blocks of the same and of
    neighbouring rings meet two by two: each document goes to the blocks within its window, so no task grows with the region."""
    cuts = F.col("plan.cuts")
    own = F.pmod(F.xxhash64("doc"), F.element_at(cuts, F.col("ring")).cast("long")).cast("int")
    blocks = lambda ring: F.coalesce(F.element_at(cuts, ring), F.lit(0))
    steps = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    same = F.transform(steps(blocks(F.col("ring"))), lambda k: F.concat_ws(":", F.col("ring"), F.least(k, own), F.col("ring"), F.greatest(k, own)))
    lower = F.transform(steps(blocks(F.col("ring") - 1)), lambda k: F.concat_ws(":", F.col("ring") - 1, k, F.col("ring"), own))
    upper = F.transform(steps(blocks(F.col("ring") + 1)), lambda k: F.concat_ws(":", F.col("ring"), own, F.col("ring") + 1, k))
    many = F.concat(F.when(F.col("ring") > 0, same).otherwise(F.array().cast("array<string>")), lower, upper)
    return placed.withColumn("part", F.explode(F.when(F.col("plan.small"), F.array(F.lit("all"))).otherwise(many)))


def planned(members: DataFrame, leaf: int, leaf_shingles: int) -> DataFrame:
    """Members of open regions with their ``part``."""
    half = leaf // 2
    by_ring = members.groupBy("region", "ring").agg(F.greatest(F.ceil(F.count("*") / half), F.ceil(F.sum("n") / (leaf_shingles // 2))).cast("int").alias("blocks"))
    cuts = by_ring.groupBy("region").agg(F.map_from_entries(F.collect_list(F.struct("ring", "blocks"))).alias("cuts"))  # a few rings a region
    small = (F.col("m") <= leaf) & (F.col("w") <= leaf_shingles)
    plan = sizes(members).where("open = 1").join(cuts, "region").withColumn("plan", F.struct(small.alias("small"), "cuts"))
    return blocks_of(dealt(members, plan, members.count()).where("plan is not null"))


def alive(members: DataFrame, sets: DataFrame, likeness: Likeness, leaf: int, leaf_shingles: int) -> DataFrame:
    """region, doc of the members (region, doc, n, linked) whose sketches leave a link open that doesn't lead through the first pivot: within a region, one document not linked to it and any other.

    What links is never lost. What is left out are documents that met by a common passage, before any of their shingles are moved.
    """

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        n, linked = group.column("n").to_numpy(), np.asarray(group.column("linked"))
        found = np.zeros(len(n), bool)
        by_class: dict[int, tuple[list[int], list[np.ndarray]]] = {}
        for k, x in enumerate(group.column("sketch")):
            for c, slices in sketches(int(n[k]), x, likeness).items():
                by_class.setdefault(c, ([], []))[0].append(k)
                by_class[c][1].append(slices)
        for rows, slices in by_class.values():
            at, all_slices = np.array(rows), np.vstack(slices)
            for j in np.flatnonzero(~linked[at]):
                near = np.count_nonzero(all_slices != all_slices[j], axis=1) <= likeness.apart(n[at], n[at[j]])
                near[j] = False
                if near.any():
                    found[at[near]] = found[at[j]] = True
        docs = group.column("doc").filter(pa.array(found))
        return pa.table({"region": group.column("region").filter(pa.array(found)), "doc": docs})

    ringed = planned(members.withColumn("ring", F.lit(1)), leaf, leaf_shingles).select("region", "part", "doc", "linked")
    return ringed.join(sets.select("doc", "n", "sketch"), "doc").groupBy("region", "part").applyInArrow(compare, "region long, doc long").distinct()


def recursed(members: DataFrame, sets: DataFrame, likeness: Likeness, leaf: int, leaf_shingles: int) -> tuple[DataFrame, list[DataFrame]]:
    """``members`` (region, doc, n, linked, ring) with regions beyond the leaf bounds split into the Voronoi regions of new pivots, again and again.

    A region takes up to PIVOTS of its documents, by a hash, as new pivots. Each document goes to the region of its nearest pivot p, and as a boundary document to that of every pivot q with
    d(x, q) <= d(x, p) + 2 r: by the triangle inequality two linked documents then meet in the region of either's nearest pivot. A region that has no child of under 4/5 of its
    size isn't split again: ``planned`` cuts it by rings instead. Beside the members, where ``linked`` and ``ring`` now tell of the new pivot, come the links a, b to new pivots.
    """
    total = members.count()
    done, links, now, level = [], [], members.withColumn("stuck", F.lit(False)), 0
    while True:
        over = (F.col("m") > leaf) | (F.col("w") > leaf_shingles)
        big = sizes(now).where((F.col("open") == 1) & over).join(now.groupBy("region").agg(F.max("stuck").alias("stuck")), "region").where("not stuck")
        parts = F.greatest(F.ceil(F.col("m") * 2 / leaf), F.ceil(F.col("w") * 2 / leaf_shingles)).cast("int")
        big = written(big.select("region", "m", F.struct("m", parts.alias("parts")).alias("plan")), "big-regions")
        if not big.limit(1).count():
            return reduce(DataFrame.unionByName, [*done, now.drop("stuck")]), links
        level += 1
        marked = dealt(now, big, total)
        done.append(written(marked.where("plan is null").select("region", "doc", "n", "linked", "ring"), "regions"))
        split = written(marked.where("plan is not null").select("region", "doc", "linked", "plan"), "split")
        rank = F.xxhash64("doc", F.lit(level))
        # a pivot for every half leaf, chosen by hash: the smallest of each of so many hash classes
        chosen = split.groupBy("region", F.pmod(rank, F.least(F.col("plan.parts") * 2, F.lit(PIVOTS))).alias("slot")).agg(F.min(F.struct(rank.alias("h"), "doc"))["doc"].alias("doc"), F.first("plan.parts").alias("parts"))
        asked = chosen.select("region", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "doc", F.lit(None).cast("boolean").alias("linked"), F.lit(None).cast("long").alias("m"))
        rows = split.select("region", F.pmod(F.xxhash64("doc"), F.col("plan.parts")).cast("int").alias("part"), "doc", "linked", F.col("plan.m").alias("m")).unionByName(asked)

        def assign(group: pa.Table) -> pa.Table:
            group = group.combine_chunks()
            linked = group.column("linked").to_pylist()
            docs, m, region = group.column("doc").to_pylist(), group.column("m").to_pylist(), group.column("region")[0].as_py()
            items = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("items")]
            pivots = sorted((docs[k], k) for k, x in enumerate(linked) if x is None)
            out: list[tuple] = []
            for k, x in enumerate(linked):
                if x is None:
                    continue
                both = np.array([overlap(items[p], items[k]) for _, p in pivots])
                union = np.array([len(items[p]) for _, p in pivots]) + len(items[k]) - both
                far = (union - both) / union
                for q in np.flatnonzero(far <= far.min() + 2 * (1 - likeness.percent / 100) + 1e-9):
                    child = int.from_bytes(xxhash.xxh3_64_digest(f"{region}/{pivots[q][0]}"), "little", signed=True)
                    out.append((child, pivots[q][0], docs[k], len(items[k]), bool(likeness.linked(both[q], union[q])), likeness.ring(int(both[q]), int(union[q])), m[k]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int64())
            columns = list(zip(*out, strict=True)) if out else [[]] * 7
            return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["region", "pivot", "doc", "n", "linked", "ring", "before"])

        children = written(rows.join(sets.select("doc", "items"), "doc").groupBy("region", "part").applyInArrow(assign, "region long, pivot long, doc long, n long, linked boolean, ring int, before long"), "children")
        links.append(children.where("linked and pivot <> doc").select(F.col("pivot").alias("a"), F.col("doc").alias("b")))
        total = children.count()
        grown = children.groupBy("region").agg(F.count("*").alias("m"), F.first("before").alias("before")).withColumn("plan", F.struct((F.col("m") * 5 > F.col("before") * 4).alias("stuck")))
        now = written(dealt(children.drop("before", "pivot"), grown, total).select("region", "doc", "n", "linked", "ring", F.col("plan.stuck").alias("stuck")), "regions")


def region_links(members: DataFrame, sets: DataFrame, likeness: Likeness, leaf: int, leaf_shingles: int) -> DataFrame:
    """a, b: links within the regions of ``members`` (region, doc, n, linked, ring) that hold a document not linked to the first pivot; regions are split by ``recursed``, then ``planned``."""
    split, links = recursed(members, sets, likeness, leaf, leaf_shingles)
    spread = planned(split, leaf, leaf_shingles).select("region", "part", "doc", "linked", "ring")

    def join(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("items")]
        found = leaf_links(group.column("doc").to_numpy(), sets, np.asarray(group.column("linked")), group.column("ring").to_numpy(), likeness)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    inside = spread.join(sets.select("doc", "items"), "doc").groupBy("region", "part").applyInArrow(join, "a long, b long")
    return reduce(DataFrame.unionByName, [inside, *links])


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of an undirected graph given as a, b: least labels of neighbours, then labels of labels, until nothing changes."""
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        offered = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("offer"))
        lower = written(labels.join(offered, "node").select("node", "component", F.least("component", "offer").alias("next")), "labels")
        hop = lower.select(F.col("node").alias("next"), F.col("next").alias("beyond"))
        after = written(lower.join(hop, "next", "left").select("node", F.least("next", F.coalesce("beyond", "next")).alias("component"), F.col("component").alias("before")), "labels")
        labels = after.select("node", "component")
        if after.where("component <> before").limit(1).count() == 0:
            return labels


def hot_cells(real: DataFrame, every: int = 32) -> DataFrame:
    """cell: those that over 1/HOT_SHARE of a sample of the different sets have (one set in ``every``, by its hash). So their number is bounded; they steer the plan, never the result."""
    sample = real.where(F.pmod("s1", F.lit(every)) == 0).groupBy("s1", "s2").agg(F.min_by("cells", "doc_id").alias("cells"))
    seen = written(sample.select("cells"), "cell-sample")
    floor = max(seen.count() // HOT_SHARE, 8)
    return seen.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > floor).select("cell")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, percent: int = 85, leaf: int = LEAF, leaf_shingles: int = LEAF_SHINGLES) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) for every row of ``docs``; the join behind it is exact.

    A set: the distinct shingles of ``words`` lower-cased (A-Z) words; with fewer words the whole sequence; empty for a null text or one without words, and then linked with nothing.
    Rows that repeat an id count as one document; rows with a null id get a set size and a null component. Extra columns are ignored; an empty table gives no row.

    1. Equal sets become one node, its smallest id standing for it. 2. Nodes that share a cell (see ``Likeness.cells``) may link, others can't; the node with the most copies in a cell is
    its pivot (in a cell of over 1/HOT_SHARE of the sets, the smallest id), and a pivot's cells together are its region. 3. Sketches tell which nodes may link to their pivot; these are measured against it. 4. In regions with
    nodes that don't link to the pivot, sketches tell which of them may link to another; these are measured, split by new pivots where they are many, and joined by windows of distance.
    Only links that connect something are made; shingles of nodes whose sketches rule out a link aren't moved.
    """
    salt = 0
    while True:
        likeness = Likeness(percent, salt)
        base = written(projected(docs, id_col, text_col, words, likeness), "projected")
        if not base.where("n > 0 and cells is null").limit(1).count():
            break
        salt += 1
    real = base.where("n > 0 and doc_id is not null")
    nodes = written(real.groupBy("s1", "s2").agg(F.min("doc_id").alias("doc"), F.count("*").alias("copies")), "nodes")
    shown = real.groupBy("s1", "s2").agg(F.min("doc_id").alias("doc"), F.count("*").alias("copies"), F.min_by("cells", "doc_id").alias("cells"))
    cells = shown.select(F.explode("cells").alias("cell"), (-F.col("copies")).alias("order"), "doc")
    hot = hot_cells(real)
    lead = real.select(F.explode("cells").alias("cell"), "doc_id").join(F.broadcast(hot), "cell").groupBy("cell").agg(F.min("doc_id").alias("lead"))
    # rows of a hot cell know their pivot and are spread by document over the window's tasks
    cells = cells.join(F.broadcast(written(lead, "hot-cells")), "cell", "left").withColumn("spread", F.when(F.col("lead").isNotNull(), F.col("doc")))
    first = F.first("doc").over(Window.partitionBy("cell", "spread").orderBy("order", "doc").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    pairs = written(cells.withColumn("pivot", F.coalesce("lead", first)).where("pivot <> doc").select("pivot", "doc").distinct(), "pairs")
    paired = pairs.select(F.explode(F.array("pivot", "doc")).alias("doc")).distinct()
    sets = written(shingle_sets(docs, paired, id_col, text_col, words, likeness), "sets")
    told = written(maybe_linked(pairs, sets, likeness), "maybe")
    near = written(measured(told.where("maybe").select("pivot", "doc"), sets, likeness), "measured")
    members = written(told.join(near.select("pivot", "doc", "linked"), ["pivot", "doc"], "left").select(F.col("pivot").alias("region"), "doc", "n", F.coalesce("linked", F.lit(False)).alias("linked")), "members")
    living = written(alive(members, sets, likeness, leaf, leaf_shingles), "alive")
    far = measured(living.join(members.where("not linked"), ["region", "doc"]).select(F.col("region").alias("pivot"), "doc"), sets, likeness)
    known = near.where("linked").join(living.withColumnRenamed("region", "pivot"), ["pivot", "doc"], "left_semi")
    inside = region_links(written(known.unionByName(far).withColumnRenamed("pivot", "region"), "living"), sets, likeness, leaf, leaf_shingles)
    labels = components(near.where("linked").select(F.col("pivot").alias("a"), F.col("doc").alias("b")).unionByName(inside))
    found = nodes.join(labels.withColumnRenamed("node", "doc"), "doc", "left").where("copies > 1 or component is not null")
    found = found.select("s1", "s2", "copies", F.coalesce("component", "doc").alias("component"))
    rows = base.select("doc_id", "n", "s1", "s2")
    placed = lookup(rows, written(found, "components"), ["s1", "s2"], "copies", base.count())
    return placed.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, columns as they are, without those linked to a smaller id; a repeated id stays once, and rows without words or id stay.

    Only ids that go or repeat are looked up, so the texts of all others are passed on where they are.
    """
    found = written(jaccard_components(docs, id_col, text_col, words, percent).where("doc_id is not null"), "found")
    ids = found.groupBy(F.col("doc_id").alias(id_col)).agg(F.count("*").alias("_n"), (F.min("component_id") < F.first("doc_id")).alias("_goes")).where("_goes or _n > 1")
    marked = lookup(docs, ids, [id_col], "_n", found.count())
    again = marked.where("not _goes").dropDuplicates([id_col])
    return marked.where("_goes is null").select(*docs.columns).unionByName(again.select(*docs.columns))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
