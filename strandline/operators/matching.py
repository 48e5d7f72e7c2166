"""Nearest matching on a score: blocks of the order settle what nothing outside can change, the rest goes on to shifted blocks."""

from __future__ import annotations

from functools import reduce
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.sums import prefix_sums
from strandline.sources.tables import persisted

#: Units of a block, which one task settles.
BLOCK = 1 << 16


def key(a: float, b: float) -> tuple[float, int]:
    """What pairs of neighbours with these scores are taken by: their distance, then a hash of the scores, so that rows of equal gaps have no direction and pairs of the same two scores go together."""
    return b - a, hash((a, b))


def settle(scores: list[float], groups: list[bool], low: dict[bool, float | None], high: dict[bool, float | None], caliper: float) -> tuple[list[tuple[int, int]], list[int]]:
    """(pairs, open units) of a run of the order. ``low`` and ``high`` are the scores of the nearest units of either group outside, None where there are none.

    The nearest two neighbours of different groups are taken from a heap, as a sequential matching would. A unit is open once something outside, or an open unit, might be nearer to it than all else: at that
    distance its fate depends on what isn't known here. Open units lie at the two ends of what is left, so each end needs only its nearest open unit of either group.
    """
    n = len(scores)
    before, after, state = [k - 1 for k in range(n)], [k + 1 if k + 1 < n else -1 for k in range(n)], [0] * n  # 0: left, 1: open, 2: taken
    near = [dict(low), dict(high)]  # by end: the score of the nearest unit of either group that is open or outside
    heap = [(*key(scores[k], scores[k + 1]), 1, k, k + 1) for k in range(n - 1) if groups[k] != groups[k + 1] and scores[k + 1] - scores[k] <= caliper]
    heapify(heap)

    def push(i: int, j: int) -> None:
        if groups[i] != groups[j] and scores[j] - scores[i] <= caliper:
            heappush(heap, (*key(scores[i], scores[j]), 1, i, j))

    def at_end(x: int, end: int) -> None:
        """x is the outermost unit that is left: when may something beyond take it? Before any pair here that has the same two scores (kinds 0 and -1 against 1)."""
        other = near[end][not groups[x]]
        if other is not None and abs(scores[x] - other) <= caliper:
            heappush(heap, (*key(*sorted((scores[x], other))), end - 1, x, x))

    if n:
        at_end(0, 0)
        at_end(n - 1, 1)
    pairs = []
    while heap:
        _, _, kind, i, j = heappop(heap)
        if kind == 1:
            if state[i] or state[j] or after[i] != j:
                continue
            pairs.append((i, j))
            state[i] = state[j] = 2
            p, q = before[i], after[j]
            if p >= 0:
                after[p] = q
            if q >= 0:
                before[q] = p
            if p >= 0 and q >= 0:
                push(p, q)
            elif q >= 0:
                at_end(q, 0)
            elif p >= 0:
                at_end(p, 1)
            continue
        end, links, back = (0, before, after) if kind == -1 else (1, after, before)
        if state[i] or links[i] >= 0:
            continue
        state[i] = 1
        near[end][groups[i]] = scores[i]
        inner = back[i]
        if inner >= 0:
            links[inner] = -1
            at_end(inner, end)
    return pairs, [k for k in range(n) if state[k] == 1]


def nearest_pairs(units: DataFrame, caliper: float, block: int, rounds: int | None) -> DataFrame:
    """treated_unit, control_unit, distance over units (_u, _t, _s)."""
    kind = units.schema["_u"].dataType.simpleString()
    left, done, n = units, [], 0
    edges = ["low_t", "low_c", "high_t", "high_c"]
    while True:
        place = F.col("cum__one") - 1 + n % 2 * (block // 2)
        at = prefix_sums(left.withColumn("_one", F.lit(1)), ["_s", "_t", "_u"], ["_one"]).select("_u", "_t", "_s", F.floor(place / block).alias("b"), (place % block).alias("_i"))
        of = lambda f, t: f(F.when(F.col("_t") == t, F.col("_s")))
        blocks = at.groupBy("b").agg(of(F.max, True).alias("low_t"), of(F.max, False).alias("low_c"), of(F.min, True).alias("high_t"), of(F.min, False).alias("high_c"))
        w = Window.orderBy("b")  # a row a block
        before, behind = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
        outside = persisted(blocks.select("b", *[F.max(c).over(before).alias(c) for c in edges[:2]], *[F.min(c).over(behind).alias(c) for c in edges[2:]]), "edges")

        def resolve(rows: pa.Table, around: pa.Table) -> pa.Table:
            rows = rows.sort_by("_i")
            low_t, low_c, high_t, high_c = (around[c][0].as_py() for c in edges)
            t, s, u = rows["_t"].to_pylist(), rows["_s"].to_pylist(), rows["_u"].combine_chunks()
            pairs, still = settle(s, t, {True: low_t, False: low_c}, {True: high_t, False: high_c}, caliper)
            pick = lambda at: u.take(pa.array(at, pa.int64()))
            columns = {
                "_u": pa.concat_arrays([pick([i if t[i] else j for i, j in pairs]), pick(still)]), "_v": pa.concat_arrays([pick([j if t[i] else i for i, j in pairs]), pa.nulls(len(still), u.type)]),
                "_t": pa.array([None] * len(pairs) + [t[k] for k in still], pa.bool_()), "_s": pa.array([None] * len(pairs) + [s[k] for k in still], pa.float64()),
                "distance": pa.array([s[j] - s[i] for i, j in pairs] + [None] * len(still), pa.float64()),
            }
            return pa.table(columns)

        found = persisted(at.groupBy("b").cogroup(outside.groupBy("b")).applyInArrow(resolve, f"_u {kind}, _v {kind}, _t boolean, _s double, distance double"), "matched")
        done.append(found.where("distance is not null").select(F.col("_u").alias("treated_unit"), F.col("_v").alias("control_unit"), "distance"))
        left = found.where("distance is null").select("_u", "_t", "_s")
        n += 1
        if left.limit(1).count() == 0:
            return reduce(DataFrame.unionByName, done)
        if n == rounds:
            raise RuntimeError(f"matching did not settle in {rounds} rounds")


def pool(df: DataFrame, unit: str, treated: str, score: str) -> DataFrame:
    cols = [F.col(unit).alias("_u"), F.col(treated).cast("boolean").alias("_t"), F.col(score).cast("double").alias("_s")]
    return persisted(df.select(*cols).where("_t is not null and _s is not null"), "match")


def match(df: DataFrame, unit: str, treated: str, score: str, caliper: float, rounds: int | None = None, block: int = BLOCK) -> DataFrame:
    """treated_unit, control_unit, distance: pairs within the caliper, always the nearest two of those left, until none is left. Units without score or group stay alone.

    Units are laid in one order by score, group and unit, where the nearest two always are neighbours; equal distances go by a hash of the two scores. A task matches a block of the order as far as nothing outside can change
    it, however long its chains of growing gaps are; open units go on to the next round, whose blocks lie across the edges of these. ``rounds`` raises where more would be needed; without it matching always settles.
    """
    return nearest_pairs(pool(df, unit, treated, score), caliper, block, rounds)


def matched_sets(df: DataFrame, unit: str, treated: str, score: str, caliper: float, k: int, block: int = BLOCK) -> DataFrame:
    """set_id (the treated unit), unit, treated, turn, distance: up to ``k`` controls for each treated unit that has one. In every turn all units matched so far take their nearest control of those left, as ``match`` does; turn is 0 for the treated unit itself."""
    left, turns = pool(df, unit, treated, score), []
    for turn in range(1, k + 1):
        pairs = persisted(nearest_pairs(left, caliper, block, None), "turn")
        turns.append(pairs.select(F.col("treated_unit").alias("set_id"), F.col("control_unit").alias("unit"), F.lit(False).alias("treated"), F.lit(turn).alias("turn"), "distance"))
        if turn == 1:
            turns.append(pairs.select(F.col("treated_unit").alias("set_id"), F.col("treated_unit").alias("unit"), F.lit(True).alias("treated"), F.lit(0).alias("turn"), F.lit(0.0).alias("distance")))
        if turn < k:
            again = left.where("_t").join(pairs.select(F.col("treated_unit").alias("_u")), "_u", "left_semi")
            left = persisted(again.unionByName(left.where("not _t").join(pairs.select(F.col("control_unit").alias("_u")), "_u", "left_anti")), "match")
    return reduce(DataFrame.unionByName, turns)
