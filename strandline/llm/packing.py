"""Best-fit packing of token sequences by minimum bin slack over the histogram of piece lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.llm.shared import table, written
from strandline.llm.tokens import TOKENIZER, fast_encoder, tokenizer

CAPACITY = 1024
END = 2
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_ids(name: str, text: str) -> np.ndarray:
    """Ids of a whole text as the JSON vocabulary's own library gives them, as unsigned 32-bit integers."""
    fast = fast_encoder(name) if "<|" not in text else None
    if fast is not None:
        return fast.encode_to_numpy(text, disallowed_special=())
    return np.array(tokenizer(name).encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = TOKENIZER, capacity: int = CAPACITY, end: int | None = END, with_ids: bool = False) -> DataFrame:
    """One row a piece: a text's ids and the end id, cut only if longer than ``capacity``, into full pieces after a first one that may be shorter."""
    out = PIECE + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = token_ids(name, text or "")
                if end is not None:
                    ids = np.append(ids, np.uint32(end))
                n = len(ids)
                edges = [0, *range(n % capacity or capacity, n + 1, capacity)] if n else [0, 0]
                raw = ids.astype("<u4").tobytes()
                for k, (a, z) in enumerate(zip(edges, edges[1:], strict=False)):
                    part = raw[4 * a : 4 * z]
                    rows.append((doc, k, a, z - a, zlib.crc32(part), *([part] if with_ids else [])))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=False)] if rows else [pa.array([], t) for t, _ in zip(kinds, names, strict=False)], names=names)

    return docs.select(docs[id_col].cast("long").alias("d"), docs[text_col].alias("t")).mapInArrow(cut, out)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of the available lengths (each as often as it is left) that fills ``room`` best, as counts by length.

    Bit s of ``reach`` says that some combination of the lengths so far adds up to s. A length's count is split into powers of two, so a step is one shift.
    Lengths come in falling order, so among equal fills the one with the largest parts is taken.
    """
    steps: list[tuple[int, int, int]] = []
    reach, mask = 1, (1 << (room + 1)) - 1
    for n in sorted(counts, reverse=True):
        left, chunk = min(counts[n], room // n), 1
        while left > 0:
            take = min(chunk, left)
            steps.append((reach, n, take))
            reach |= (reach << (take * n)) & mask
            left -= take
            chunk *= 2
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for before, n, take in reversed(steps):
        if not before >> at & 1:
            chosen[n] = chosen.get(n, 0) + take
            at -= n * take
    return chosen


def bin_patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Minimum bin slack: seed a bin with the largest length left, fill it as full as can be, take that combination as often as the counts allow.

    Returns (counts by length, number of such bins). Work depends on the distinct lengths (``capacity`` at most), hardly on how many pieces there are.
    """
    counts = {n: c for n, c in histogram.items() if c > 0 and n > 0}
    plan: list[tuple[dict[int, int], int]] = []
    while counts:
        seed = max(counts)
        rest = counts | {seed: counts[seed] - 1}
        used = fullest(rest, capacity - seed)
        used[seed] = used.get(seed, 0) + 1
        times = min(counts[n] // k for n, k in used.items())
        plan.append((used, times))
        for n, k in used.items():
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
    return plan


def slots(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """By length, rows (first rank, pieces of that length a bin, first sequence, offset in the bin): where the pieces of each rank go."""
    taken: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for used, times in plan:
        offset = 0
        for n in sorted(used, reverse=True):
            rows.setdefault(n, []).append((taken.get(n, 0), used[n], sequence, offset))
            taken[n] = taken.get(n, 0) + used[n] * times
            offset += n * used[n]
        sequence += times
    return {n: np.array(r, dtype=np.int64) for n, r in rows.items()}


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = TOKENIZER, capacity: int = CAPACITY, end: int | None = END, with_ids: bool = False) -> DataFrame:
    """Every document's pieces with sequence_id and offset, in as few sequences of at most ``capacity`` tokens as the heuristic finds.

    Packing depends only on how many pieces there are of each length: that histogram (``capacity`` rows at most) goes to the driver, which lays out bin patterns.
    Each piece then finds its place by its rank among the pieces of its length. Ranks come from counts by (input task, length), so no length is gathered in one task.
    A null or empty text is the end id alone; without an end id it gives no row in a sequence of its own (length 0: sequence_id null). Repeated rows are packed each.
    Null ids stay null; extra columns are ignored; an empty table gives no row.
    """
    spark = docs.sparkSession
    cut = written(pieces(docs, id_col, text_col, name, capacity, end, with_ids).withColumn("_task", F.spark_partition_id()), "pieces")
    sizes = cut.groupBy("_task", "length").count()
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    place = spark.sparkContext.broadcast(slots(bin_patterns(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    own = F.row_number().over(Window.partitionBy("_task", "length").orderBy("doc_id", "piece"))
    ranked = cut.withColumn("_own", own).join(first, ["_task", "length"]).withColumn("_rank", F.col("_before") + F.col("_own") - 1)
    columns = [*PIECE.replace(" long", "").replace(" int", "").split(", "), *(["ids"] if with_ids else [])]
    schema = PIECE + (", ids binary" if with_ids else "") + ", sequence_id long, offset long"

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            known = np.isin(length, list(place.value))
            for n in np.unique(length[known]):
                at = np.flatnonzero(length == n)
                rows = place.value[int(n)]
                row = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                k = rank[at] - row[:, 0]
                sequence[at], offset[at] = row[:, 2] + k // row[:, 1], row[:, 3] + k % row[:, 1] * n
            more = [pa.array(x, pa.int64(), mask=~known) for x in (sequence, offset)]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in columns), *more], names=[*columns, "sequence_id", "offset"])

    return ranked.select(*columns, "_rank").mapInArrow(settle, schema)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
