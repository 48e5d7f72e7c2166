"""Benchmark decontamination: winnowed fingerprints of benchmark items and documents meet, hits extend to whole windows, windows tell which items and words are hit."""

from __future__ import annotations

import hashlib
import os
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.jaccard import mixed
from strandline.llm.shared import lookup, table, written

#: Words of a window, and of the k-grams whose minimum is its fingerprint: the guarantee is a window, whatever lies around it.
WINDOW, GRAM = 10, 5
#: Bytes that are hashed at a time; a text is cut between words.
BLOCK = 1 << 20
#: Texts that a task looks at together.
SLICE = 256
#: The filter of benchmark fingerprints has so many bits at most (16 MB); beyond that more of what it lets through falls away in the join.
FILTER_BITS = 1 << 27

_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_IS_WORD = ((_LOWER >= 48) & (_LOWER <= 57)) | ((_LOWER >= 97) & (_LOWER <= 122)) | (_LOWER >= 128)
_CODE = mixed(_BYTES.astype(np.uint64), 7)
_BASE = 0x9E3779B97F4A7C15


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, for as many bytes as were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            grown = lambda b: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)]), dtype=np.uint64)
            self.up, self.down = grown(_BASE), grown(pow(_BASE, -1, 2**64))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def words_of(low: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of the words in a run of lower-case bytes; ``edges`` are the places where one text ends and the next begins."""
    inside = _IS_WORD[low]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = edges[(edges > 0) & (edges < len(low))]
    first[cut] |= inside[cut]
    last[cut - 1] |= inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64)
    up, down = POWERS.of(len(low) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_CODE[low] * up[:-1], dtype=np.uint64)])
    return starts, ends, mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def blocks(low: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of about BLOCK bytes at the start of a text or behind a byte that is in no word."""
    at, n = 0, len(low)
    while at < n:
        to = min(at + BLOCK, n)
        if to < n:
            before = edges[np.searchsorted(edges, to, "right") - 1]
            if before > at:
                to = int(before)
            elif len(free := np.flatnonzero(~_IS_WORD[low[at:to]])):
                to = at + int(free[-1]) + 1
            else:
                ahead = np.flatnonzero(~_IS_WORD[low[to:]])
                later = edges[edges > to]
                to = min(to + int(ahead[0]) + 1 if len(ahead) else n, int(later[0]) if len(later) else n)
        yield at, to
        at = to


class Texts:
    """The words of a column of texts: their bytes, their hashes and the text that each lies in."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string())
        _, at, data = column.buffers()
        offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        self.low = _LOWER[raw[offsets[0] : offsets[-1]]]
        edges = offsets - offsets[0]
        parts = []
        for a, z in blocks(self.low, edges):
            s, e, h = words_of(self.low[a:z], edges - a)
            parts.append((s + a, e + a, h))
        self.starts, self.ends, self.hashes = (np.concatenate(x) if parts else np.zeros(0, t) for x, t in zip(zip(*parts) if parts else [()] * 3, (np.int64, np.int64, np.uint64)))
        self.text = np.searchsorted(edges, self.starts, "right") - 1
        self.bounds = np.searchsorted(self.starts, edges)  # a null text has no bytes and thus no words
        self.counts = np.diff(self.bounds)

    def digest(self, i: int, n: int) -> bytes:
        """Of the n words from word i on."""
        low = self.low
        return hashlib.blake2b(b" ".join(low[a:z].tobytes() for a, z in zip(self.starts[i : i + n].tolist(), self.ends[i : i + n].tolist())), digest_size=16).digest()

    def fingerprints(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For every window of n words inside one text: its first word, and its fingerprint, the least hash of its k-grams."""
        h = self.hashes
        total = len(h) - n + 1
        if total < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        k = min(n, GRAM)
        grams = np.zeros(len(h) - k + 1, np.uint64)
        for j in range(k):
            grams = grams * np.uint64(_BASE) + h[j : j + len(grams)]
        grams = mixed(grams, n)
        least = grams[:total].copy()
        for j in range(1, n - k + 1):
            np.minimum(least, grams[j : j + total], out=least)
        whole = np.flatnonzero(self.text[:total] == self.text[n - 1 :])
        return whole, least[whole]


def sliced(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return (b.slice(at, SLICE) for at in range(0, b.num_rows, SLICE))


ITEM = "item string, len int, fp long, digest binary"
FOUND = "doc_id long, n_words long, row binary, hits array<struct<len: int, fp: long, digest: binary, starts: array<int>>>"


def item_windows(items: DataFrame) -> DataFrame:
    """item (its id as text), len, fp, digest: every window of every item. An item of fewer words than a window is one window; one without words has none. A null id is the empty text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in sliced(whole)):
            texts = Texts(b.column(1))
            rows = []
            names = b.column(0).to_pylist()
            counts = texts.counts.tolist()
            for n in sorted({min(c, WINDOW) for c in counts} - {0}):
                for i, fp in zip(*(x.tolist() for x in texts.fingerprints(n))):
                    k = int(texts.text[i])
                    if min(counts[k], WINDOW) == n:
                        rows.append((names[k] or "", n, fp - (1 << 64) if fp >> 63 else fp, texts.digest(i, n)))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * 4, (pa.string(), pa.int32(), pa.int64(), pa.binary()))], ["item", "len", "fp", "digest"])

    return items.selectExpr("cast(item_id as string) as item_id", "text").mapInArrow(cut, ITEM)


def window_classes(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Windows that lie in the same items are one class, so that a passage of many items costs a document one class, not all of those items.

    Gives (len, fp, digest, class) with one row a window and (class, item) with one row for each item of a class; a class is named by its least digest.
    Sets of items are compared by their size and 128 bits of hashes, which partial sums can build.
    """
    once = windows.distinct()
    sets = once.groupBy("len", "fp", "digest").agg(F.count("*").alias("_n"), F.bit_xor(F.xxhash64("item", F.lit(1))).alias("_a"), F.bit_xor(F.xxhash64("item", F.lit(2))).alias("_b"))
    first = sets.groupBy("_n", "_a", "_b").agg(F.min(F.struct("digest", "len", "fp")).alias("_first"))
    classes = sets.join(first, ["_n", "_a", "_b"]).select("len", "fp", "digest", F.col("_first.digest").alias("class"))
    owners = once.join(first.select("_first.digest", "_first.len", "_first.fp"), ["digest", "len", "fp"], "left_semi").select(F.col("digest").alias("class"), "item")
    return classes, owners


def fingerprint_filter(windows: DataFrame) -> tuple[np.ndarray, list[int]]:
    """A bit map of fingerprints, of a bounded size, and the lengths of windows that there are."""
    fps = windows.select("fp", "len").distinct()
    lengths = sorted(r["len"] for r in fps.select("len").distinct().collect())  # WINDOW values at most
    bits = min(max(1 << (64 * fps.count()).bit_length(), 1 << 16), FILTER_BITS)
    at = fps.select(F.col("fp").bitwiseAND(bits - 1).alias("b")).select(F.shiftright("b", 6).alias("word"), F.expr("shiftleft(1L, cast(b & 63 as int))").alias("bit"))
    got = at.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # FILTER_BITS / 64 rows at most
    held = np.zeros(bits // 64, np.uint64)
    held[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return held, lengths


def document_hits(docs: DataFrame, held: np.ndarray, lengths: list[int]) -> DataFrame:
    """doc_id, n_words, and for documents with windows whose fingerprint passes the filter a row id and those windows, each once with all its places."""
    share = docs.sparkSession.sparkContext.broadcast(held)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("row", pa.binary()), ("hits", pa.list_(pa.struct([("len", pa.int32()), ("fp", pa.int64()), ("digest", pa.binary()), ("starts", pa.list_(pa.int32()))])))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = share.value
        mask = np.uint64(64 * len(bits) - 1)
        for b in (part for whole in batches for part in sliced(whole)):
            texts = Texts(b.column(1))
            found: dict[int, dict] = defaultdict(lambda: defaultdict(list))
            for n in lengths:
                at, fp = texts.fingerprints(n)
                if not len(at):
                    continue
                new = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]]))  # winnowing: neighbours share a fingerprint, which is looked up once
                slot = fp[new] & mask
                passed = np.repeat((bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1), np.diff(np.append(new, len(fp)))).astype(bool)
                for i, f in zip(at[passed].tolist(), fp[passed].astype(np.int64).tolist()):
                    k = int(texts.text[i])
                    found[k][n, f, texts.digest(i, n)].append(i - int(texts.bounds[k]))
            rows = range(b.num_rows)
            hits = [[{"len": n, "fp": f, "digest": d, "starts": s} for (n, f, d), s in found[k].items()] if k in found else [] for k in rows]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts.counts, pa.int64()), pa.array([os.urandom(16) if k in found else None for k in rows], pa.binary()), pa.array(hits, schema.field("hits").type)], schema=schema)

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(scan, FOUND)


def item_digests(sets: DataFrame, owners: DataFrame) -> DataFrame:
    """For every distinct set of classes (``sets``: its id and its classes): how many items it has and the SHA-256 of their sorted ids. Items stream in order, however many a set has."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n, sha = None, 0, hashlib.sha256()
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (pa.string(), pa.int64(), pa.string()))], ["set_id", "n_items", "items_sha256"])
        for b in batches:
            out = []
            for key, item in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if key != last:
                    if last is not None:
                        out.append((last, n, sha.hexdigest()))
                    last, n, sha = key, 0, hashlib.sha256()
                sha.update(((b"," if n else b"") + item.encode()))
                n += 1
            yield pack(out)
        if last is not None:
            yield pack([(last, n, sha.hexdigest())])

    pairs = sets.select("set_id", F.explode("classes").alias("class"))
    return pairs.join(owners, "class").select("set_id", "item").distinct().repartition("set_id").sortWithinPartitions("set_id", "item").mapInArrow(hashed, "set_id string, n_items long, items_sha256 string")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside any occurrence of an item's window), n_items, items_sha256, contaminated.

    Words are runs of lower-case letters, digits and characters beyond ASCII. A window is WINDOW words in a row, or a whole item that has fewer. Any shared window is found: it has the
    same least k-gram in both texts. Fingerprints of items make a filter of bounded size that tasks hold; what passes it extends to the windows that share that fingerprint, and these join the
    items' windows by fingerprint and the digest of their words. A window of very many documents goes through ``lookup``; items that share a passage are told apart only once for each distinct set of windows.
    Null and empty texts have no words; a null doc_id stays null; repeated rows give a row each; repeated item ids are one item, a null one is the empty text. Empty tables give no rows, or no hits.
    """
    windows = written(item_windows(items), "item-windows")
    classes, owners = window_classes(windows)
    classes, owners = written(classes, "window-classes"), written(owners, "class-items")
    scanned = written(document_hits(docs, *fingerprint_filter(windows)), "document-hits")
    each = scanned.where(F.size("hits") > 0).select("row", F.explode("hits").alias("h")).select("row", "h.*")
    known = each.groupBy("len", "fp", "digest").agg(F.count("*").alias("_rows")).join(classes, ["len", "fp", "digest"])
    known = written(known, "known-windows")
    total = known.agg(F.sum("_rows")).first()[0] or 0
    met = lookup(each, known, ["len", "fp", "digest"], "_rows", total).where(F.col("class").isNotNull())
    spans = F.flatten(F.collect_list(F.transform("starts", lambda s: F.struct(s.alias("a"), (s + F.col("len")).alias("z")))))
    # a document's own windows meet in one row, as its text does: words from where the last window ended
    rows = met.groupBy("row").agg(F.array_sort(spans).alias("s"), F.array_sort(F.collect_set("class")).alias("classes")).select(
        "row", "classes", F.sha2(F.array_join(F.transform("classes", F.hex), ","), 256).alias("set_id"),
        F.aggregate("s", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")), lambda acc, x: F.struct(F.greatest(acc["end"], x["z"]).alias("end"), (acc["n"] + F.greatest(F.lit(0), x["z"] - F.greatest(acc["end"], x["a"]))).alias("n")))["n"].alias("n_hit"),
    )
    rows = written(rows, "hit-rows")
    sets = rows.groupBy("set_id").agg(F.first("classes").alias("classes"), F.count("*").alias("_rows"))
    told = written(sets.select("set_id", "_rows").join(item_digests(sets, owners), "set_id"), "item-sets")
    told = lookup(rows.select("row", "set_id", "n_hit"), told, ["set_id"], "_rows", rows.count())
    empty = hashlib.sha256(b"").hexdigest()
    fields = lambda n, k, s: [n.alias("n_hit"), k.alias("n_items"), s.alias("items_sha256"), (n > 0).alias("contaminated")]
    clean = scanned.where(F.col("row").isNull()).select("doc_id", "n_words", *fields(F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(empty)))
    some = scanned.where(F.col("row").isNotNull()).select("doc_id", "n_words", "row").join(told, "row", "left")
    return clean.unionByName(some.select("doc_id", "n_words", *fields(F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("n_items", F.lit(0)).cast("long"), F.coalesce("items_sha256", F.lit(empty)))))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
k AS (SELECT item, least(len(w), 10) AS n, w, unnest(range(greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item, n, array_to_string(w[i + 1 : i + n], ' ') AS g FROM k),
x AS (SELECT r, n, w, unnest(range(len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n),
p AS (SELECT r, n, i, array_to_string(w[i + 1 : i + n], ' ') AS g FROM x),
h AS (SELECT p.r, p.i, p.n, g.item FROM p JOIN g USING (n, g)),
c AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT r, i, n FROM h)) GROUP BY r),
s AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN s USING (r)
"""
