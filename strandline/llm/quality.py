"""Quality rules: counts of words, symbols and repeats, and a hashed n-gram log-likelihood ratio between a trusted and the raw corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.shared import table

SPACES, SYMBOLS = "\x20\x09\x0a\x0b\x0c\x0d", "#*$%&|<>"
#: N-grams of GRAM bytes, over all the text, fall into 2 ** BITS buckets. Bytes rather than words, since most words of a text are rare in any sample that can be trusted.
GRAM, BITS = 3, 14
CHUNK = 1 << 20
#: At most so many trusted documents are learned from, and the threshold from them and as many labelled as poor; the raw counts cover all documents.
TRUSTED = 20_000
#: Where none is labelled as poor, the threshold lies below the LOW quantile of trusted documents, by WIDE times the distance from there to their median.
LOW, WIDE = 0.01, 0.5
#: Each bucket starts with so many n-grams in the corpus's overall shares, so a bucket that is hardly used says little.
PRIOR = 5
#: Trusted documents are dealt to so many folds; each is scored by what the other folds teach.
FOLDS = 10
FEWEST, REPEATED = 50, 50
SLICE = 256


def bucket_counts(text: bytes) -> np.ndarray:
    """How many n-grams of the whole text fall into each bucket; long texts are taken CHUNK bytes at a time, overlapping so that no n-gram is lost."""
    out = np.zeros(1 << BITS, np.int64)
    for at in range(0, len(text) - GRAM + 1, CHUNK):
        b = np.frombuffer(text[at : at + CHUNK + GRAM - 1], np.uint8).astype(np.uint64)
        n = len(b) - GRAM + 1
        h = b[:n].copy()
        for k in range(1, GRAM):
            h = h * np.uint64(257) + b[k : k + n]
        out += np.bincount(((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
    return out


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more in the text, its first place included."""
    n = len(words)
    if n < 4:
        return 0
    order: dict[bytes, int] = {}
    ids = np.fromiter((order.setdefault(w, len(order)) for w in words), np.int64, n)
    pair = ids[:-1] * len(order) + ids[1:]
    if len(order) ** 3 < 2**62:
        triple = pair[:-1] * len(order) + ids[2:]
    else:
        _, dense = np.unique(pair[:-1], return_inverse=True)
        triple = dense.astype(np.int64) * len(order) + ids[2:]
    _, which, count = np.unique(triple, return_inverse=True, return_counts=True)
    twice = count[which] > 1
    if not twice.any():
        return 0
    lies = np.zeros(n, bool)
    for k in range(3):
        lies[k : n - 2 + k] |= twice
    return int(lies.sum())


def measures(text: str, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            dup += line in seen
            seen.add(line)
    return len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup, repeated_words(words)


def fold(id_col: Column) -> Column:
    return F.pmod(F.xxhash64(id_col, F.lit("fold")), F.lit(FOLDS)).cast("int")


def ratio_of(good: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log p(bucket | trusted) - log p(bucket | raw), drawn to 0 by PRIOR n-grams of the overall mix in each bucket."""
    share = good.sum() / raw.sum()
    return np.log((good + PRIOR * share) / (raw + PRIOR) / share)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", trusted: int = TRUSTED) -> tuple[np.ndarray | None, float]:
    """The log-likelihood ratio of each bucket and the threshold for a document's mean; (None, 0) if no trusted document is there.

    Trusted: documents labelled quality 1 and never 0, poor: those labelled 0 and never 1; ``trusted`` of either at most, chosen by a hash of the id. Raw: all documents, whole texts.
    Each task adds up its buckets and hands on at most 2 ** BITS rows. The threshold is that of ``cut``, from those that pass the base rules; a trusted document is scored by the ratio that the other folds give.
    """
    named = labels.where("quality is not null").select(F.col(id_col).alias("i"), "quality").where("i is not null").groupBy("i").agg(F.min("quality").alias("least"), F.max("quality").alias("most"))
    some = lambda q: named.where(f"least = {q} and most = {q}").select("i").orderBy(F.xxhash64("i"), "i").limit(trusted)
    ids = some(1).withColumn("fold", fold(F.col("i")))
    names = ["raw", *(f"good{k}" for k in range(FOLDS))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((1 + FOLDS, 1 << BITS), np.int64)  # raw, and trusted of each fold
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                for text, k in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    n = bucket_counts((text or "").encode())
                    sums[0] += n
                    if k is not None:
                        sums[1 + k] += n
        at = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(pa.array(x[at]) for x in sums)], names=["b", *names])

    texts = docs.select(docs[id_col].alias("i"), docs[text_col].alias("t"))
    marked = texts.join(F.broadcast(ids), "i", "left").select("t", "fold")
    total = marked.mapInArrow(count, "b int, " + ", ".join(f"{c} long" for c in names)).groupBy("b").agg(*[F.sum(c).alias(c) for c in names]).collect()
    sums = np.zeros((1 + FOLDS, 1 << BITS))
    for r in total:
        sums[:, r["b"]] = [r[c] for c in names]
    raw, folds = sums[0], sums[1:]
    good = folds.sum(axis=0)
    if not good.sum():
        return None, 0.0
    # documents of a fold that holds all trusted ones are scored by themselves
    other = docs.sparkSession.sparkContext.broadcast([*(ratio_of(rest if (rest := good - f).sum() else good, raw) for f in folds), ratio_of(good, raw)])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(judged(t, other.value[k], 0.0), k < FOLDS) for t, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            rows = [(r[7], good) for r, good in rows if not r[5]]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.float64(), pa.bool_()))], names=["mean", "good"])

    asked = F.broadcast(ids.unionByName(some(0).withColumn("fold", F.lit(FOLDS))))
    means = texts.join(asked, "i").select("t", "fold").mapInArrow(score, "mean double, good boolean").toArrow()
    at, kind = means.column("mean").to_numpy(), np.asarray(means.column("good"), bool)
    return ratio_of(good, raw), cut(at[kind], at[~kind])


def cut(good: np.ndarray, poor: np.ndarray) -> float:
    """The threshold that keeps good and drops poor scores best, by the sum of both shares of errors; of equals, the middle of the widest gap. 0 without good scores."""
    if not len(good):
        return 0.0
    if not len(poor):
        low, mid = np.quantile(good, (LOW, 0.5))
        return float(low - WIDE * (mid - low))
    at = np.unique(np.concatenate([good, poor]))
    ends = np.r_[at[0] - 1e-9, at, at[-1] + 1e-9]
    middle = (ends[:-1] + ends[1:]) / 2
    errors = np.searchsorted(np.sort(good), middle) / len(good) + 1 - np.searchsorted(np.sort(poor), middle) / len(poor)
    return float(middle[max(np.flatnonzero(errors <= errors.min() + 1e-12), key=lambda k: ends[k + 1] - ends[k])])


def judged(text: str | None, ratio: np.ndarray | None, threshold: float) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, mean log ratio."""
    text = text or ""
    raw = text.encode()
    n = measures(text, raw.split())
    failed = n[0] < FEWEST or 100 * n[4] > REPEATED * n[0]
    mean = float(bucket_counts(raw) @ ratio) / (len(raw) - GRAM + 1) if ratio is not None and len(raw) >= GRAM else 0.0
    return *n, failed, not failed and mean >= threshold, mean


def assess(docs: DataFrame, ratio: np.ndarray | None, threshold: float = 0.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measures and the verdict of every row, whole texts.

    A null or empty text has no words and so fails the base rules. Without a trusted corpus (``ratio`` None) the base rules alone decide.
    Null ids and repeated rows give a row each; other columns are ignored; an empty table gives no row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ratio"]
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                rows = [judged(t, shared.value, threshold) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=["i", *names])

    out = "i long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, log_ratio double"
    return docs.select(docs[id_col].cast("long").alias("i"), docs[text_col].alias("t")).mapInArrow(score, out).withColumnRenamed("i", id_col)


def keep_good(docs: DataFrame, ratio: np.ndarray | None, threshold: float = 0.0, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, columns as they are, that ``assess`` keeps."""
    shared, at_text = docs.sparkSession.sparkContext.broadcast(ratio), docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                yield part.filter(pa.array([judged(t, shared.value, threshold)[6] for t in part.column(at_text).to_pylist()], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return assess(docs, *fit(docs, table(spark, sf_dir, "labels")))
