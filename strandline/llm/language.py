"""Language identification by unigram piece models whose segmentations are summed out."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.shared import table

VOCABULARY = "piece_bpe_32k.model"
#: Training: so many documents a language at most, with all their words, and so many rounds of EM.
SAMPLE, ROUNDS = 2_000, 3
#: Numbers that arrays of a batch hold at most, and columns of long words that are looked up at a time.
CELLS, COLUMNS = 4_000_000, 4_096
#: Training goes over to logarithms for words of more characters.
LONG = 48
#: A worker keeps the scores of about so many words, of fewer beyond 16 languages; words of a text are added up in so many at a time.
CACHED, PORTION = 400_000, 4_096
#: So many texts are scored together.
SLICE = 256
FLOOR = 1e-7
#: Words: anything but white space, digits and ASCII punctuation.
RUNS = re.compile(r"[^\s\d!-/:-@\[-`{-~]+")
_BASE, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_BITS = 19
#: Probabilities are scaled up by this when they have fallen below its inverse.
_SCALE = 1e100


def words_of(text: str) -> list[str]:
    """The words of a text as they are, of any length and script."""
    return RUNS.findall(text)


def _mixed(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(29))) * _SPREAD


class Pieces:
    """The vocabulary in an open table, to be met by rolling hashes of substrings, many words at once."""

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.keys, self.ids = np.zeros(1 << _BITS, np.uint64), np.full(1 << _BITS, -1, np.int32)
        for i, p in enumerate(pieces):
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for c in p:
                    h = h * _BASE + np.uint64(ord(c) + 1)
                slot = int(_mixed(h) >> np.uint64(64 - _BITS))
            while self.ids[slot] >= 0 and self.keys[slot] != h:  # a piece whose slot is taken goes to the next free one
                slot = (slot + 1) % len(self.ids)
            if self.ids[slot] < 0:
                self.keys[slot], self.ids[slot] = h, i

    def find(self, words: list[str], start: int = 0, stop: int | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
        """Lengths of the words (with the mark before each), and for each piece length k an array [word, end - start] of piece ids for ends in [start, stop), -1 where there is none."""
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        stop = int(size.max()) if stop is None else min(stop, int(size.max()))
        before = min(start, self.longest - 1)
        parts = ["▁"[start - before :] + w[max(start - before - 1, 0) : stop - 1] for w in words]
        width = np.fromiter(map(len, parts), np.int64, len(parts))
        codes = np.zeros((len(parts), before + stop - start), np.uint64)
        there = np.arange(codes.shape[1]) < width[:, None]
        codes[there] = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        out, h = [], np.zeros_like(codes)
        for k in range(1, min(self.longest, codes.shape[1]) + 1):  # h[:, e] is the hash of the k characters that end at e
            h = np.concatenate([np.zeros((len(parts), 1), np.uint64), h[:, :-1]], axis=1) * _BASE + codes
            slot = (_mixed(h) >> np.uint64(64 - _BITS)).astype(np.int64)
            ids = np.where(self.keys[slot] == h, self.ids[slot], -1)
            look = np.nonzero((self.keys[slot] != h) & (self.ids[slot] >= 0))
            at, want = slot[look], h[look]
            while len(want):  # slots taken by other pieces: the next ones
                at = (at + 1) % len(self.ids)
                found = self.keys[at] == want
                ids[tuple(x[found] for x in look)] = self.ids[at[found]]
                more = ~found & (self.ids[at] >= 0)
                look, at, want = tuple(x[more] for x in look), at[more], want[more]
            ids[:, : k - 1] = -1
            out.append(np.where(there, ids, -1)[:, before:])
        return size, out


@lru_cache(maxsize=2)
def vocabulary(name: str = VOCABULARY) -> Pieces:
    """All pieces that stand for text; control and byte pieces stand for none."""
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    return Pieces([sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))])


def batches_of(words: list[str], width: int, langs: int = 1) -> Iterator[list[int]]:
    """Places of words of about the same length, as many together as arrays of CELLS numbers allow."""
    part: list[int] = []
    for k in sorted(range(len(words)), key=lambda k: len(words[k])):
        if part and (len(part) + 1) * width * max(min(len(words[k]) + 1, COLUMNS), langs) > CELLS:
            yield part
            part = []
        part.append(k)
    if part:
        yield part


def log_scores(words: list[str], p: np.ndarray, pieces: Pieces) -> np.ndarray:
    """log P(word | language) for each word, all segmentations summed: the probability of the first e characters needs only those of the ``longest`` places before, so words of any length take the same memory.

    p[piece + 1, language]; row 0 is for a character without a piece.
    """
    out = np.zeros((len(words), p.shape[1]))
    for part in batches_of(words, pieces.longest + 1, p.shape[1]):
        own = [words[k] for k in part]
        ends, n = max(map(len, own)) + 1, len(own)
        before = [np.ones((n, p.shape[1]))]  # the newest first
        scaled, done = np.zeros((n, p.shape[1])), np.zeros((n, p.shape[1]))
        for a in range(0, ends, COLUMNS):
            size, found = pieces.find(own, a, a + COLUMNS)
            for e in range(found[0].shape[1]):
                total = before[0] * p[found[0][:, e] + 1]
                for k in range(2, min(len(found), len(before)) + 1):
                    ids = found[k - 1][:, e]
                    at = np.flatnonzero(ids >= 0)
                    if len(at):
                        total[at] += before[k - 1][at] * p[ids[at] + 1]
                before = [total, *before[: pieces.longest - 1]]
                if e % 8 == 7 and (low := total < 1 / _SCALE).any():
                    factor = np.where(low, _SCALE, 1.0)
                    before = [x * factor for x in before]
                    scaled -= np.log(factor)
                full = np.flatnonzero(size == a + e + 1)
                if len(full):
                    done[full] = np.log(np.maximum(before[0][full], 1e-300)) + scaled[full]
        out[part] = done
    return out


def forward(size: np.ndarray, found: list[np.ndarray], p: np.ndarray) -> np.ndarray:
    """alpha[word, position]: probability of the first characters over all segmentations, by p[piece + 1]."""
    n, m = found[0].shape
    alpha = np.zeros((n, m + 1))
    alpha[:, 0] = 1.0
    for e in range(m):
        total = alpha[:, e] * p[found[0][:, e] + 1]
        for k in range(2, min(len(found), e + 1) + 1):
            ids = found[k - 1][:, e]
            at = np.flatnonzero(ids >= 0)
            if len(at):
                total[at] += alpha[at, e + 1 - k] * p[ids[at] + 1]
        alpha[:, e + 1] = total
    return alpha


def expected_counts_long(word: str, n: float, p: np.ndarray, pieces: Pieces, out: np.ndarray) -> None:
    """Adds the expected uses of pieces in one long word, in logarithms: the sums over all segmentations from the left, then from the right."""
    _, found = pieces.find([word])
    m = found[0].shape[1]
    ids = np.full((m, pieces.longest), -1)
    ids[:, : len(found)] = np.array([f[0] for f in found]).T
    logs = np.where(ids >= 0, np.log(p)[ids + 1], -np.inf)
    logs[:, 0] = np.log(p)[ids[:, 0] + 1]  # a character without a piece has row 0
    left, right = np.full(m + 1, -np.inf), np.full(m + 1, -np.inf)
    left[0] = right[m] = 0.0
    for e in range(m):
        k = min(pieces.longest, e + 1)
        left[e + 1] = np.logaddexp.reduce(left[e - k + 1 : e + 1][::-1] + logs[e, :k])
    for e in range(m - 1, -1, -1):
        k = min(pieces.longest, e + 1)
        right[e - k + 1 : e + 1] = np.logaddexp(right[e - k + 1 : e + 1], (right[e + 1] + logs[e, :k])[::-1])
    for k in range(min(pieces.longest, m)):
        use = np.flatnonzero(np.isfinite(logs[k:, k])) + k
        out += np.bincount(ids[use, k] + 1, np.exp(left[use - k] + logs[use, k] + right[use + 1] - left[m]) * n, len(out))


def expected_counts(words: list[str], n: np.ndarray, p: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Expected uses of each piece (row 0: characters without one) over the words of one language under p[:, None]."""
    out = np.zeros(len(pieces.pieces) + 1)
    for w, times in ((w, t) for w, t in zip(words, n, strict=True) if len(w) > LONG):
        expected_counts_long(w, times, p, pieces, out)
    short = [k for k, w in enumerate(words) if len(w) <= LONG]
    for places in batches_of([words[k] for k in short], pieces.longest + 1):
        part = np.array([short[k] for k in places])
        size, found = pieces.find([words[k] for k in part])
        alpha = forward(size, found, p)
        m = found[0].shape[1]
        beta = np.zeros((len(part), m + 1))
        beta[np.arange(len(part)), size] = 1.0
        whole = alpha[np.arange(len(part)), size]
        weight = n[part] / np.where(whole > 0, whole, 1.0)
        for e in range(m - 1, -1, -1):  # all of beta[:, e + 1] is known: hand it on to the starts of the pieces that end at e
            live = np.flatnonzero(e < size)
            for k in range(1, min(len(found), e + 1) + 1):
                ids = found[k - 1][live, e]
                use = live if k == 1 else live[ids >= 0]
                ids = ids if k == 1 else ids[ids >= 0]
                mass = p[ids + 1] * beta[use, e + 1]
                beta[use, e + 1 - k] += mass
                out += np.bincount(ids + 1, alpha[use, e + 1 - k] * mass * weight[use], len(out))
    return out


def learn(words: list[str], n: np.ndarray, pieces: Pieces, rounds: int = ROUNDS) -> np.ndarray:
    """p[piece + 1] of one language by EM from its word counts."""
    q = np.full(len(pieces.pieces) + 1, 1 / (len(pieces.pieces) + 1))
    for _ in range(rounds):
        c = expected_counts(words, n, q, pieces) + 0.1
        q = np.maximum(c / c.sum(), FLOOR)
    return q


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text, mod 5, is 0; a null id counts as held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and p[piece + 1, language], from a bounded sample: about ``sample`` documents of each language with all their words, chosen by a hash of the id, outside the held-out fold.

    A task learns a language; the driver gets one row of the vocabulary's size for each.
    """
    rows = docs.select(docs[id_col].alias("i"), docs[text_col].alias("t"), docs[lang_col].alias("l")).where(F.col("l").isNotNull() & F.col("t").isNotNull() & ~held_out(F.col("i")))
    share = {r["l"]: sample / r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not share:
        return [], np.zeros((1, 0))
    part = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])
    picked = rows.where(F.pmod(F.xxhash64("i"), F.lit(1 << 20)) < F.element_at(part, F.col("l")) * float(1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[str, Counter] = {}
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own.setdefault(lang, Counter()).update(words_of(text))
        for lang, c in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c)), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["l", "w", "n"])

    def fit(key, words):
        q = learn(words["w"].to_pylist(), words["n"].to_numpy().astype(float), vocabulary())
        return pa.table({"l": pa.array([key[0].as_py()], pa.string()), "p": pa.array([q.astype(np.float32)], pa.list_(pa.float32()))})

    counted = picked.select("t", "l").mapInArrow(count, "l string, w string, n long").groupBy("l", "w").agg(F.sum("n").alias("n"))
    models = counted.orderBy("w").groupBy("l").applyInArrow(fit, "l string, p array<float>").toArrow().sort_by("l")
    langs = models["l"].to_pylist()
    return langs, np.stack([x.values.to_numpy() for x in models["p"]], axis=1) if langs else np.zeros((1, 0))


def scorer(langs: list[str], p: np.ndarray):
    """A function from texts to (predictions, scores) that keeps the scores of words it has met."""
    pieces = vocabulary()
    room = CACHED * 16 // max(len(langs), 16)
    row: dict[str, int] = {}
    known = np.zeros((0, len(langs)))

    def of(texts: list[str | None]) -> tuple[list[str], list[float]]:
        nonlocal known
        sums = np.zeros((len(texts), len(langs)))
        waiting: list[tuple[int, list[str]]] = []
        new: set[str] = set()

        def add() -> None:
            nonlocal known
            if new:
                words = list(new)
                row.update(zip(words, range(len(row), len(row) + len(words)), strict=True))
                known = np.concatenate([known, log_scores(words, p, pieces)])
                new.clear()
            for k, words in waiting:
                sums[k] += known[np.fromiter(map(row.__getitem__, words), np.int64, len(words))].sum(axis=0)
            waiting.clear()

        some = [False] * len(texts)
        for k, t in enumerate(texts):
            words = words_of(t) if t and langs and any(map(str.isalpha, t)) else []
            some[k] = bool(words)
            for a in range(0, len(words), PORTION):
                part = words[a : a + PORTION]
                fresh = {w for w in part if w not in row}
                if len(row) + len(new | fresh) > room:
                    add()
                    row.clear()
                    known = known[:0]
                    fresh = set(part)
                new.update(fresh)
                waiting.append((k, part))
        add()
        best = sums.argmax(axis=1) if langs else []
        preds = [langs[best[k]] if some[k] else "und" for k in range(len(texts))]
        return preds, [float(1 / np.exp(sums[k] - sums[k, best[k]]).sum()) if some[k] else 0.0 for k in range(len(texts))]

    return of


def identify(docs: DataFrame, langs: list[str], p: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred and score (posterior of the best language under equal priors, over the whole text) for each row.

    A text that is null, empty or without a letter, or a model without languages, gives ``und`` with score 0. Equal scores go to the first language by name.
    Repeated rows, null ids and extra columns are kept apart and harmless; an empty table gives no row. Only the text is looked at.
    """
    model = docs.sparkSession.sparkContext.broadcast((langs, p))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = scorer(*model.value)
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                preds, scores = of(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(preds, pa.string()), pa.array(scores, pa.float64())], names=["i", "held_out", "lang_pred", "score"])

    done = docs.select(docs[id_col].cast("long").alias("i"), docs[text_col].alias("t"), held_out(docs[id_col]).alias("h")).mapInArrow(score, "i long, held_out boolean, lang_pred string, score double")
    return done.withColumnRenamed("i", id_col)


def keep_identified(docs: DataFrame, langs: list[str], p: np.ndarray, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, columns as they are, whose text has a language: not ``und`` and scored ``least`` or more. Without a learned language all texts with a letter stay."""
    model = docs.sparkSession.sparkContext.broadcast((langs, p))
    at_text = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = scorer(*model.value)
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                texts = part.column(at_text).to_pylist()
                if model.value[0]:
                    preds, scores = of(texts)
                    mask = [lang != "und" and s >= least for lang, s in zip(preds, scores, strict=True)]
                else:
                    mask = [bool(t) and any(map(str.isalpha, t)) for t in texts]
                yield part.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, *train(docs))
