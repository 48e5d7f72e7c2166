"""Decontamination against plain loops over all windows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import same

from strandline.llm import decontamination as dec

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), 10)
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    lengths = {len(k) for k in windows}
    out = Counter()
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= got
        out[doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)] += 1
    return out


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    vocab = ["alpha", "Beta", "gamma", "délta", "ε", "the", "of", "x2", "日本語", "ÉCOLE", "9"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    long = [text(rng.randint(10, 40)) for _ in range(12)]
    shared = text(14)
    items = [(i, x) for i, x in enumerate(long)] + [(20, None), (21, ""), (22, " -- "), (23, "zeta eta theta"), (24, "zeta"), (25, shared + " one"), (26, shared + " two"), (26, "other " + text(12)), (None, text(11)), (27, shared + " one")]
    rows = [(1, None), (2, ""), (3, "?!\n"), (4, long[0]), (4, long[0]), (5, long[1].upper().replace(" ", ", ")), (6, "y" * 5000), (None, text(50) + " " + long[2]), (8, "Zeta.eta-theta zeta"), (9, text(3000) + " " + shared + " " + text(3000))]
    rows += [(100 + i, f"{text(rng.randint(0, 60))} {' '.join(rng.choice(long).split()[: rng.randint(8, 12)])} {text(5)}") for i in range(60)]
    rows += [(1000 + i, f"{text(3)} {shared} {i}") for i in range(200)]
    return rows, items


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_contamination(spark, tables, block, monkeypatch):
    rows, items = tables
    monkeypatch.setattr(dec, "BLOCK", block)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, item string, hits int").repartition(5)
    bench = spark.createDataFrame([(*r, "y") for r in items], "item_id long, text string, row string")
    got = dec.contamination(docs, bench)
    assert Counter(map(tuple, got.collect())) == brute(rows, items)


def test_every_window_may_pass_the_filter(spark, tables, monkeypatch):
    """A filter that is full lets all through: the join alone decides."""
    rows, items = tables
    monkeypatch.setattr(dec, "fingerprint_filter", lambda windows: (np.full(1024, 2**64 - 1, np.uint64), sorted(r[0] for r in windows.select("len").distinct().collect())))
    docs, bench = spark.createDataFrame(rows[:60], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert Counter(map(tuple, dec.contamination(docs, bench).collect())) == brute(rows[:60], items)


def test_empty_tables(spark, tables):
    rows, items = tables
    docs, bench = spark.createDataFrame(rows[:20], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert dec.contamination(docs.where("false"), bench).count() == 0
    assert Counter(map(tuple, dec.contamination(docs, bench.where("false")).collect())) == brute(rows[:20], [])


def test_words_are_those_of_the_pattern_whatever_the_cuts(tables, monkeypatch):
    texts = [r[1] for r in tables[0]]
    for block in (1, 7, 1 << 20):
        monkeypatch.setattr(dec, "BLOCK", block)
        got = dec.Texts(pa.array([None, *texts])[1:])
        want = [w for t in texts for w in words(t)]
        assert [bytes(got.low[a:z]).decode() for a, z in zip(got.starts, got.ends)] == want
        by = {}
        assert all(by.setdefault(w, h) == h for w, h in zip(want, got.hashes.tolist())) and len(set(by.values())) == len(by)


def test_winnowing_keeps_one_gram_of_every_window():
    got = dec.Texts(pa.array([" ".join(map(str, np.random.default_rng(1).integers(0, 50, 5000)))]))
    at, fp = got.fingerprints(dec.WINDOW)
    assert len(at) == 5000 - dec.WINDOW + 1
    assert 1 + (fp[1:] != fp[:-1]).sum() < 0.4 * len(at)  # 2 in 7 for random words


def test_equals_sql(spark, sf, duck):
    same(dec.op11_decontamination(spark, sf).toPandas(), duck.sql(dec.OP11_SQL).df())
