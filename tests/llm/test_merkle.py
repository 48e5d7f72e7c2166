"""The manifest against a plain recursion over lists."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from conftest import same
from pyspark.sql import functions as F

from strandline.llm import merkle


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """Levels of a tree over a list of digests."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([sha("".join(at[k : k + 8])) for k in range(0, len(at), 8)])
    return levels


def siblings(levels, i):
    out = []
    for at in levels[:-1]:
        run = i // 8 * 8
        out.append((at[run:i], at[i + 1 : run + 8]))
        i //= 8
    return out


def fold(x, steps):
    for left, right in steps:
        x = sha("".join([*left, x, *right]))
    return x


def brute(rows, tampered):
    trees = {}
    for r in rows:  # doc_id, source, lang, n_chars, text
        trees.setdefault(r[2], []).append(r)
    langs = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    for k in langs:
        trees[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    levels = {k: climb([leaf(r) for r in trees[k]]) for k in langs}
    top = climb([levels[k][-1][0] for k in langs])
    out = Counter()
    for j, k in enumerate(langs):
        for i, r in enumerate(trees[k]):
            steps = siblings(levels[k], i) + siblings(top, j)
            new = leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]) if r[4] is not None else None)) if tampered(r) else leaf(r)
            root = fold(new, steps)
            out[r[0], leaf(r), levels[k][-1][0], top[-1][0], sha("".join(x for left, right in steps for x in left + right)), root, root == top[-1][0]] += 1
    return out


def third(r):
    return r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, tree string, i int, digest string").repartition(parts)


def manifest(docs, **levels):
    return merkle.manifest(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.translate("text", merkle.UPPER, merkle.LOWER), **levels)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = [(i, rng.choice(["a", None, "ü"]), "en", rng.choice([None, 7]), rng.choice(["Text", "ÄB 日本", "", None, "plain"])) for i in range(700)]
    out += [(i, "s", k, 1, "Abc") for k, n in (("de", 8), ("fr", 9), ("es", 1), (None, 65), ("", 3), *((f"l{j}", 2) for j in range(70))) for i in range(1000, 1000 + n)]
    out += [(5, "a", "en", 7, "Text")] * 400 + [(None, None, None, None, None)] * 3 + [(None, None, "en", 2, "T")] + [(9, "a", "en", 7, "Z" * 20000)]
    return out


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_manifest(spark, rows, levels):
    """Blocks of 8 and of 64 nodes make upper layers of rows that fit a test."""
    got = manifest(frame(spark, rows), rise=levels)
    assert Counter(tuple(r)[:-1] for r in got.collect()) == brute(rows, third)


def test_versions_copy_their_path_alone(spark, rows):
    for r in manifest(frame(spark, rows[:700]), rise=1).collect():
        assert (r["copies"] is not None) == third([r["doc_id"]])
        if r["copies"] is not None:
            assert len(r["copies"]) == 4 and r["copies"][-1] == r["folded_root"]  # 700 leaves: 88, 11, 2, 1


def test_small_tables(spark, rows):
    assert manifest(frame(spark, rows).where("false")).count() == 0
    for some in (rows[:1], rows[:8], rows[:9], [rows[0], rows[700]]):
        assert Counter(tuple(r)[:-1] for r in manifest(frame(spark, some)).collect()) == brute(some, third)


def test_equals_sql(spark, sf, duck):
    same(merkle.op12_merkle_manifest(spark, sf).toPandas(), duck.sql(merkle.OP12_SQL).df())
