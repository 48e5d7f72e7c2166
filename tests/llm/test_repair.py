"""Conversation repair against a search over all edits, row by row, in plain Python."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import pytest
from conftest import same

from strandline.llm import repair

SEEN = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """(cost, audit, repaired) by best-first search over (rows done, roles so far); rows are (role, text, fault)."""
    todo, done = [(0, "", 0, "", ())], set()
    while todo:
        cost, audit, at, last, out = heapq.heappop(todo)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            return cost, audit, out
        step = lambda c, e, n, who, line: heapq.heappush(todo, (cost + c, audit + e, n, who, out + line))
        after = "a" if last == "u" else "u"
        name = {"u": "user", "a": "assistant"}[after]
        step(5, "I", at, after, (f"{name}:",))
        if at < len(rows):
            role, text, fault = rows[at]
            step(2, "D", at + 1, last, ())
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                if role[:1] == after or role[:1] == "s" and last == "":
                    step(extra, "K", at + 1, role[0], (f"{role}:{text}",))
                step(1 + extra, "R", at + 1, after, (f"{name}:{text}",))


def brute(turns):
    rows, ids = {}, {t[0] for t in turns}
    for conv, turn, role, text in turns:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role = "user" if code == 4 else role
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        rows.setdefault(conv, []).extend([(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1))
    out = Counter()
    for conv in ids:
        mine = sorted(rows.get(conv, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        faults, met = [], set()
        for _, role, text in mine:
            seen = SEEN.findall(text)
            faults.append("blank" if not seen else "duplicate" if (role, text) in met else "truncated" if seen[-1] not in ".!?" else "")
            met.add((role, text))
        at = [t for t, _, _ in mine if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, text = cheapest([(r, t, f) for (_, r, t), f in zip(mine, faults)])
        out[conv, max(at) - min(at) + 1 - len(set(at)) if at else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest()] += 1
    return out


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(5)
    texts = ["Yes.", "No!", "Why? ", "cut off", " \t\n", "", None, "日本語。", "ok.\n\n", "x" * 3000 + ".", "Fine.", "More.", "A..B"]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "sidekick", "äther"]
    out = []
    for conv in [*range(150), None]:
        n = rng.choice([1, 2, 3, 5, 8, 12, 40])
        usual = rng.random() < 0.5
        for t in range(n):
            role = ["user", "assistant"][t % 2] if usual and rng.random() < 0.9 else rng.choice(roles)
            out.append((conv, rng.choice([t, t, t, t + 3, None, 2]), role, rng.choice(texts) if rng.random() < 0.6 else f"text {rng.random()}."))
    return out + [(7, 1, "user", "Same.")] * 20 + [(500, t, rng.choice(roles[:3]), f"t{t % 7}.") for t in range(900)]


def frame(spark, turns):
    return spark.createDataFrame([(*t, "x", 1) for t in turns], "conv_id long, turn long, role string, text string, tree string, block int").repartition(4)


def run(spark, turns):
    from pyspark.sql import functions as F

    whole = frame(spark, turns)
    found, rows = repair.repair(repair.damaged(whole), whole)
    got = found.join(repair.digests(rows), "tree", "left").select("*", F.coalesce("sha", F.sha2(F.lit(b""), 256)).alias("h")).collect()
    return Counter((int(r["tree"]) if r["tree"] else None, *(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "h"))) for r in got)


@pytest.mark.parametrize("rise", [1, 4])
def test_repair(spark, turns, rise, monkeypatch):
    """Chunks of 8 rows and of 4,096."""
    monkeypatch.setattr(repair, "RISE", rise)
    assert run(spark, turns) == brute(turns)


def test_small_tables(spark, turns):
    assert not run(spark, turns[:1]) - brute(turns[:1])
    whole = frame(spark, turns).where("false")
    found, rows = repair.repair(whole, whole)
    assert found.count() == 0 and rows.count() == 0


def test_dropped_conversations_stay(spark):
    """Every row of a conversation is dropped: zeros, an empty audit, the digest of nothing."""
    gone = next(c for c in range(10**6) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert run(spark, [(gone, 0, "user", "Hello.")]) == Counter([(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())])


def test_matrices_are_those_of_the_search():
    rng = random.Random(6)
    for _ in range(300):
        rows = [rng.choice(repair.TERMINALS) for _ in range(rng.randint(0, 14))]
        plain = [("x", "", "blank") if r is None else ({"": "x"}.get(r[0], r[0]), "", "truncated" if r[1] else "") for r in rows]
        at = rng.randint(0, len(rows))
        parts = [repair.balanced(repair.terminal(r) for r in half) for half in (rows[:at], rows[at:])]
        whole = repair.product(repair.product(*parts), repair.INSERTS)
        cost, audit = repair.better(whole[0][0], whole[0][3])
        assert (cost, str(audit)) == cheapest(plain)[:2]


def test_ropes_compare_as_texts():
    rng = random.Random(7)
    made = [(x, repair.rope(x)) for x in ("", "K", "D", "KD", "KKKK")]
    for _ in range(400):
        (a, x), (b, y) = rng.choice(made), rng.choice(made)
        assert (x < y) == (a < b) and str(x + y) == a + b
        if len(a + b) < 200:
            made.append((a + b, x + y))


def test_grammar_is_re_pair(spark):
    df = spark.createDataFrame([("abcabcabc",), ("xabc",), ("abab",)], "symbols string")
    rules = repair.grammar(df)
    assert rules[0] == ("a", "b")
    text = "abcabcabc\nxabc\nabab"
    short = repair.compressed(text, rules)
    for k in range(len(rules) - 1, -1, -1):
        short = short.replace(chr(repair.FRESH + k), "".join(rules[k]))
    assert short == text
    pairs = Counter(p for line in repair.compressed(text, rules).split("\n") for p in zip(line, line[1:]))
    assert not pairs or max(pairs.values()) < 2


def test_equals_sql(spark, sf, duck):
    same(repair.op13_conversation_repair(spark, sf).toPandas(), duck.sql(repair.OP13_SQL).df())
