"""Conversation structure repair: faults of turns, and the cheapest edits that give the order of roles back, found on grammar-compressed sequences."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.merkle import CRC_TABLE, crc32_sql, numbered
from strandline.llm.shared import lookup, table, written

SPACE = " \t\n\x0b\f\r"
#: Costs of edits, and of leaving a truncated turn in.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rules of the grammar at most, rounds that look for them, and pairs that a round looks at. They set the length of compressed sequences, never the result.
RULES, ROUNDS, PAIRS = 512, 12, 64
#: Rows of a chunk are 8 to this power.
RISE = 4
CACHED = 20_000

# ---------------------------------------------------------------- ropes and min-plus matrices
_MOD, _RADIX = (1 << 61) - 1, 0x1F3D5B79


class Rope:
    """A text as the concatenation of others, with its length and a hash of its characters."""

    __slots__ = ("n", "hash", "shift", "parts")

    def __init__(self, n: int, h: int, shift: int, parts):
        self.n, self.hash, self.shift, self.parts = n, h, shift, parts

    def __add__(self, other: Rope) -> Rope:
        if not self.n or not other.n:
            return self if self.n else other
        return Rope(self.n + other.n, (self.hash * other.shift + other.hash) % _MOD, self.shift * other.shift % _MOD, (self, other))

    def prefix(self, n: int) -> int:
        """Hash of the first n characters."""
        h, at = 0, self
        while n < at.n and not isinstance(at.parts, str):
            left, right = at.parts
            if n <= left.n:
                at = left
            else:
                h, n, at = (h * left.shift + left.hash) % _MOD, n - left.n, right
        if n == at.n:
            return (h * at.shift + at.hash) % _MOD
        for c in at.parts[:n]:
            h = (h * _RADIX + ord(c)) % _MOD
        return h

    def letter(self, i: int) -> str:
        at = self
        while not isinstance(at.parts, str):
            left, right = at.parts
            at, i = (left, i) if i < left.n else (right, i - left.n)
        return at.parts[i]

    def __lt__(self, other: Rope) -> bool:
        if self.n == other.n and self.hash == other.hash:
            return False
        low, high = 0, min(self.n, other.n)
        while low < high:  # the length of the common prefix
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.prefix(mid) == other.prefix(mid) else (low, mid - 1)
        return self.n < other.n if low == min(self.n, other.n) else self.letter(low) < other.letter(low)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            at = todo.pop()
            if isinstance(at.parts, str):
                out.append(at.parts)
            else:
                todo += reversed(at.parts)
        return "".join(out)


def rope(text: str) -> Rope:
    h = reduce(lambda h, c: (h * _RADIX + ord(c)) % _MOD, text, 0)
    return Rope(len(text), h, pow(_RADIX, len(text), _MOD), text)


#: States: nothing yet, after a system, a user, an assistant turn. An entry is (cost, audit) or None.
STATES, ENDS = range(4), (0, 3)
Matrix = tuple


def better(a, b):
    """The cheaper of two entries, of equal ones that with the lesser audit. Audits of one cost are never prefixes of one another: what follows would be insertions, which cost."""
    if a is None or b is None:
        return b if a is None else a
    return b if b[0] < a[0] or b[0] == a[0] and b[1] < a[1] else a


def product(x: Matrix, y: Matrix) -> Matrix:
    """Min-plus: what x and then y do to each pair of states."""
    return tuple(tuple(reduce(better, ((x[i][k][0] + y[k][j][0], x[i][k][1] + y[k][j][1]) if x[i][k] and y[k][j] else None for k in STATES)) for j in STATES) for i in STATES)


def matrix(entries: dict[tuple[int, int], tuple[int, str]]) -> Matrix:
    return tuple(tuple((entries[i, j][0], rope(entries[i, j][1])) if (i, j) in entries else None for j in STATES) for i in STATES)


NOTHING = matrix({(i, i): (0, "") for i in STATES})
INSERTS = matrix({(i, i): (0, "") for i in STATES} | {(i, 2): (INSERT, "I") for i in (0, 1, 3)} | {(i, 3): (2 * INSERT, "II") for i in (0, 1)} | {(2, 3): (INSERT, "I")})
#: Initials of roles that may stay, and the rows that terminals stand for: such a role or another one, whole or truncated; the last is a row that must go.
INITIALS = "sua"
TERMINALS = [(role, cut) for role in (*INITIALS, "") for cut in (False, True)] + [None]
GOES = len(TERMINALS) - 1


def terminal(row) -> Matrix:
    """The edits of one row, after any insertions in front of it."""
    edits = {(i, i): (DELETE, "D") for i in STATES}
    if row is not None:
        role, cut = row
        extra = TRUNCATED if cut else 0
        edits |= {(i, 2): min(edits.get((i, 2), (99, "")), (REROLE + extra, "R")) for i in (0, 1, 3)} | {(2, 3): (REROLE + extra, "R")}
        keeps = {"s": [(0, 1)], "u": [(0, 2), (1, 2), (3, 2)], "a": [(2, 3)]}.get(role, [])
        edits |= {at: (extra, "K") for at in keeps}
    return product(INSERTS, matrix(edits))


BASE, FRESH = 0x100, 0x200  # characters of terminals and of rules


def compressed(text: str, rules: list[tuple[str, str]]) -> str:
    """Sequences (joined by line feeds) in which every pair that has a rule is its symbol, in the order of the rules."""
    for k, (a, b) in enumerate(rules):
        text = text.replace(a + b, chr(FRESH + k))
    return text


@lru_cache(maxsize=2)
def evaluated(rules: tuple) -> dict[str, Matrix]:
    """One transfer matrix a symbol, from the terminals up: a rule's is the product of its two sides, whose ropes it shares."""
    known = {chr(BASE + k): terminal(row) for k, row in enumerate(TERMINALS)}
    for k, (a, b) in enumerate(rules):
        known[chr(FRESH + k)] = product(known[a], known[b])
    return known


def balanced(parts: Iterator[Matrix]) -> Matrix:
    """The product of many matrices, halves of about equal size, so that ropes stay shallow."""
    stack: list[tuple[int, Matrix]] = []
    for m in parts:
        size = 1
        while stack and stack[-1][0] <= size:
            s, before = stack.pop()
            size, m = size + s, product(before, m)
        stack.append((size, m))
    return reduce(lambda later, x: product(x[1], later), reversed(stack), NOTHING)


# ---------------------------------------------------------------- Spark
def ordered(turns: DataFrame) -> DataFrame:
    """Rows with what the later steps need: the conversation as text, a hash of the text, whether there is anything in it, whether it ends as a sentence does."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    seen = F.rtrim(text, F.lit(SPACE))
    return turns.select(
        F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit("")).alias("tree"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), F.lit(" ")).alias("role"), text.alias("text"),
        F.unhex(F.md5(text.cast("binary"))).alias("key"), (seen == "").alias("blank"), (~F.substring(seen, -1, 1).isin(".", "!", "?")).alias("cut"),
    )


def faults(turns: DataFrame) -> DataFrame:
    """Rows as in ``ordered`` without texts, numbered in their conversation, each with its first fault: blank, duplicate, truncated or none.

    A row repeats another if the same role and text stand at an earlier turn, or if it isn't the first of alike rows of its turn. Alike rows are counted before they are shuffled; a role and text that
    holds many rows of a conversation meets its first turn through ``lookup``.
    """
    alike = turns.groupBy("tree", "turn", "role", "key", "blank", "cut").agg(F.count("*").alias("m"))
    alike = written(alike, "alike-turns")
    of = ["tree", "role", "key"]
    when = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    first = alike.groupBy(*of).agg(F.min(when).alias("first"), F.count("*").alias("_rows")).where("_rows > 1")
    met = lookup(alike, written(first, "first-turns"), of, "_rows", alike.count())
    each = met.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))))
    again = (F.col("copy") > 1) | F.coalesce(F.col("first") < when, F.lit(False))
    fault = F.when(F.col("blank"), "blank").when(again, "duplicate").when(F.col("cut"), "truncated")
    return numbered(each.select("tree", "turn", "role", "key", "copy", fault.alias("fault")), ["turn", "role", "key", "copy"], RISE)


CHUNK = "tree string, block long, symbols string, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, turns long"


def chunks(rows: DataFrame) -> DataFrame:
    """Runs of 4,096 rows at most of a conversation, as sequences of terminals with their counts and what stands at their edges."""
    code = {row: chr(BASE + k) for k, row in enumerate(TERMINALS)}
    legal = {"su", "ua", "au"}
    kinds = (pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.string(), pa.string(), *[pa.int64()] * 3)
    names = [x.split()[0] for x in CHUNK.split(", ")]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, row = None, None

        def done():
            counts = row["faults"]
            return (*last, "".join(row["symbols"]), counts["blank"], counts["duplicate"], counts["truncated"], row["illegal"], row["first"], row["before"], row["low"], row["high"], row["turns"])

        for b in batches:
            out = []
            for tree, block, turn, role, fault in zip(*(c.to_pylist() for c in b.columns), strict=True):
                initial = role[:1]
                if (tree, block) != last:
                    if last is not None:
                        out.append(done())
                    last, row = (tree, block), {"symbols": [], "faults": Counter(), "illegal": 0, "first": initial, "before": None, "low": None, "high": None, "turns": 0}
                row["symbols"].append(code[(initial if initial in INITIALS else "", fault == "truncated") if fault not in ("blank", "duplicate") else None])
                row["faults"][fault] += 1
                row["illegal"] += row["before"] is not None and row["before"] + initial not in legal
                row["before"] = initial
                if turn is not None and turn != row["high"]:
                    row["low"], row["high"], row["turns"] = turn if row["low"] is None else row["low"], turn, row["turns"] + 1
            yield _batch(out)
        if last is not None:
            yield _batch([done()])

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [[]] * len(kinds), kinds, strict=True)], names=names)

    together = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "i")
    return together.select("tree", "block", "turn", "role", "fault").mapInArrow(emit, CHUNK)


def grammar(sequences: DataFrame) -> list[tuple[str, str]]:
    """Re-Pair rules over all distinct sequences (column ``symbols``): in each round the most frequent pairs that can't overlap become symbols, until none occurs twice.

    Tasks count pairs of the sequences as compressed so far; of the sums the PAIRS most frequent reach the driver.
    """
    rules: list[tuple[str, str]] = []
    for _ in range(ROUNDS):
        so_far = list(rules)

        def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: Counter = Counter()
            for b in batches:
                text = compressed("\n".join(b.column(0).to_pylist()), so_far)
                seen.update(zip(text, text[1:]))
            found = [(a, z, n) for (a, z), n in seen.items() if a != "\n" and z != "\n"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*found) if found else [[]] * 3, (pa.string(), pa.string(), pa.int64()))], names=["a", "z", "n"])

        best = sequences.select("symbols").mapInArrow(pairs, "a string, z string, n long").groupBy("a", "z").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "a", "z").limit(PAIRS).collect()
        firsts, seconds = set(), set()
        for a, z, _n in best:
            if a not in seconds and z not in firsts and len(rules) < RULES:
                rules.append((a, z))
                firsts.add(a)
                seconds.add(z)
        if len(rules) == len(so_far) or len(rules) == RULES:
            break
    return rules


STATS = ["blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "turns"]


def transfers(parts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Every chunk with its transfer matrix, 16 costs (-1: no way) and audits. A worker keeps the matrices of sequences that it has met."""
    share = parts.sparkSession.sparkContext.broadcast(tuple(rules))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, met = evaluated(share.value), {}
        for b in batches:
            costs, audits = [], []
            for s in compressed("\n".join(b.column("symbols").to_pylist()), share.value).split("\n") if b.num_rows else ():
                if s not in met:
                    if len(met) > CACHED:
                        met.clear()
                    flat = [e for line in balanced(known[c] for c in s) for e in line]
                    met[s] = [-1 if e is None else e[0] for e in flat], ["" if e is None else str(e[1]) for e in flat]
                costs.append(met[s][0])
                audits.append(met[s][1])
            yield b.drop_columns(["symbols"]).append_column("costs", pa.array(costs, pa.list_(pa.int64()))).append_column("audits", pa.array(audits, pa.list_(pa.string())))

    return parts.mapInArrow(emit, CHUNK.replace("symbols string, ", "") + ", costs array<long>, audits array<string>")


VERDICT = "tree string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def verdicts(moves: DataFrame) -> DataFrame:
    """One row a conversation: its chunks' matrices multiplied in order, its counts added up over their edges, its cheapest audit."""
    legal = {"su", "ua", "au"}

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, part, out = None, [], []

        def done():
            counts, low, high, turns, illegal, before = Counter(), None, None, 0, 0, None
            for p in part:
                for c in ("blank", "duplicate", "truncated"):
                    counts[c] += p[c]
                illegal += p["illegal"] + (before is not None and before + p["first"] not in legal)
                turns += p["turns"] - (p["low"] is not None and p["low"] == high)
                before, low, high = p["last"], p["low"] if low is None else low, high if p["high"] is None else p["high"]
            whole = product(balanced(p["matrix"] for p in part), INSERTS)
            cost, audit = reduce(better, (whole[0][j] for j in ENDS))
            return tree, 0 if low is None else high - low + 1 - turns, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, str(audit)

        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["tree"] != tree:
                    if part:
                        out.append(done())
                    tree, part = r["tree"], []
                r["matrix"] = tuple(tuple((c, rope(a)) if c >= 0 else None for c, a in zip(r["costs"][k : k + 4], r["audits"][k : k + 4])) for k in range(0, 16, 4))
                part.append({k: r[k] for k in (*STATS, "matrix")})
            yield _rows(out)
        if part:
            yield _rows([done()])

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), *[pa.int64()] * 6, pa.string())
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [[]] * 8, kinds, strict=True)], names=[x.split()[0] for x in VERDICT.split(", ")])

    return moves.repartition("tree").sortWithinPartitions("tree", "block").mapInArrow(emit, VERDICT)


REPAIRED = "tree string, edit string, turn long, role string, text string"


def repaired(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The turns that are left, in order and together: those kept or given a new role, and inserted ones (turn null, empty text). One shuffle of texts; a conversation streams through its task."""
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
    names = [x.split()[0] for x in REPAIRED.split(", ")]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, audit, at, last = None, "", 0, ""

        def inserted() -> Iterator[tuple]:
            nonlocal at, last
            while at < len(audit) and audit[at] == "I":
                at, last = at + 1, "a" if last == "u" else "u"
                yield tree, "I", None, "assistant" if last == "a" else "user", ""

        for b in batches:
            out = []
            for conv, head, turn, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if head:
                    tree, audit, at, last = conv, text, 0, ""
                    out += inserted()
                    continue
                edit, at = audit[at], at + 1
                if edit == "R":
                    role = "assistant" if last == "u" else "user"
                if edit != "D":
                    last = role[0]
                    out.append((conv, edit, turn, role, text))
                out += inserted()
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [[]] * 5, kinds, strict=True)], names=names)

    rows = turns.select("tree", F.lit(False).alias("head"), "turn", "role", "text", "key")
    heads = found.select("tree", F.lit(True).alias("head"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.unhex(F.lit("")).alias("key"))
    together = rows.unionByName(heads).repartition("tree").sortWithinPartitions("tree", F.desc("head"), "turn", "role", "key")
    return together.select("tree", "head", "turn", "role", "text").mapInArrow(emit, REPAIRED)


def digests(rows: DataFrame) -> DataFrame:
    """tree, repaired_sha256: of ``role:text`` joined by line feeds, for rows that lie in order and together."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sha = None, hashlib.sha256()
        for b in batches:
            out = []
            for tree, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if tree != last:
                    if last is not None:
                        out.append((last, sha.hexdigest()))
                    last, sha = tree, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in (zip(*out) if out else [[], []])], names=["tree", "sha"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([sha.hexdigest()])], names=["tree", "sha"])

    return rows.select("tree", "role", "text").mapInArrow(emit, "tree string, sha string")


def judged(turns: DataFrame) -> DataFrame:
    """The verdicts of conversations with rows; ``turns`` as ``ordered`` gives them."""
    parts = written(chunks(faults(turns)), "turn-chunks")
    rules = grammar(parts.select("symbols").distinct())
    return verdicts(transfers(parts, rules))


def repair(turns: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verdicts (a row for every ``conv_id`` of ``ids``: gaps, faults, illegal neighbours, cost, audit) and the repaired turns (edit, turn, role, text, in order).

    Rows of ``turns`` go by turn (nulls first), then role and a hash of the text. Null role and text are one space. A conversation without rows costs nothing and has an empty audit; rows with a null conv_id are
    one conversation. Repeated rows are turns of their own. Other columns are ignored. Chunks of any conversation are spread; its audit is one text, and its repaired turns stream through one task, as their
    digest needs them in order. An empty table gives no rows.
    """
    rows = ordered(turns)
    found = written(judged(rows), "verdicts")
    every = ids.select(F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit("")).alias("tree")).distinct()
    zero = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    full = every.join(found, "tree", "left").select("tree", *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"))
    return full, repaired(rows, found)


def damaged(turns: DataFrame) -> DataFrame:
    """A fixed share of faults, by the checksum of conversation and turn: rows dropped, emptied, robbed of their full stops, doubled, given to the user."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(some("conv_id"), F.lit(":"), some("turn")).cast("binary")) % 20
    role = F.when(F.col("_code") == 4, "user").otherwise(some("role"))
    text = F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.translate(some("text"), ".!?", "")).otherwise(some("text"))
    rows = turns.withColumn("_code", code).where("_code <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("_code") == 3, 2).otherwise(1).alias("_times"))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times", "_copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = table(spark, sf_dir, "conversations")
    found, rows = repair(damaged(whole), whole)
    conv: Column = F.when(F.col("tree") != "", F.col("tree")).cast("long").alias("conv_id")
    return found.join(digests(rows), "tree", "left").select(conv, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


OP13_SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
c AS (SELECT conv_id, coalesce(conv_id::VARCHAR, ' ') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS code FROM conversations, crc),
d AS (SELECT conv, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role, CASE WHEN code = 1 THEN '' WHEN code = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy FROM c WHERE code <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(text), copy) AS p, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS seen FROM d),
q AS (SELECT *, row_number() OVER (PARTITION BY conv, role, text ORDER BY p) > 1 AS again, role[1] AS ini, lag(role[1]) OVER (PARTITION BY conv ORDER BY p) AS before FROM o),
r AS (SELECT *, CASE WHEN seen = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN NOT regexp_matches(seen, '[.!?]$') THEN 'truncated' ELSE '' END AS fault FROM q),
ins(a, b, cost, audit, text) AS (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''), (0, 2, 5, 'I', chr(10) || 'user:'), (1, 2, 5, 'I', chr(10) || 'user:'), (3, 2, 5, 'I', chr(10) || 'user:'),
  (2, 3, 5, 'I', chr(10) || 'assistant:'), (0, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
go(a, b) AS (VALUES (0, 1), (0, 2), (1, 2), (3, 2), (2, 3)),
e AS (SELECT conv, p, b.a, b.b, CASE WHEN b.b = CASE ini WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 END THEN 0 ELSE 1 END + CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS cost,
    CASE WHEN b.b = CASE ini WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 END THEN 'K' ELSE 'R' END AS audit,
    chr(10) || CASE WHEN b.b = CASE ini WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 END THEN role WHEN b.b = 2 THEN 'user' ELSE 'assistant' END || ':' || text AS text
  FROM r, go b WHERE fault NOT IN ('blank', 'duplicate') AND (b.b <> 1 OR ini = 's')
  UNION ALL SELECT conv, p, s, s, 2, 'D', '' FROM r, range(4) t(s)),
x(conv, p, st, best) AS (SELECT DISTINCT conv, 0::BIGINT, 0, {{'c': 0, 'a': '', 't': ''}} FROM c
  UNION ALL SELECT x.conv, x.p + 1, e.b, min({{'c': x.best.c + ins.cost + e.cost, 'a': x.best.a || ins.audit || e.audit, 't': x.best.t || ins.text || e.text}})
  FROM x JOIN ins ON ins.a = x.st JOIN e ON e.conv = x.conv AND e.p = x.p + 1 AND e.a = ins.b GROUP BY 1, 2, 3),
n AS (SELECT conv, count(*) AS rows FROM r GROUP BY conv),
f AS (SELECT x.conv, min({{'c': x.best.c + ins.cost, 'a': x.best.a || ins.audit, 't': x.best.t || ins.text}}) AS best FROM x LEFT JOIN n USING (conv) JOIN ins ON ins.a = x.st AND ins.b IN (0, 3) WHERE x.p = coalesce(n.rows, 0) GROUP BY x.conv),
s AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv)
SELECT u.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  f.best.c::BIGINT AS cost, f.best.a AS audit, sha256(substr(f.best.t, 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM c) u JOIN f USING (conv) LEFT JOIN s USING (conv)
"""
