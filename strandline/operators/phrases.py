"""Concepts in notes by phrases: a token trie compiled once, the longest match, and cues whose scope has a direction, a reach and words that end it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.timesem import seconds

#: Runs of letters and digits, and marks that end a sentence.
_TOKEN = re.compile(r"[^\W_]+|[.!?]")


@dataclass(frozen=True)
class Cue:
    """A phrase that changes what is said of concepts near it: those behind it (``forward``), before it (``backward``) or both, up to ``reach`` tokens away."""

    phrase: str
    assertion: str
    direction: str = "forward"
    reach: int = 6


@dataclass(frozen=True)
class Rules:
    """targets: phrase to concept; cues; ends: phrases that end a scope, as a sentence does."""

    targets: dict[str, str]
    cues: tuple[Cue, ...] = ()
    ends: tuple[str, ...] = ()


def words(text: str) -> list[tuple[str, int, int]]:
    """Lower-case tokens with their offsets; ends of sentences are tokens too."""
    return [(m[0].lower(), m.start(), m.end()) for m in _TOKEN.finditer(text)]


def trie(entries: dict[str, object]) -> dict:
    """Nested dictionaries by token; what a phrase stands for lies under None. A phrase without a token raises."""
    root: dict = {}
    for phrase, value in entries.items():
        node = root
        for token, _, _ in words(phrase):
            node = node.setdefault(token, {})
        if node is root:
            raise ValueError(f"no word in phrase {phrase!r}")
        node[None] = value
    return root


def matches(root: dict, tokens: list[str]) -> list[tuple[int, int, object]]:
    """(first token, token behind the last, value) from left to right: at each place the longest phrase, and none inside another."""
    out, at = [], 0
    while at < len(tokens):
        node, k, best = root, at, None
        while k < len(tokens) and (node := node.get(tokens[k])) is not None:
            k += 1
            if None in node:
                best = (at, k, node[None])
        if best:
            out.append(best)
        at = best[1] if best else at + 1
    return out


class Matcher:
    """Rules compiled for many texts."""

    def __init__(self, rules: Rules):
        self.targets, self.cues = trie(dict(rules.targets)), trie({c.phrase: c for c in rules.cues})
        self.ends = trie({p: True for p in (*rules.ends, ".", "!", "?")})

    def of(self, text: str) -> list[tuple[int, int, str, str, str | None]]:
        """(start, end, concept, assertion, cue) of every target, offsets in characters; a target lies in the scope of the nearest cue that reaches it with no end between, of equally near ones the earlier."""
        found = words(text)
        tokens = [w for w, _, _ in found]
        hits = matches(self.targets, tokens)
        if not hits:
            return []
        cues, ends = matches(self.cues, tokens), sorted(k for k, _, _ in matches(self.ends, tokens))
        stops = [0] * (len(tokens) + 1)  # ends before each place: two places have one between if they differ
        for k in ends:
            stops[k + 1] = 1
        for k in range(1, len(stops)):
            stops[k] += stops[k - 1]
        out, low = [], 0
        reach = max((c.reach for _, _, c in cues), default=0)
        for a, z, concept in hits:
            while low < len(cues) and cues[low][1] < a - reach:
                low += 1
            best = None
            for ca, cz, cue in cues[low:]:
                if ca > z + reach:
                    break
                if cz <= a and cue.direction != "backward" and a - cz < cue.reach and stops[cz] == stops[a]:
                    near = (a - cz, ca, cue)
                elif ca >= z and cue.direction != "forward" and ca - z < cue.reach and stops[z] == stops[ca]:
                    near = (ca - z, ca, cue)
                else:
                    continue
                best = near if best is None or near[:2] < best[:2] else best
            out.append((found[a][1], found[z - 1][2], concept, best[2].assertion if best else "affirmed", best[2].phrase if best else None))
        return out


MENTION = "start int, end int, concept string, assertion string, cue string"


def extract_mentions(df: DataFrame, key: list[str], text: str, rules: Rules) -> DataFrame:
    """key, start, end (characters, end exclusive), concept, assertion, cue: every mention of a target phrase in the whole text, with the assertion of the cue whose scope it lies in, else affirmed.

    Targets and cues are phrases of any length; a cue's own words may be target words too. The compiled rules go to each task once; a text is read in one place, texts don't meet. A null or empty text gives no row;
    repeated rows give theirs each.
    """
    matcher = df.sparkSession.sparkContext.broadcast(Matcher(rules))
    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in key)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, *m) for k, t in enumerate(b.column(len(key)).to_pylist()) if t for m in matcher.value.of(t)]
            at, *columns = zip(*rows, strict=True) if rows else [[]] * 6
            picked = [b.column(i).take(pa.array(at, pa.int64())) for i in range(len(key))]
            told = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), *[pa.string()] * 3), strict=True)]
            yield pa.RecordBatch.from_arrays([*picked, *told], names=[*key, *(x.split()[0] for x in MENTION.split(", "))])

    return df.select(*key, F.col(text).alias("_text")).mapInArrow(read, f"{kinds}, {MENTION}")


def assertion_flags(mentions: DataFrame, by: list[str], anchor: Column, at: str) -> DataFrame:
    """by, concept, n_affirmed, n_negated, n_other, first_affirmed_hours (from the anchor to the first affirmed mention's time ``at``; null where there is none or no anchor)."""
    affirmed = F.col("assertion") == "affirmed"
    hours = (seconds(at) - seconds("_anchor")) / 3600
    d = mentions.withColumn("_anchor", anchor)
    return d.groupBy(*by, "concept").agg(
        F.count_if(affirmed).alias("n_affirmed"), F.count_if(F.col("assertion") == "negated").alias("n_negated"), F.count_if(~affirmed & (F.col("assertion") != "negated")).alias("n_other"),
        F.min(F.when(affirmed, hours)).alias("first_affirmed_hours"),
    )


def onset_offsets(mentions: DataFrame, onset: DataFrame, key: list[str], at: str, onset_at: str, width_hours: float) -> DataFrame:
    """concept, bin, n: by how many bins of ``width_hours`` the first affirmed mention comes after (before: negative) the structured onset; bin is null for keys that have only the mention, and 'structured only' keys are counted under a null concept."""
    first = mentions.where("assertion = 'affirmed'").groupBy(*key, "concept").agg(F.min(at).alias("_m"))
    one = onset.groupBy(*key).agg(F.min(onset_at).alias("_o"))
    j = first.join(one, key, "full")
    gap = F.floor((seconds("_m") - seconds("_o")) / (3600 * width_hours))
    return j.groupBy("concept", gap.alias("bin")).agg(F.count("*").alias("n"))
