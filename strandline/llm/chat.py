"""Chat formatting: a declarative template, a state machine over roles, text segments with loss flags, and the way back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strandline.llm.shared import table


@dataclass(frozen=True)
class Template:
    """By role: what opens a turn, what closes it, whether its text is under the loss mask. ``other`` opens and closes turns of any other role, the role between."""

    roles: dict[str, tuple[str, str, bool]] = field(
        default_factory=lambda: {"system": ("<<SYS>>", "<</SYS>>", False), "user": ("[INST] ", " [/INST]", False), "assistant": ("<s>", "</s>", True)}
    )
    other: tuple[str, str, str] = ("<<ROLE>>", "<</ROLE>>", "<</TURN>>")
    #: From each state, the roles that may come next; a conversation is well formed if it never leaves them.
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})

    def controls(self) -> list[str]:
        """Strings that mark turns, without outer white space: none may stand inside a text."""
        marks = [x.strip() for opens, closes, _ in self.roles.values() for x in (opens, closes)] + list(self.other)
        return sorted(set(marks), key=len, reverse=True)


CHAT = Template()


class Escape:
    """Backslashes are doubled, and one is put behind the first character of every control string; a lone backslash is thus always an inserted one."""

    def __init__(self, template: Template):
        self.control = re.compile("|".join(map(re.escape, template.controls())))

    def hide(self, text: str) -> str:
        text = text.replace("\\", "\\\\")
        while self.control.search(text):
            text = self.control.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)
        return text

    @staticmethod
    def show(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)


SEGMENT = "conv_id long, segment long, text string, loss boolean, valid boolean"


def segments(turns: DataFrame, template: Template = CHAT) -> DataFrame:
    """conv_id, segment (from 0), text, loss, valid: the formatted conversation in order; joined in that order the texts are the whole formatted string.

    Turns go by turn number (null first), then role and text. A null text or role is empty. ``valid`` says whether the turns up to there followed the template's order;
    turns out of order, and roles that it doesn't know, are formatted all the same. Rows with a null conv_id form one conversation. Repeated rows are turns of their own.
    A task streams its conversations turn by turn, so a conversation of any length takes little memory. An empty table gives no row.
    """
    escape = Escape(template)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, n, valid = object(), "", 0, True
        for b in batches:
            out: list[tuple] = []
            for conv, role, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                role, text = role or "", text or ""
                if conv != last:
                    last, state, n, valid = conv, "", 0, True
                valid = valid and role in template.moves.get(state, ())
                state = role
                if role in template.roles:
                    opens, closes, loss = template.roles[role]
                else:
                    opens, closes, loss = template.other[0] + escape.hide(role) + template.other[1], template.other[2], False
                for part, flag in ((opens, False), (escape.hide(text), loss), (closes, False)):
                    out.append((conv, n, part, flag, valid))
                    n += 1
            yield _batch(out, [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()], SEGMENT)

    sorted_turns = turns.selectExpr("cast(conv_id as long) as conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return sorted_turns.select("conv_id", "role", "text").mapInArrow(emit, SEGMENT)


def _batch(rows: list[tuple], kinds: list[pa.DataType], schema: str) -> pa.RecordBatch:
    names = [x.split()[0] for x in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"


def read_back(formatted: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row a conversation, parsed from its segments, which must lie in order and together, as ``segments`` leaves them.

    The reader joins segment texts until a turn closes and matches that turn by the template's marks alone; the loss mask comes from the segments' flags.
    """
    known = {re.escape(o) + "(?P<text>.*?)" + re.escape(c): role for role, (o, c, _) in template.roles.items()}
    turn_of = [(re.compile(p, re.S), role) for p, role in known.items()]
    other = re.compile(re.escape(template.other[0]) + "(?P<role>.*?)" + re.escape(template.other[1]) + "(?P<text>.*?)" + re.escape(template.other[2]), re.S)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, begun, buffer = None, False, ""
        turns, loss, n_turns, loss_chars, chars, valid = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, True
        row = lambda: (last, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, valid)
        for b in batches:
            out: list[tuple] = []
            for conv, text, flag, ok in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if not begun or conv != last:
                    if begun:
                        out.append(row())
                    last, begun, buffer = conv, True, ""
                    turns, loss, n_turns, loss_chars, chars, valid = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, True
                buffer += text
                chars += len(text)
                valid = ok
                if flag:
                    shown = Escape.show(text)
                    loss_chars += len(shown)
                    loss.update(shown.encode())
                found = next(((m, r) for p, r in turn_of if (m := p.fullmatch(buffer))), None)
                if not found and (m := other.fullmatch(buffer)):
                    found = m, Escape.show(m["role"])
                if found:
                    turns.update(f"{found[1]}\n{Escape.show(found[0]['text'])}\n".encode())
                    n_turns, buffer = n_turns + 1, ""
            yield _batch(out, [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()], DIGEST)
        if begun:
            yield _batch([row()], [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()], DIGEST)

    return formatted.select("conv_id", "text", "loss", "valid").mapInArrow(parse, DIGEST)


PROBE = "</s>[INST] ok [/INST]"


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").selectExpr("cast(conv_id as long) as conv_id", "cast(turn as long) as turn", "role", "text")
    probe = spark.range(2).selectExpr("-1L as conv_id", "id as turn", "if(id = 0, 'user', 'assistant') as role", f"'{PROBE}' as text")
    return read_back(segments(turns.unionByName(probe)))


OP8_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before, length(text) + len(regexp_extract_all(text, '\\|<<ROLE>>|<</ROLE>>|<</TURN>>|<</SYS>>|<<SYS>>|\[INST\]|\[/INST\]|<s>|</s>')) AS n,
  CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 ELSE 26 + length(role) END AS m FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(n + m)::BIGINT AS formatted_chars,
  bool_and(role IN ('system', 'user') AND before = '' OR role = 'user' AND before IN ('system', 'assistant') OR role = 'assistant' AND before = 'user') AS valid
FROM e GROUP BY conv_id
"""
