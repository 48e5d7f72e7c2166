"""Token counts of whole texts by a two-tier lookup of pre-token lengths, without a shuffle."""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.shared import table

TOKENIZER = "byte_bpe_50k.json"
#: Frequent tier: so many pre-tokens at most are broadcast, found in so many texts of so many characters at most.
FREQUENT = 65_536
SAMPLE = 2_000
LONGEST = 10_000
#: So many texts are looked up together.
SLICE = 256
#: Worker tier: about so many misses are kept a worker; beyond that its cache starts anew.
CACHED = 400_000
#: Longer pre-tokens are encoded whenever they occur and not kept.
KEPT = 256
#: A text with none but these characters splits alike under Python's ``re`` and the tokenizer's own pattern.
PLAIN = re.compile("[^\t\n\r -~ªµºÀ-ÖØ-öø-ʯ‘’“”–—…€£«»¿¡]")
PRE_TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


#: Pictographs: whether a library's Unicode version knows them or not, they are neither letters, digits nor white space.
PICTURES = "\U0001f300-\U0001f64f\U0001f680-\U0001f6ff\U0001f900-\U0001f9ff\U0001fa70-\U0001faff"


@lru_cache(maxsize=1)
def wide():
    """(unsure, splitter) for texts beyond PLAIN, once a worker: a pattern that finds characters on whose class libraries may differ, and the tokenizer's own pattern in a library that has its letter and digit classes.

    Sure are PICTURES and the characters of the basic plane that Unicode 3.2 knew and whose class (letter, number, space, other) is the same today; control and format characters are unsure, but for tab, line ends, the soft hyphen, the joiners and the byte order mark.
    """
    import unicodedata

    import public_tokenizers
    import regex

    old, new = unicodedata.ucd_3_2_0.category, unicodedata.category
    other = dict.fromkeys("PSM", "other") | {"L": "letter", "N": "number", "Z": "space", "C": "control"}
    kind = lambda c: other[c[0]]
    sure = [n in (9, 10, 13, 0xAD, 0x200C, 0x200D, 0xFEFF) or (kind(old(chr(n))) == kind(new(chr(n))) != "control" and new(chr(n)) not in ("Zl", "Zp")) for n in range(0x10000)]
    edges = [n for n in range(0x10000) if sure[n] != (n > 0 and sure[n - 1])] + ([0x10000] if sure[-1] else [])
    spans = "".join(f"{re.escape(chr(a))}-{re.escape(chr(b - 1))}" for a, b in zip(edges[::2], edges[1::2], strict=True))
    return re.compile(f"[^{spans}{PICTURES}]"), regex.compile(public_tokenizers.PATTERN)


def pre_tokens(text: str) -> list[str] | None:
    """The text's pre-tokens in order, or None if it holds a character on whose class libraries may differ."""
    if not PLAIN.search(text):
        return PRE_TOKEN.findall(text)
    unsure, splitter = wide()
    return None if unsure.search(text) else splitter.findall(text)


@lru_cache(maxsize=4)
def tokenizer(name: str):
    """The library object for a vocabulary file, once a worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers

    if name.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(public_tokenizers.path(name))
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


@lru_cache(maxsize=2)
def fast_encoder(name: str):
    """The same vocabulary in the quicker library, for texts without a special string; None if there is no such file."""
    import public_tokenizers
    import tiktoken

    try:
        path = public_tokenizers.path(name.replace(".json", ".tiktoken"))
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    except (OSError, KeyError, ValueError):
        return None
    return tiktoken.Encoding("same", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_whole(name: str, text: str) -> int:
    """Tokens of one text by the library itself, no begin, end or added special tokens."""
    t = tokenizer(name)
    return len(t.encode(text, num_threads=1)) if name.endswith(".model") else len(t.encode(text, add_special_tokens=False).ids)


def lengths(name: str, pieces: list[str]) -> list[int]:
    """Token counts of pre-tokens without a special string; the quicker library holds the same vocabulary, and tests hold the two against each other."""
    if fast := fast_encoder(name):
        return [len(fast.encode_ordinary(p)) for p in pieces]
    return [len(x.ids) for x in tokenizer(name).encode_batch(pieces, add_special_tokens=False)] if pieces else []


def frequent_lengths(docs: DataFrame, text_col: str = "text", name: str = TOKENIZER, most: int = FREQUENT, sample: int = SAMPLE, longest: int = LONGEST) -> dict[str, int]:
    """Token counts of the ``most`` pre-tokens most frequent in ``sample`` texts of up to ``longest`` characters.

    Sample and table have a fixed size, whatever the corpus; only the first partitions are opened. A pre-token outside the table is a miss: the table sets the speed, never the result.
    """
    if name.endswith(".model"):
        return {}
    seen: Counter[str] = Counter()
    for (text,) in docs.select(text_col).where(F.length(text_col) <= longest).limit(sample).collect():
        seen.update(p for p in pre_tokens(text) or () if len(p) <= KEPT)
    pieces = [p for p, _ in seen.most_common(most)]
    return dict(zip(pieces, lengths(name, pieces), strict=True))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = TOKENIZER, limit: int = 1024) -> DataFrame:
    """``id_col``, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) for each row, whole texts, nothing truncated.

    A null or empty text has 0 bytes and 0 tokens; a null id stays; repeated rows each give a row; other columns are ignored, an empty table gives none.
    Texts of any script go through the two tiers; those with an added special string, with a character on whose class libraries may differ (see ``wide``), or for a vocabulary without pre-tokens (.model) go to the library whole.
    """
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, text_col, name))
    by_words = not name.endswith(".model")
    special = tuple(x.content for x in tokenizer(name).get_added_tokens_decoder().values()) if by_words else ()
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, rare = frequent.value.get, {}

        def counted(texts: list[str | None]) -> list[int]:
            tokens, waiting, new = [0] * len(texts), [], set()
            for k, text in enumerate(texts):
                if not text:
                    continue
                pieces = pre_tokens(text) if by_words and not any(s in text for s in special) else None
                if pieces is None:
                    tokens[k] = count_whole(name, text)
                    continue
                hit = list(map(first, pieces))
                if None in hit:
                    missed = [p for p, n in zip(pieces, hit, strict=True) if n is None]
                    new.update(p for p in missed if p not in rare)
                    waiting.append((k, missed))
                tokens[k] = sum(filter(None, hit))
            pieces = list(new)
            rare.update(zip(pieces, lengths(name, pieces), strict=True))
            for k, missed in waiting:
                tokens[k] += sum(map(rare.__getitem__, missed))
            for p in pieces:
                if len(p) > KEPT:
                    del rare[p]
            if len(rare) > CACHED:
                rare.clear()
            return tokens

        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                texts = part.column(1).to_pylist()
                tokens = counted(texts)
                sizes = [len(t.encode()) if t else 0 for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())], schema=schema)

    done = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("t")).mapInArrow(count, "id long, n_bytes long, n_tokens long, over_limit boolean")
    return done.withColumnRenamed("id", id_col)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
