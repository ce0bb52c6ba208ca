"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The rank file (base64 token, rank) becomes a model of the library: every byte has a printable character, a token is the
string of its bytes' characters, and every way to join two tokens into a third is a merge with the rank of the third. A
match of the split pattern that is a token itself is taken whole, as rank-based encoders do.

Texts are cut at places where the split pattern always ends a match (before a space or line end), so ids of a cut are
kept in a bounded cache per worker and most of the corpus is looked up instead of merged again.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from gridloom.llm.common import WordCache, map_arrow, slices, without_marks

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Distinct cuts a worker keeps.
CACHED = 700_000
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Unions of whole matches of the split pattern: an optional space with what follows it, or white space.
_CUTS = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else the next free one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@lru_cache(maxsize=4)
def token_bytes(path: str = RANKS) -> tuple[bytes, ...]:
    """Bytes of each id."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            token, rank = line.split()
            ranks[int(rank)] = base64.b64decode(token)
    return tuple(ranks.get(i, b"") for i in range(max(ranks) + 1))


@lru_cache(maxsize=4)
def rank_tokenizer(path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> Tokenizer:
    """The library's tokenizer for a rank file."""
    to_char = byte_characters()
    tokens = token_bytes(path)
    known = {t: i for i, t in enumerate(tokens) if t}
    shown = {t: "".join(to_char[b] for b in t) for t in known}
    merges = [
        (shown[t[:cut]], shown[t[cut:]])
        for t in tokens  # in the order of their ranks
        for cut in range(len(t) - 1, 0, -1)
        if t[:cut] in known and t[cut:] in known
    ]
    model = models.BPE({shown[t]: i for t, i in known.items()}, merges, ignore_merges=True)
    made = Tokenizer(model)
    made.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return made


@lru_cache(maxsize=4)
def _cache(path: str) -> WordCache:
    encode = rank_tokenizer(path).encode

    def compute(cut: str) -> bytes:
        core = without_marks(cut)
        if core != cut:
            return cache[core] + cache[cut[len(core):]]
        return np.array(encode(cut, add_special_tokens=False).ids, "<u4").tobytes()

    cache = WordCache(compute, CACHED)
    return cache


def encode_text(text: str, path: str = RANKS) -> bytes:
    """Ids of a text as little-endian 32-bit numbers."""
    return b"".join(map(_cache(path).__getitem__, _CUTS.findall(text)))


def character_offsets(text: str, ids: np.ndarray, path: str = RANKS) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token and the character after its last.

    A token that begins or ends inside a character reaches over the whole of it, so neighbours may share a split one.
    """
    tokens = token_bytes(path)
    ends = np.cumsum([len(tokens[i]) for i in ids], dtype=np.int64)
    leads = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
    of_byte = np.cumsum(leads) - 1
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    return of_byte[starts].astype(np.int32), (of_byte[ends - 1] + 1).astype(np.int32)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = RANKS, offsets: bool = False) -> DataFrame:
    """``id_col``, ``ids`` and, if asked for, ``starts`` and ``ends`` in characters.

    A null or empty text has no ids; a null id stays null; repeated rows give repeated rows; other columns are dropped.
    Special tokens are ordinary text. Nothing is shuffled.
    """
    source = df.select(F.col(id_col).cast("long").alias(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    ints = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            texts = batch.column(1).to_pylist()
            ids = [encode_text(t, path) for t in texts]
            columns = [batch.column(0), _lists([len(x) // 4 for x in ids], np.frombuffer(b"".join(ids), "<i4"))]
            names = [id_col, "ids"]
            if offsets:
                spans = [character_offsets(t, np.frombuffer(x, "<u4"), path) if x else (np.empty(0, np.int32),) * 2 for t, x in zip(texts, ids)]
                columns += [pa.array([s[k].tolist() for s in spans], ints) for k in (0, 1)]
                names += ["starts", "ends"]
            yield pa.RecordBatch.from_arrays(columns, names)

    more = ", starts array<int>, ends array<int>" if offsets else ""
    return map_arrow(source, run, f"`{id_col}` long, ids array<int>{more}")


def _lists(lengths: list[int], values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), pa.array(values, pa.int32()))


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str = RANKS) -> DataFrame:
    """``id_col``, ``ids_col``, ``decoded`` (exact bytes) and ``decoded_text``.

    A cut through a character leaves bytes that are no UTF-8; they stay in ``decoded`` and read as U+FFFD in the text. A
    null list decodes to nothing; an unknown or null id is an error.
    """
    source = df.select(F.col(id_col), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias(ids_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_bytes(path)
        for batch in batches:
            lists = batch.column(1)
            for at in range(0, batch.num_rows, 512):  # bounded lists of Python numbers
                part = lists.slice(at, 512)
                decoded = [b"".join(map(tokens.__getitem__, x)) for x in part.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 512), part, pa.array(decoded, pa.binary()), pa.array([x.decode("utf-8", "replace") for x in decoded], pa.string())],
                    [id_col, ids_col, "decoded", "decoded_text"],
                )

    return map_arrow(source, run, f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, `{ids_col}` array<int>, decoded binary, decoded_text string")
