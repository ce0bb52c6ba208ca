"""Cost-balanced packing of token ids into sequences of bounded length.

Attention over a piece of n tokens costs about ``n + n * n / length``: a linear and a quadratic part. Documents of a full
sequence or more fill sequences of their own; what remains of each document is assigned, in descending cost, to the sequence of
lowest cost that still has room. When no sequence has room for the whole piece it is cut and fills the gaps left, so all
sequences of a block but one are full.

A block is what a task packs at once: about ``BLOCK_TOKENS`` tokens of its own rows. Nothing is shuffled, no group can grow
hot, and a repeated task makes the same sequences again.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridloom.llm.common import map_arrow, slices, without_marks

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Tokens of a sequence.
LENGTH = 4096
#: Follows the ids of every document.
END_ID = 2
#: Tokens a task gathers before it packs them: the padding of a block is less than one sequence.
BLOCK_TOKENS = 2048 * LENGTH
#: Distinct words a worker keeps before those it has not met since the last time are forgotten: at most twice as many.
CACHED = 250_000
#: Small letters of Latin-1.
_LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha() and c.islower())
#: Bytes of text encoded at once.
ENCODED_BYTES = 2 << 20
#: Sequence ids of a task begin at its number times this.
_TASK_IDS = 1 << 36
_BIG_ENDIAN = sys.byteorder == "big"
_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"


@lru_cache(maxsize=4)
def _words(path: str) -> tuple[Tokenizer, dict[str, bytes], dict[str, bytes]]:
    """The tokenizer, and ids by word: those met lately and those met before; the worker keeps all."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # words come in lower case here; special tokens are taken out of the text before
    return tokenizer, {}, {}


@lru_cache(maxsize=4)
def _spelled(path: str) -> dict[int, str] | None:
    """How the tokenizer's model is given each small letter of Latin-1; none if words of them alone don't reach it whole."""
    tokenizer = _words(path)[0]
    if not tokenizer.pre_tokenizer or any(t.content.isalpha() for t in tokenizer.get_added_tokens_decoder().values()):
        return None
    cut = tokenizer.pre_tokenizer.pre_tokenize_str
    letters = {c: "".join(piece for piece, _ in cut(c)) for c in _LETTERS}
    for word in (*_LETTERS, _LETTERS, _LETTERS[::-1]):
        as_is = tokenizer.normalizer is None or tokenizer.normalizer.normalize_str(word) == word
        if not as_is or [piece for piece, _ in cut(word)] != ["".join(letters[c] for c in word)]:
            return None
    return {ord(c): piece for c, piece in letters.items()}


def _id_bytes(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes() if _BIG_ENDIAN else array("I", ids).tobytes()


def _encoded_parts(parts: list[str], path: str) -> dict[str, bytes]:
    """Ids of parts of words: words of small Latin letters go straight to the model, others through the whole tokenizer."""
    tokenizer, spelled = _words(path)[0], _spelled(path)
    whole, found = [], {}
    if spelled:
        split = tokenizer.model.tokenize
        for part in parts:
            if part.isalpha() and part.islower() and (part.isascii() or max(part) < "\u0100"):
                found[part] = _id_bytes([token.id for token in split(part.translate(spelled))])
            else:
                whole.append(part)
    else:
        whole = parts
    for part, encoding in zip(whole, tokenizer.encode_batch_fast(whole, add_special_tokens=False)):
        found[part] = _id_bytes(encoding.ids)
    return found


@lru_cache(maxsize=4)
def _special(path: str) -> tuple[re.Pattern | None, dict[str, bytes]]:
    """A pattern of the file's special tokens, which stand for themselves anywhere in a text, and their ids."""
    ids = {token.content: np.array([i], "<u4").tobytes() for i, token in _words(path)[0].get_added_tokens_decoder().items()}
    return re.compile("(" + "|".join(map(re.escape, sorted(ids, key=len, reverse=True))) + ")") if ids else None, ids


def _lowered(text: str) -> str:
    """The text in lower case where that is the tokenizer's own (it is blind to case): with Latin letters only."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


def encoded_texts(texts: list[str], path: str = TOKENIZER) -> list[bytes]:
    """Ids of texts as little-endian 32-bit numbers.

    The tokenizer drops white space, so words are looked up one by one; those not seen before are encoded together.
    """
    pattern, special = _special(path)
    cut = {i: parts for i, text in enumerate(texts) if pattern and len(parts := pattern.split(text)) > 1} if any("<" in t for t in texts) else {}
    if not cut:
        return _encoded_words(texts, path)
    plain = [part for i, text in enumerate(texts) for part in (cut[i] if i in cut else [text]) if part not in special]
    ids = iter(_encoded_words(plain, path))
    return [b"".join(special.get(part) or next(ids) for part in cut[i]) if i in cut else next(ids) for i in range(len(texts))]


def _encoded_words(texts: list[str], path: str) -> list[bytes]:
    """Ids of texts without special tokens."""
    _, known, before = _words(path)
    split = [_lowered(text.replace("\n", " ")).split(" ") for text in texts]
    words = set().union(*split)
    if len(known) > CACHED:  # words met again are worth keeping, most others never come back
        before.clear()
        before.update(known)
        known.clear()
    known[""] = b""
    known.update({word: before[word] for word in words if word in before and word not in known})
    new = [word for word in words if word not in known]
    cores = [without_marks(word) for word in new]
    parts = {part for word, core in zip(new, cores) for part in (core, word[len(core) :])}
    known.update({part: before[part] for part in parts if part in before and part not in known})
    known.update(_encoded_parts([part for part in parts if part not in known], path))
    for word, core in zip(new, cores):
        if len(core) < len(word):
            known[word] = known[core] + known[word[len(core) :]]
    return [b"".join(map(known.__getitem__, words)) for words in split]


def word_ids(text: str, path: str = TOKENIZER) -> bytes:
    """Ids of one text."""
    return encoded_texts([text], path)[0]


def piece_cost(tokens: int, length: int = LENGTH) -> float:
    return tokens + tokens * tokens / length


def assign(tokens: list[int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that hold all tokens of the documents of a block."""
    pieces, rest, used = [], [], 0
    for i, n in enumerate(tokens):
        for start in range(0, n - length + 1, length):
            pieces.append((i, start, length, used, 0))
            used += 1
        if n % length:
            rest.append((-(n % length), i))
    rest.sort()
    room = np.full(-(-sum(-n for n, _ in rest) // length), length)
    cost = np.zeros(len(room))

    def put(i: int, start: int, n: int, s: int) -> None:
        pieces.append((i, start, n, used + s, length - int(room[s])))
        room[s] -= n
        cost[s] += piece_cost(n, length)

    for negative, i in rest:
        n = -negative
        start = tokens[i] - n
        s = int(np.where(room >= n, cost, np.inf).argmin())
        if room[s] >= n:
            put(i, start, n, s)
            continue
        while n:  # no room for the whole: fill the widest gaps
            s = int(room.argmax())
            part = min(n, int(room[s]))
            put(i, start, part, s)
            start, n = start + part, n - part
    return pieces


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = TOKENIZER, length: int = LENGTH, block_tokens: int = BLOCK_TOKENS, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, cost`` and, if asked for, ``ids``.

    A null or empty text is the end id alone. A null id stays null, repeated rows are packed as often as they come, other
    columns are dropped. Ids of sequences are unique within one evaluation.
    """
    source = df.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    end = np.array([END_ID], "<u4").tobytes()

    def packed(block: list[tuple[int | None, bytes]], first: int) -> pa.RecordBatch:
        rows = assign([len(ids) // 4 for _, ids in block], length)
        bodies = [block[i][1][4 * start : 4 * (start + n)] for i, start, n, _, _ in rows]
        columns = [
            pa.array([block[r[0]][0] for r in rows], pa.int64()),
            *(pa.array(v, pa.int64()) for v in (
                [r[1] for r in rows], [r[2] for r in rows], [zlib.crc32(b) for b in bodies],
                [len(block[r[0]][1]) // 4 for r in rows], [first + r[3] for r in rows], [r[4] for r in rows],
            )),
            pa.array([piece_cost(r[2], length) for r in rows], pa.float64()),
        ]
        names = [c.split()[0] for c in _SCHEMA.split(", ")]
        if with_ids:
            columns.append(pa.array([np.frombuffer(b, "<i4").tolist() for b in bodies], pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, block, held = TaskContext.get().partitionId() * _TASK_IDS, [], 0
        for batch in slices(batches, 1, ENCODED_BYTES):
            for doc, ids in zip(batch.column(0).to_pylist(), encoded_texts(batch.column(1).to_pylist(), path)):
                ids += end
                block.append((doc, ids))
                held += len(ids) // 4
                if held >= block_tokens:
                    yield packed(block, first)
                    first, block, held = first + held // length + 1, [], 0
        if block:
            yield packed(block, first)

    return map_arrow(source, run, _SCHEMA + (", ids array<int>" if with_ids else ""))
