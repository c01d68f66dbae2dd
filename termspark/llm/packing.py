"""Cost-balanced packing of token sequences (operator 4).

Documents become token ids (whole text, one end id).  A task reads its rows in blocks
of about ``BLOCK_TOKENS`` ids and packs each block for itself: sequences with exactly as
much room as the block has ids, all of ``max_tokens`` but for the powers of two that
make up the remainder, so no sequence needs padding.  Documents go in by descending
length, each to the sequence of lowest cost that still holds it, where the cost of a
piece is ``LINEAR * length + QUADRATIC * length**2`` (attention stays inside a piece).
A document longer than every room left is cut: the lowest-cost sequence with any room
takes what fits, and the rest goes on.

Nothing is shuffled, a task holds one block, costs are balanced inside a block only, and a task that runs again on the same
rows gives the same pieces.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import byte_bpe, byte_level

MAX_TOKENS = 1024
BLOCK_TOKENS = 1 << 20
LINEAR, QUADRATIC = 1.0, 1.0 / 256
END_ID = 0
CACHE_WORDS = 400_000

PIECES = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def encoder(path: str) -> Callable[[str], bytes]:
    """text -> ids as little-endian 32-bit integers, for the tokenizer file ``path``: those
    of the library without added tokens, so the string of a special token is that token.

    A byte-level BPE is run word by word with a cache: a single space or line feed between
    two other characters always starts a new token, so a text without longer gaps can be
    cut there.  Any other tokenizer runs as it is.  The cache lives as long as the encoder.
    """
    with open(path, encoding="utf-8") as f:
        plain = byte_level(json.load(f))
    if not plain:
        from tokenizers import Tokenizer
        whole = Tokenizer.from_file(path)
        whole.no_truncation(), whole.no_padding()
        return lambda text: _packed(whole.encode(text, add_special_tokens=False).ids)

    bpe = byte_bpe(path)
    cache: dict[str, bytes] = {}

    def words(text: str) -> bytes:
        n = len(found := text.split())
        if not n or sum(map(len, found)) + n - 1 != len(text) or text.count(" ") + text.count("\n") != n - 1:
            return _packed(bpe.ids(text))
        first, *parts = text.replace("\n", " \n").split(" ")
        out = [_packed(bpe.ids(first)), *map(cache.get, parts)]
        for i, x in enumerate(out):
            if x is None:
                part = parts[i - 1]
                x = cache.get(part)
                if x is None:
                    if len(cache) >= CACHE_WORDS:
                        cache.clear()
                    x = cache[part] = _packed(bpe.ids(part if part[0] == "\n" else " " + part))
                out[i] = x
        return b"".join(out)

    def encode(text: str) -> bytes:
        if bpe.specials is None or not any(s in text for s in bpe.special_ids):
            return words(text)
        out, at = [], 0
        for found in bpe.specials.finditer(text):
            out += [words(text[at:found.start()]), _packed([bpe.special_ids[found.group()]])]
            at = found.end()
        return b"".join([*out, words(text[at:])])

    return encode


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def assign(lengths: list[int], max_tokens: int = MAX_TOKENS) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one block of documents."""
    total = sum(lengths)
    rest = total % max_tokens
    room = np.array([max_tokens] * (total // max_tokens) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1],
                    dtype=np.int64)
    used, cost, pieces = np.zeros_like(room), np.zeros(len(room)), []
    for doc in sorted(range(len(lengths)), key=lambda d: -lengths[d]):
        start, left = 0, lengths[doc]
        while left:
            fits = room >= min(left, max_tokens)
            if not fits.any():
                fits = room > 0
            at = int(np.where(fits, cost, np.inf).argmin())
            n = int(min(left, room[at]))
            pieces.append((doc, start, n, at, int(used[at])))
            used[at] += n
            room[at] -= n
            cost[at] += LINEAR * n + QUADRATIC * n * n
            start, left = start + n, left - n
    return pieces


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
         max_tokens: int = MAX_TOKENS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per piece: key, start, length, doc_tokens, sequence_id, offset, ids
    (binary, little-endian 32-bit).

    Null and empty texts are one end id; a null key stays null; repeated rows are packed
    one by one; an empty table gives no rows; other columns are ignored.
    """
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encode, end = encoder(tokenizer), np.array([END_ID], dtype="<u4").tobytes()
        next_id = TaskContext.get().partitionId() << 32
        keys, ids, held = [], [], 0

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal next_id
            pieces = assign([len(x) // 4 for x in ids], max_tokens)
            for lo in range(0, len(pieces), 4096):
                part = pieces[lo:lo + 4096]
                yield pa.RecordBatch.from_arrays([
                    pa.array([keys[d] for d, *_ in part], key_type), pa.array([s for _, s, *_ in part], pa.int64()),
                    pa.array([n for _, _, n, *_ in part], pa.int64()), pa.array([len(ids[d]) // 4 for d, *_ in part], pa.int64()),
                    pa.array([next_id + q for *_, q, _ in part], pa.int64()), pa.array([o for *_, o in part], pa.int64()),
                    pa.array([ids[d][4 * s:4 * (s + n)] for d, s, n, *_ in part], pa.binary())],
                    names=[key, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
            next_id += 1 + max((q for *_, q, _ in pieces), default=-1)

        for batch in batches:
            key_type = batch.schema.field(0).type
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys.append(k)
                ids.append(encode(t.as_py() or "") + end)
                held += len(ids[-1]) // 4
                if held >= block_tokens:
                    yield from block()
                    keys, ids, held = [], [], 0
        if ids:
            yield from block()

    rows = docs.select(F.col(key), F.col(text).cast("string"))
    return rows.mapInArrow(packed, f"`{key}` {rows.schema[0].dataType.simpleString()}, {PIECES}")
