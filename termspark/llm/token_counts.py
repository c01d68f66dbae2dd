"""Exact token counts at every prefix of a text, by dynamic programming (operator 13).

Inside a piece of the pre-tokenizer, the encoding of a prefix ends with the one vocabulary
token that (a) is a suffix of the prefix and (b) may follow the last token of the encoding
of what lies before it.  So a single pass over the positions knows, for each, the last
token and the number of tokens.  Two tokens may follow each other if byte-pair merging of
their joined bytes gives them back; that holds unless, at some time in the order of the
merges, the token at the end of the left one and the token at the start of the right one
form a pair that merges before either is taken up by its own side.

Prefixes that end inside a run of white space, a contraction or the string of a special
token are cut into pieces differently from the whole text; they are counted the way the
library would count them.

The counts of a text are stored as one signed byte per character, the change of the count
(``prefixes``).  ``tokens_at`` and ``longest_prefix`` answer budget and truncation
questions from that column alone, and the sum of all changes is the count of the whole
text.  Parts of a text (white space and a word) are counted alone and kept in a bounded
cache, so a text is a lookup for each word.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tokens import PART, SPACE, ByteBpe, byte_bpe, kept, runs

LIMIT = 1024
CACHE_PARTS, CACHED_CHARS = 300_000, 64
#: pieces of up to so many bytes are passed over in step
IN_STEP = 40
PAIR_SLOTS = 1 << 20
_SPREAD = np.int64(0x1E3779B97F4A7C15)
_NEVER = 1 << 60


class PrefixCounter:
    """Token counts of all prefixes, for one byte-level vocabulary."""

    def __init__(self, bpe: ByteBpe):
        self.bpe = bpe
        self.longest = max(map(len, bpe.ranks))
        self.when = {pair: turn for turn, pair in reversed(list(enumerate(bpe.merges)))}
        self.halves: dict[bytes, tuple[bytes, bytes]] = {}
        for a, b in bpe.merges:
            self.halves.setdefault(a + b, (a, b))
        self.edges: tuple[dict, dict] = ({}, {})
        self.parts: dict[str, bytes] = {}
        self.child, self.token = self._trie()
        self.pair_keys, self.pair_values, self.pairs = np.full(PAIR_SLOTS, -1, np.int64), np.zeros(PAIR_SLOTS, np.int8), 0

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """Tokens at the end (side 1) or start (side 0) of ``token`` while it is merged, from
        the single byte up, each with the turn in which it is taken up."""
        known = self.edges[side].get(token)
        if known is None:
            known, inner = [(token, _NEVER)], token
            while inner in self.halves:
                turn = self.when[self.halves[inner]]
                inner = self.halves[inner][side]
                known.append((inner, turn))
            known.reverse()
            self.edges[side][token] = known
        return known

    def follows(self, left: bytes, right: bytes) -> bool:
        """Whether merging the joined bytes of two tokens gives the two tokens."""
        ends, starts, when = self.edge(left, 1), self.edge(right, 0), self.when
        i = j = 0
        while True:
            (x, gone_x), (y, gone_y) = ends[i], starts[j]
            turn = when.get((x, y), _NEVER)
            if turn < gone_x and turn <= gone_y:  # of equal pairs the left one merges first
                return False
            if gone_x == gone_y == _NEVER:
                return True
            if gone_x <= gone_y:
                i += 1
            else:
                j += 1

    def piece(self, text: str) -> list[int]:
        """Counts of the prefixes of one piece, by characters from 1 on."""
        data = text.encode("utf-8", "surrogatepass")
        ranks, follows, longest = self.bpe.ranks, self.follows, self.longest
        last, count = [b""], [0]
        for end in range(1, len(data) + 1):
            for start in range(end - longest if end > longest else 0, end):
                token = data[start:end]
                if token in ranks and (not start or follows(last[start], token)):
                    last.append(token)
                    count.append(count[start] + 1)
                    break
            else:
                raise ValueError(f"the vocabulary cannot spell {data[:end]!r}")
        if len(data) == len(text):
            return count[1:]
        ends = accumulate(len(c.encode("utf-8", "surrogatepass")) for c in text)
        return [count[e] for e in ends]

    def contraction(self, piece: str, own: list[int]) -> list[int]:
        """Counts of a piece; a beginning of 're, 've or 'll is no contraction yet."""
        return [*(self.whole(piece[:k]) for k in range(1, len(piece))), own[-1]] if piece in ("'re", "'ve", "'ll") else own

    def pieces(self, texts: list[str]) -> list[bytes]:
        """Changes of the count in many pieces: the pass of ``piece`` in step over all
        pieces of about the same length, walking the vocabulary's trie from each start."""
        data = [t.encode("utf-8", "surrogatepass") for t in texts]
        out = [b""] * len(texts)
        size = np.array([len(d) for d in data])
        for least, most in ((1, 6), (7, 9), (10, 13), (14, 20), (21, IN_STEP)):
            at = np.flatnonzero((size >= least) & (size <= most))
            if not len(at):
                continue
            rows = np.frombuffer(b"".join(data[i].ljust(most, b"\0") for i in at.tolist()), dtype=np.uint8).reshape(len(at), most)
            count = self._in_step(rows, size[at])
            # a character ends where the next byte begins another one
            ends = np.arange(most) < size[at, None]
            ends[:, :-1] &= ((rows[:, 1:] & 0xC0) != 0x80) | (np.arange(1, most) >= size[at, None])
            flat, owner = count[:, 1:][ends], np.nonzero(ends)[0]
            first = np.concatenate([[True], owner[1:] != owner[:-1]])
            change = (flat - np.where(first, 0, np.concatenate([[0], flat[:-1]]))).astype(np.int8).tobytes()
            cut = np.concatenate([np.flatnonzero(first), [len(flat)]]).tolist()
            for k, i in enumerate(at.tolist()):
                out[i] = change[cut[k]:cut[k + 1]]
        for i in np.flatnonzero(size > IN_STEP).tolist():
            out[i] = _changes(self.piece(texts[i]))
        for i, t in enumerate(texts):
            if t in ("'re", "'ve", "'ll"):
                out[i] = _changes(self.contraction(t, self.piece(t)))
        return out

    def _in_step(self, rows: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Token counts of all prefixes of all rows (bytes, each ``size`` long)."""
        width = rows.shape[1]
        count, last = np.zeros((len(rows), width + 1), np.int32), np.zeros((len(rows), width + 1), np.int64)
        for start in range(width):
            who = np.flatnonzero(size > start)
            node = np.zeros(len(who), np.int32)
            for end in range(start + 1, width + 1):
                node = self.child[node, rows[who, end - 1]]
                token = self.token[node]
                new = np.flatnonzero((token >= 0) & (count[who, end] == 0))
                if start and len(new):
                    new = new[self._all_follow(last[who[new], start], token[new])]
                count[who[new], end] = count[who[new], start] + 1
                last[who[new], end] = token[new]
                on = np.flatnonzero((node > 0) & (node < len(self.child)) & (size[who] > end))
                if not len(on):
                    break
                who, node = who[on], node[on]
        return count

    def _all_follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``follows`` for arrays of ids, from the table of pairs asked for before."""
        pair = left << 32 | right
        known = np.full(len(pair), -1, np.int8)
        open_, at = np.arange(len(pair)), (pair * _SPREAD >> 40 & (PAIR_SLOTS - 1))
        while len(open_):
            here = self.pair_keys[at]
            hit = here == pair[open_]
            known[open_[hit]] = self.pair_values[at[hit]]
            on = ~hit & (here >= 0)
            open_, at = open_[on], (at[on] + 1) & (PAIR_SLOTS - 1)
        new = np.flatnonzero(known < 0)
        if len(new):
            asked, where = np.unique(pair[new], return_inverse=True)
            bytes_of = self.bpe.bytes_of
            found = np.array([self.follows(bytes_of[p >> 32], bytes_of[p & 0xFFFFFFFF]) for p in asked.tolist()], dtype=np.int8)
            known[new] = found[where]
            self._remember(asked, found)
        return known == 1

    def _remember(self, pairs: np.ndarray, values: np.ndarray) -> None:
        if self.pairs + len(pairs) > PAIR_SLOTS // 2:
            self.pair_keys[:] = -1
            self.pairs = 0
            pairs, values = pairs[:PAIR_SLOTS // 2], values[:PAIR_SLOTS // 2]
        self.pairs += len(pairs)
        at = pairs * _SPREAD >> 40 & (PAIR_SLOTS - 1)
        while len(pairs):
            free = np.flatnonzero(self.pair_keys[at] < 0)
            slot, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.pair_keys[slot], self.pair_values[slot] = pairs[put], values[put]
            on = np.ones(len(pairs), bool)
            on[put] = False
            pairs, values, at = pairs[on], values[on], (at[on] + 1) & (PAIR_SLOTS - 1)

    def _trie(self) -> tuple[np.ndarray, np.ndarray]:
        """The vocabulary as a trie: child by (node, byte), 0 for none, and the token of a node
        (-1 for none).  Nodes with children come first, so only they need a row."""
        tokens = sorted(self.bpe.ranks)
        prefixes = {t[:k] for t in tokens for k in range(len(t))}
        nodes = sorted(prefixes, key=lambda p: (len(p) > 0, p)) + sorted(t for t in tokens if t not in prefixes)
        number = {p: i for i, p in enumerate(nodes)}
        child, token = np.zeros((len(prefixes), 256), np.int32), np.full(len(nodes), -1, np.int64)
        for p, i in number.items():
            if p:
                child[number[p[:-1]], p[-1]] = i
            token[i] = self.bpe.ranks.get(p, -1)
        return child, token

    def whole(self, text: str) -> int:
        return sum(self.piece(text[a:b])[-1] for a, b in self.bpe.pieces(text))

    def changes(self, part: str) -> bytes:
        """Change of the count with each character of a part."""
        blank = len(part) - len(part.lstrip(SPACE))
        count = self.piece(part[:blank]) if blank else []
        before = 0
        for a, b in self.bpe.pieces(part) if blank < len(part) else ():
            own = self.piece(part[a:b])
            count += [before + c for c in self.contraction(part[a:b], own)[max(0, blank - a):]]
            before += own[-1]
        return _changes(count)

    def learn(self, texts: list[str]) -> dict[str, bytes]:
        """The changes of all parts of ``texts``."""
        if len(self.parts) >= CACHE_PARTS:
            self.parts.clear()
        new = list(set().union(*map(PART.findall, texts)) - self.parts.keys())
        # one white space in front is a piece's start or a piece, a longer run changes with what follows
        plain = [p for p in new if len(p) < 2 or p[1] not in SPACE]
        cut = [self.bpe.cut(p) for p in plain]
        pieces = list(set().union(*cut))
        of = dict(zip(pieces, self.pieces(pieces)))
        learnt = {p: b"".join([of[x] for x in c]) for p, c in zip(plain, cut)}
        for p in set(new).difference(plain):
            learnt[p] = self.changes(p)
        if any(len(p) > CACHED_CHARS for p in new):
            self.parts.update((p, c) for p, c in learnt.items() if len(p) <= CACHED_CHARS)
            return {**self.parts, **learnt}
        self.parts.update(learnt)
        return self.parts

    def section(self, text: str, known: dict[str, bytes]) -> bytes:
        """Changes in a text without special tokens."""
        get = known.get
        return b"".join([get(p) or self.changes(p) for p in PART.findall(text)])

    def text(self, text: str, known: dict[str, bytes]) -> bytes:
        """Changes in a text; strings of special tokens are one token each."""
        if self.bpe.specials is None or not any(s in text for s in self.bpe.special_ids):
            return self.section(text, known)
        out, at = [], 0
        for found in self.bpe.specials.finditer(text):
            own = self.section(text[at:found.start()], known)
            # while the string is not whole, it is ordinary text behind what came before
            open_ = self.section(text[at:found.end() - 1], known)
            out += [open_, np.int8(_sum(own) + 1 - _sum(open_)).tobytes()]
            at = found.end()
        return b"".join([*out, self.section(text[at:], known)])

    def texts(self, texts: list[str | None]) -> list[bytes]:
        known = self.learn([t for t in texts if t])
        return [self.text(t, known) if t else b"" for t in texts]


def _changes(counts: list[int]) -> bytes:
    return array("b", [c - b for b, c in zip([0, *counts], counts)]).tobytes()


def _sum(changes: bytes) -> int:
    return int(np.frombuffer(changes, dtype=np.int8).sum(dtype=np.int64))


def counter(path: str) -> PrefixCounter:
    return kept("prefix-counter", path, lambda: PrefixCounter(byte_bpe(path)))


def count(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes (UTF-8), n_tokens, over_limit (n_tokens >
    ``limit``) and ``prefixes`` (binary: one signed byte per character, the change of the
    token count).

    Strings of special tokens inside a text are those tokens, as the library has it by
    default.  Null and empty texts have no tokens; texts of any length are read whole; null
    keys stay null; repeated rows are counted one by one; an empty table gives no rows;
    other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(tokenizer)
        for batch in batches:
            for first, texts in runs(batch, 2):
                found = counts.texts(texts)
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), batch.column(1).slice(first, n),
                     pa.array(list(map(_sum, found)), pa.int64()), pa.array(found, pa.binary())],
                    names=[key, "n_bytes", "n_tokens", "prefixes"])

    body = F.col(text).cast("string")
    rows = docs.select(F.col(key), F.coalesce(F.octet_length(body), F.lit(0)).cast("long").alias("n_bytes"), body)
    out = rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, n_bytes long, n_tokens long, prefixes binary")
    return out.select(F.col(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "prefixes")


def _ask(answer, questions: Column, prefixes: Column, result: str) -> Column:
    @F.pandas_udf(result)
    def run(stored, asked):
        import pandas as pd
        return pd.Series([None if p is None or q is None or q != q else
                          answer(np.cumsum(np.frombuffer(p, dtype=np.int8), dtype=np.int64), int(q))
                          for p, q in zip(stored, asked)], dtype="Int64")
    return run(prefixes, questions)


def tokens_at(prefixes: Column, chars: Column) -> Column:
    """Tokens of the first ``chars`` characters (all, if there are fewer; none below one)."""
    return _ask(lambda c, n: int(c[min(n, len(c)) - 1]) if n > 0 and len(c) else 0, chars.cast("long"), prefixes, "long")


def longest_prefix(prefixes: Column, budget: Column) -> Column:
    """Characters of the longest prefix that has at most ``budget`` tokens."""
    def answer(c: np.ndarray, tokens: int) -> int:
        fits = np.flatnonzero(c <= tokens)
        return int(fits[-1]) + 1 if tokens > 0 and len(fits) else 0
    return _ask(answer, budget.cast("long"), prefixes, "long")
