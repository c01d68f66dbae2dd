"""Public tokenizers inside tasks: vocabulary bytes, ids, and parts of a text that tokenize alone.

A *part* is a run of white space with the word after it.  In a byte-level vocabulary with
the pre-tokenizer below, white space after any other character always starts a new token,
and no piece of a sentence-piece vocabulary may hold a space or line feed after another
character (checked when it is loaded), so a text's tokens are those of its parts, in order.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Callable, Iterator
from types import ModuleType
from typing import Any

import pyarrow as pa

#: fixed values: the pre-tokenizer of byte-level BPE vocabularies of this kind
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: fixed values: the characters with the Unicode property White_Space
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_RARE = "".join(c for c in SPACE if c not in " \n")
#: cut in front of any white space after another character
PART = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: cut only in front of a space or line feed after another character
WIDE_PART = re.compile(f"[{SPACE}]*[^{SPACE}]+(?:[{_RARE}][{SPACE}]*[^{SPACE}]+)*(?:[{_RARE}][{SPACE}]*\\Z)?|[{SPACE}]+")
#: below this character all Unicode versions agree on letters, numbers and white space
_SETTLED = "\u0530"


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable bytes for
    themselves, the others by the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def kept(name: str, token: Any, make: Callable[[], Any]) -> Any:
    """One object per Python process under ``name``, made anew when ``token`` changes: task
    functions travel by value, so their own globals do not outlive a task."""
    store = vars(sys.modules.setdefault("_kept_by_tasks", ModuleType("_kept_by_tasks")))
    if name not in store or store[name][0] != token:
        store.pop(name, None)
        store[name] = (token, make())
    return store[name][1]


class ByteBpe:
    """A byte-level BPE from a ``tokenizers`` file.

    ``ids`` takes strings of special tokens for ordinary text; ``specials`` matches them
    (None without any), for callers that treat them as the library does by default.
    """

    def __init__(self, path: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if not byte_level(spec):
            raise ValueError(f"{path}: not a byte-level BPE with the usual pre-tokenizer")
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.library.no_truncation(), self.library.no_padding()
        self.special_ids = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        longest_first = sorted(self.special_ids, key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None
        byte_of = byte_alphabet()
        self.ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special_ids}
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        #: left and right bytes in the order of the merges
        self.merges = [(bytes(byte_of[c] for c in a), bytes(byte_of[c] for c in b)) for a, b in pairs]
        self._pattern = regex.compile(PATTERN)
        self._fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.settled(text):
            return self._fast.encode_ordinary(text)
        return self.library.encode(text, add_special_tokens=False).ids

    def settled(self, text: str) -> bool:
        """Whether ``ids`` need not ask the slower library."""
        return text.isascii() or max(text) < _SETTLED

    def pieces(self, text: str) -> list[tuple[int, int]]:
        """Spans of the pre-tokenizer, in characters."""
        if self.settled(text):
            return [m.span() for m in self._pattern.finditer(text)]
        return [span for _, span in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def cut(self, part: str) -> list[str]:
        """Pieces of a part: mostly a word, or a word and a mark."""
        if self.settled(part):
            if part[1:].isalpha() and part[0] == " ":
                return [part]
            if part[-1] in ".,;:!?" and part[1:-1].isalpha() and part[0] == " ":
                return [part[:-1], part[-1]]
        return [part[a:b] for a, b in self.pieces(part)]


def byte_level(spec: dict) -> bool:
    """Whether a tokenizer file is a byte-level BPE that ``ByteBpe`` can run."""
    pre = spec.get("pre_tokenizer") or {}
    return (spec["model"].get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
            and pre.get("use_regex", True) and not spec.get("normalizer")
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", ())))


class SentencePieces:
    """A sentence-piece vocabulary: ids of a part, bytes of an id."""

    def __init__(self, path: str):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(size)]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace("▁", " ").encode()
                         for i, p in enumerate(names)]
        #: a text may be cut in front of a space or line feed
        self.cuts = not any(re.search("[^▁ \n][▁ \n]", p) for i, p in enumerate(names) if not self.library.is_byte(i))
        self._mark = self.library.encode("a")

    def ids(self, parts: str) -> list[int]:
        """Ids of a run of parts of space + text.  The library adds a space in front, which
        stands for the one the run begins with; any other run is put behind a letter whose
        ids are taken off again."""
        if len(parts) > 1 and parts[0] == " ":
            return self.library.encode(parts[1:])
        return self.library.encode("a" + parts)[len(self._mark):]


def byte_bpe(path: str) -> ByteBpe:
    return kept("byte-bpe", path, lambda: ByteBpe(path))


def sentence_pieces(path: str) -> SentencePieces:
    return kept("sentence-pieces", path, lambda: SentencePieces(path))


def runs(batch: pa.RecordBatch, column: int, chars: int = 1 << 20) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of runs of rows with at most about ``chars`` characters of text."""
    first, some, held = 0, [], 0
    for at, value in enumerate(batch.column(column)):
        text = value.as_py()
        some.append(text)
        held += len(text or "")
        if held >= chars:
            yield first, some
            first, some, held = at + 1, [], 0
    if some:
        yield first, some
