"""Alignment of two tokenizers over a corpus, with minimal perfect hashing (operator 12).

Tokenizer A (byte-level BPE) encodes space + text, tokenizer B (sentence pieces, which adds
the space) the text.  Where a token of both ends at the same byte, a *group* ends; every
pair of an A and a B token whose bytes overlap is a *link*, and a pair of ids counts its
links over the whole corpus.

First pass.  Tasks align their documents and write what they counted, one row per pair of
ids that they met.

Minimal perfect hash.  The distinct pairs fall into buckets by B id; each bucket is hashed
for itself, level by level: a pair that is alone in its slot of a level's bitmap sets the
bit, the others go on to the next level.  The rank of a pair's bit among all set bits is
its slot, so slots are dense and the hash costs a few bits a pair.

Dense counts.  What the tasks counted becomes dense vectors over the slots, in blocks of
``SLOTS_PER_BLOCK``, which are summed up a tree of fan-in ``FAN_IN``.

Second pass.  Documents are aligned again; each link's pair is hashed, the key stored at
its slot is compared with it, and its count and whether that is the highest of its B id
are read there.

The number of distinct pairs is bounded by the vocabularies, not by the corpus, but both
vocabularies together could make more than fit: pairs are taken in slices of about
``SLICE_PAIRS`` (all pairs of a B id in one slice), a second pass for each.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, workers
from .ngram_join import mix
from .tokens import SPACE, WIDE_PART, byte_bpe, kept, runs, sentence_pieces

BUCKET_PAIRS = 1 << 16
SLICE_PAIRS = 1 << 22
SLOTS_PER_BLOCK = 1 << 16
FAN_IN = 16
#: parts and characters that a task keeps what it learnt of, parts encoded in one call, characters read at a time
CACHE_PARTS, CACHE_CHARS = 400_000, 48 << 20
RUN_PARTS, RUN_CHARS = 20_000, 1 << 20
DONE = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
_LOW = np.int64(0xFFFFFFFF)


# ---- alignment of parts ----------------------------------------------------------

class Aligned:
    """Alignment of parts: ``sizes`` by part (n_a, n_b, n_groups, n_links; -1 where a
    tokenizer changes the part), the pairs of all links in the order of their parts, and by
    part the groups as text, if asked for."""

    def __init__(self, parts: int):
        self.sizes = np.full((parts, 4), -1, np.int64)
        self.groups: list[str] = [""] * parts
        self._runs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, run: list[int], sizes: np.ndarray, pairs: np.ndarray) -> None:
        self.sizes[run] = sizes
        self._runs.append((np.repeat(np.array(run), sizes[:, 3]), pairs))

    @property
    def pairs(self) -> np.ndarray:
        if not self._runs:
            return np.zeros(0, np.int64)
        part, pairs = (np.concatenate(x) for x in zip(*self._runs))
        return pairs[np.argsort(part, kind="stable")]


class Aligner:
    """Both tokenizers over parts of space + text.  Parts tokenize alone, so a run of them is
    encoded in one call and cut at their ends."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = byte_bpe(path_a), sentence_pieces(path_b)
        self.bytes_a, self.bytes_b = self.a.bytes_of, self.b.bytes_of
        top = max(self.bytes_a) + 1
        self.size_a = np.array([len(self.bytes_a.get(i, b"")) for i in range(top)], dtype=np.int64)
        self.size_b = np.array(list(map(len, self.bytes_b)), dtype=np.int64)

    def split(self, text: str) -> list[str]:
        whole = " " + text
        return WIDE_PART.findall(whole) if self.b.cuts else [whole]

    def align(self, parts: list[str], groups: bool = False) -> Aligned:
        out = Aligned(len(parts))
        # only a part that ends in another character than white space can have one behind it
        runs: tuple[list, list] = ([], [])
        for i, p in enumerate(parts):
            if not self.b.cuts or p[-1] in SPACE:
                self._run(parts, [i], out, groups)
            else:
                runs[self.a.settled(p)].append(i)
        for run in runs:
            for at in range(0, len(run), RUN_PARTS):
                self._run(parts, run[at:at + RUN_PARTS], out, groups)
        return out

    def _run(self, parts: list[str], run: list[int], out: Aligned, texts: bool) -> None:
        text = "".join([parts[i] for i in run])
        data = text.encode()
        a, b = self.a.ids(text), self.b.ids(text)
        if b"".join([self.bytes_b[i] for i in b]) != data or b"".join([self.bytes_a[i] for i in a]) != data:
            if len(run) > 1:  # which parts are changed?
                self._run(parts, run[:len(run) // 2], out, texts)
                self._run(parts, run[len(run) // 2:], out, texts)
            return
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        end = np.cumsum([len(parts[i].encode()) for i in run]) if len(data) != len(text) else np.cumsum([len(parts[i]) for i in run])
        # every stretch between two neighbouring token ends is one link
        cut = np.union1d(end_a, end_b)
        pairs = a[np.searchsorted(end_a, cut)] << 32 | b[np.searchsorted(end_b, cut)]
        groups = np.intersect1d(end_a, end_b, assume_unique=True)
        upto = [np.searchsorted(x, end, side="right") for x in (end_a, end_b, groups, cut)]
        out.add(run, np.column_stack([np.diff(x, prepend=0) for x in upto]), pairs)
        if not texts:
            return
        # tokens in order of group, tokenizer and place, and what stands behind each
        ids, side = np.concatenate([a, b]), np.repeat(np.array([0, 1]), [len(a), len(b)])
        group = np.searchsorted(groups, np.concatenate([end_a, end_b]))
        order = np.argsort(group * 2 + side, kind="stable")
        group, side = group[order], side[order]
        mark = np.where(group[1:] != group[:-1], 2, np.where(side[1:] != side[:-1], 1, 0)).tolist()
        shown = [f"{i}{',|;'[m]}" for i, m in zip(ids[order].tolist(), [*mark, 2])]
        tokens = [0, *(upto[0] + upto[1]).tolist()]
        for k, i in enumerate(run):
            out.groups[i] = "".join(shown[tokens[k]:tokens[k + 1]])[:-1]


class Known:
    """A bounded table of parts: the row of a part (-1 where a tokenizer changes it), and by
    row what ``learn`` made of it: numbers (an array of columns, the fourth counts links),
    one text, the links' pairs (all rows' or none's), and how often it was asked for."""

    def __init__(self, learn, columns: int):
        self.learn, self.row, self.chars = learn, {}, 0
        self.numbers, self.times = np.zeros((0, columns), np.int64), np.zeros(0, np.int64)
        self.texts: list[str] = []
        self.pairs = [np.zeros(0, np.int64)]

    def full(self) -> bool:
        return len(self.row) >= CACHE_PARTS or self.chars >= CACHE_CHARS

    def trim(self) -> None:
        """Keep the parts that were asked for again, if they are few enough."""
        keep = self.times >= 2
        held = {p: r for p, r in self.row.items() if r >= 0 and keep[r]}
        chars = sum(map(len, held)) + sum(len(t) for t, k in zip(self.texts, keep.tolist()) if k)
        if len(held) > CACHE_PARTS // 2 or chars > CACHE_CHARS // 2:
            held, chars, keep = {}, 0, np.zeros(len(self.times), bool)
        at = np.cumsum(keep) - 1
        self.row, self.chars = dict(zip(held, at[list(held.values())].tolist())) if held else {}, chars
        pairs = np.concatenate(self.pairs)
        self.pairs = [pairs[np.repeat(keep, self.numbers[:, 3])] if len(pairs) else pairs]
        self.texts = [t for t, k in zip(self.texts, keep.tolist()) if k]
        self.numbers, self.times = self.numbers[keep], np.zeros(int(keep.sum()), np.int64)

    def rows(self, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of all parts, one document after another, and how many of them each document
        has; a document of which a tokenizer changes a part has none."""
        parts = list(chain.from_iterable(docs))
        found = list(map(self.row.get, parts))
        if None in found:
            new = list({p for p, r in zip(parts, found) if r is None})
            fine, numbers, texts, pairs = self.learn(new)
            at = len(self.numbers) + np.cumsum(fine) - 1
            self.row.update(zip(new, np.where(fine, at, -1).tolist()))
            self.numbers = np.concatenate([self.numbers, numbers])
            self.times = np.concatenate([self.times, np.zeros(len(numbers), np.int64)])
            self.texts += texts
            self.pairs.append(pairs)
            self.chars += sum(map(len, new)) + sum(map(len, texts))
            row = self.row
            found = [row[p] if r is None else r for p, r in zip(parts, found)]
        at, size = np.array(found, dtype=np.int64), np.array(list(map(len, docs)), dtype=np.int64)
        some = np.flatnonzero(size)
        if len(some):
            changed = some[np.minimum.reduceat(at, (np.cumsum(size) - size)[some]) < 0]
            whole = np.ones(len(docs), bool)
            whole[changed] = False
            at, size = at[np.repeat(whole, size)], np.where(whole, size, 0)
        self.times += np.bincount(at, minlength=len(self.times))
        return at, size


# ---- first pass ------------------------------------------------------------------

def _count_links(path_a: str, path_b: str):
    """Task function: texts -> (pair, n), a pair once for each time that the table of parts is full."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept("aligner", (path_a, path_b), lambda: Aligner(path_a, path_b))

        def learn(parts: list[str]):
            found = aligner.align(parts)
            fine = found.sizes[:, 0] >= 0
            return fine, found.sizes[fine], [], found.pairs

        known = kept("aligned-parts", (path_a, path_b), lambda: Known(learn, 4))
        known.times[:] = 0  # of a task that was lost
        pairs, total = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def add() -> None:
            """Parts seen become links counted."""
            nonlocal pairs, total
            each = np.repeat(known.times, known.numbers[:, 3])
            pairs, where = np.unique(np.concatenate([pairs, *known.pairs]), return_inverse=True)
            sums = np.zeros(len(pairs), np.int64)
            np.add.at(sums, where, np.concatenate([total, each]))
            total = sums

        def rows() -> Iterator[pa.RecordBatch]:
            met = total > 0  # parts of changed texts, or of another task, count nothing
            for lo in range(0, len(pairs), 100_000):
                cut = np.flatnonzero(met[lo:lo + 100_000]) + lo
                yield pa.RecordBatch.from_arrays([pa.array(pairs[cut]), pa.array(total[cut])], names=["pair", "n"])

        for batch in batches:
            for _, texts in runs(batch, 0, RUN_CHARS):
                known.rows([aligner.split(t) for t in texts if t])
                if known.full():
                    add()
                    known.trim()
                    if len(pairs) >= SLICE_PAIRS:
                        yield from rows()
                        pairs = total = np.zeros(0, np.int64)
        add()
        known.times[:] = 0
        yield from rows()
    return run


# ---- minimal perfect hash --------------------------------------------------------

def _slot(keys: np.ndarray, level: int, size) -> np.ndarray:
    seed = np.uint64((level + 1) * 0xC2B2AE3D27D4EB4F % (1 << 64))
    h = mix(keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + seed)
    return ((h >> np.uint64(32)) * np.asarray(size).astype(np.uint64) >> np.uint64(32)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[list[int], bytes, np.ndarray]:
    """Hash of distinct keys: bits of each level (multiples of 64), the bitmaps, and the
    keys in the order of their slots."""
    sizes, maps, ordered = [], [], []
    while len(keys):
        size = -(-len(keys) * 3 // 2 // 64) * 64 or 64
        at = _slot(keys, len(sizes), size)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, dtype=np.uint8)
        bits[at[alone]] = 1
        ordered.append(keys[alone][np.argsort(at[alone])])
        sizes.append(size)
        maps.append(np.packbits(bits, bitorder="little").tobytes())
        keys = keys[~alone]
    return sizes, b"".join(maps), np.concatenate(ordered) if ordered else keys


class PairHash:
    """Slots of pairs, from the hashes of their buckets: bits and first bit by bucket and
    level, and the bitmaps as 64-bit words."""

    def __init__(self, buckets: int, first: int, size: np.ndarray, base: np.ndarray, words: np.ndarray):
        self.state = buckets, first, size, base, words
        self.buckets, self.first, self.size, self.base, self.words = self.state
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def of(cls, buckets: int, first: int, built: list[tuple[int, list[int], bytes]]) -> PairHash:
        """``built``: (bucket, sizes, bitmaps) by bucket, for the buckets from ``first`` on."""
        depth = max((len(s) for _, s, _ in built), default=0)
        last = max((b for b, *_ in built), default=first)
        size = np.zeros((last - first + 1, depth), np.int64)
        base, at = np.zeros_like(size), 0
        for b, sizes, _ in built:
            size[b - first, :len(sizes)] = sizes
            base[b - first, :len(sizes)] = at + np.cumsum([0, *sizes[:-1]])
            at += sum(sizes)
        return cls(buckets, first, size, base, np.frombuffer(b"".join(m for *_, m in built), dtype="<u8"))

    def __len__(self) -> int:
        return int(self.before[-1])

    def slots(self, pairs: np.ndarray) -> np.ndarray:
        """The slot of each pair, -1 where none can be; pairs that were not hashed get
        any slot, so the key there has to be compared."""
        out = np.full(len(pairs), -1, np.int64)
        bucket = (pairs & _LOW) % self.buckets - self.first
        open_ = np.flatnonzero((bucket >= 0) & (bucket < len(self.size)))
        for level in range(self.size.shape[1]):
            size = self.size[bucket[open_], level]
            open_ = open_[size > 0]
            at = self.base[bucket[open_], level] + _slot(pairs[open_], level, size[size > 0])
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            here = self.words[word]
            hit = here >> bit & np.uint64(1) == 1
            below = here & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[hit]] = (self.before[word] + np.bitwise_count(below))[hit]
            open_ = open_[~hit]
        return out


def _hash_buckets(table: pa.Table) -> pa.Table:
    sizes, maps, keys = build(table["pair"].to_numpy())
    return pa.table({"bucket": pa.array([table["bucket"][0].as_py()], pa.int32()), "sizes": pa.array([sizes], pa.list_(pa.int64())),
                     "maps": pa.array([maps], pa.binary()), "keys": pa.array([keys.astype("<i8").tobytes()], pa.binary())})


# ---- dense counts ----------------------------------------------------------------

def _dense(hash_):
    """Task function: (pair, n) -> dense vectors of the task's counts, by block of slots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = PairHash(*hash_.value)
        total = np.zeros(len(h), np.int64)
        for batch in batches:
            at = h.slots(batch.column(0).to_numpy())
            np.add.at(total, at, batch.column(1).to_numpy())
        for block in range(-(-len(total) // SLOTS_PER_BLOCK)):
            part = total[block * SLOTS_PER_BLOCK:(block + 1) * SLOTS_PER_BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                                                 names=["block", "counts"])
    return run


def _sum_blocks(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), dtype=np.int64) for x in table["counts"])
    return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def tree_sum(vectors: DataFrame) -> DataFrame:
    """One vector per block: at each level up to about ``FAN_IN`` vectors are added up."""
    while True:
        vectors = staged(vectors.select("block", "counts"), "align-vectors")
        most = vectors.groupBy("block").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return vectors
        groups = -(-most // FAN_IN)
        vectors = (vectors.withColumn("group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
                   .groupBy("block", "group").applyInArrow(_sum_blocks, "block int, counts binary"))


# ---- second pass -----------------------------------------------------------------

def _look_up(path_a: str, path_b: str, table, first: bool, last: bool):
    """Task function: (key, text, results so far) -> the same with the slice's counts; the
    ``last`` slice needs the text no more."""
    token = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept("aligner", (path_a, path_b), lambda: Aligner(path_a, path_b))
        state, keys, counts, best = table.value
        hash_ = PairHash(*state)

        def learn(parts: list[str]):
            """By part: n_a, n_b, n_groups, n_links, n_best, count_sum, and the groups."""
            found = aligner.align(parts, groups=True)
            fine = found.sizes[:, 0] >= 0
            pairs = found.pairs
            at = hash_.slots(pairs)
            known = at >= 0
            known[known] = keys[at[known]] == pairs[known]
            at = np.where(known, at, len(keys))
            upto = np.cumsum([0, *found.sizes[fine, 3]])
            sums = [np.diff(np.concatenate([[0], np.cumsum(np.append(x, 0)[at], dtype=np.int64)])[upto]) for x in (best, counts)]
            return fine, np.column_stack([found.sizes[fine], *sums]), [g for g, ok in zip(found.groups, fine.tolist()) if ok], pairs[:0]

        known = kept("counted-parts", token, lambda: Known(learn, 6))
        for batch in batches:
            for at, texts in runs(batch, 1, RUN_CHARS):
                if known.full():
                    known.trim()
                where, size = known.rows([aligner.split(t) if t else [] for t in texts])
                # sums over the parts of each document
                upto = np.concatenate([np.zeros((1, 6), np.int64), np.cumsum(known.numbers[where], axis=0)])
                ends = np.cumsum(size)
                sums = upto[ends] - upto[ends - size]
                shown = list(map(known.texts.__getitem__, where.tolist()))
                groups = [";".join(shown[hi - n:hi]) for hi, n in zip(ends.tolist(), size.tolist())]
                before = batch.slice(at, len(texts))
                if not first:  # a later slice adds to what the ones before it found
                    names = before.schema.names
                    sums[:, 4:] += np.column_stack([before.column(names.index(c)).to_numpy() for c in ("n_best", "count_sum")])
                yield pa.RecordBatch.from_arrays(
                    [before.column(0), pa.nulls(len(texts), pa.string()) if last else before.column(1),
                     *(pa.array(c) for c in sums.T.copy()), pa.array(groups, pa.string())],
                    names=["key", "text", *(f.split()[0] for f in DONE.split(", "))])
    return run


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text",
          slice_pairs: int = SLICE_PAIRS, bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """One row per row of ``docs``: key, n_a, n_b (tokens), n_groups, n_links, n_best (links
    whose pair counts the most of its B id, ties included), count_sum (counts of the links'
    pairs) and groups (``a1,a2|b1;a3|b2,b3``: ids in order).

    Strings of special tokens are ordinary text.  Null and empty texts, and texts that a
    tokenizer changes (the joined bytes of its tokens differ from space + text), have no
    tokens: zeros and '', and count nothing.  Texts of any length are aligned whole; null
    keys stay null; repeated rows are aligned and counted one by one; an empty table gives
    no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    counted = staged(rows.select("text").mapInArrow(_count_links(path_a, path_b), "pair long, n long"), "align-counted")
    pairs = staged(counted.select("pair").distinct(), "align-pairs")
    buckets = -(-pairs.count() // bucket_pairs) or 1
    per_slice = max(1, slice_pairs // bucket_pairs)
    # buckets by B id (the low 32 bits of a pair), as in PairHash.slots
    bucket = F.pmod(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(buckets)).cast("int")
    hashed = staged(pairs.withColumn("bucket", bucket).repartition(workers(spark), "bucket").groupBy("bucket").applyInArrow(
        _hash_buckets, "bucket int, sizes array<long>, maps binary, keys binary"), "align-hashes")
    tables = []
    for first in range(0, buckets, per_slice):
        mine = F.col("bucket").between(first, first + per_slice - 1)
        # the slice's hash and counts: about slice_pairs * 17 bytes
        built = sorted((r.bucket, r.sizes, bytes(r.maps), bytes(r["keys"])) for r in hashed.where(mine).collect())
        hash_ = PairHash.of(buckets, first, [b[:3] for b in built])
        sent = spark.sparkContext.broadcast(hash_.state)
        vectors = tree_sum(counted.where(bucket.between(first, first + per_slice - 1)).mapInArrow(_dense(sent), "block int, counts binary"))
        counts = np.zeros(len(hash_), np.int64)
        for r in vectors.collect():
            part = np.frombuffer(bytes(r.counts), dtype=np.int64)
            counts[r.block * SLOTS_PER_BLOCK:r.block * SLOTS_PER_BLOCK + len(part)] = part
        sent.unpersist()
        keys = np.frombuffer(b"".join(k for *_, k in built), dtype="<i8")
        top = np.zeros(int((keys & _LOW).max(initial=0)) + 1, np.int64)
        np.maximum.at(top, keys & _LOW, counts)
        table = spark.sparkContext.broadcast((hash_.state, keys, counts, counts == top[keys & _LOW]))
        if tables:
            rows = staged(rows, "align-rows")
            tables.pop().unpersist()
        rows = rows.mapInArrow(_look_up(path_a, path_b, table, not first, first + per_slice >= buckets), f"key {kind}, text string, {DONE}")
        tables.append(table)
    return rows.select(F.col("key").alias(key), *(f.split()[0] for f in DONE.split(", ")))
