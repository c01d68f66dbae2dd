"""Exact Jaccard self-join on word shingles by universe partitioning (operator 1).

Method.  Two sets of sizes a and b reach the threshold only if their symmetric
difference is at most H = floor((a + b) * (100 - t) / (100 + t)).  Sizes fall into bands
of ratio 100 / t, so partners lie in one band or two neighbouring ones, and every pair of
neighbours has a *scheme*: the universe of hashed shingles is cut into m segments.  A set
of size n gives each of its segments a level: 0 (not indexed: too few elements to tell
anything), 1 (the segment's subset is indexed) or 2 (the subset and its one-deletion
neighbourhood are).  If the levels add up to more than H, pigeonhole holds: some segment
differs from the partner's in fewer elements than its level, and both sets index one
common key for it.  Levels depend on a segment's size alone, so both sides agree; a set
whose levels fall short indexes all its segments at the scheme's full level, empty ones
included, so two such sets meet as well.

Cost-based allocation.  For each scheme the number of segments and the smallest sizes
for levels 1 and 2 are chosen by estimated cost: keys written, plus pairs that meet by
chance, which grow with the square of the band's documents (band counts come from one
aggregate over the table).

Jobs.  (1) Tasks turn texts into sets and send keys, packed in binary blocks by key
hash; each key block finds keys that several sets share.  Sets are named by a digest, so
copies count once.  (2) Each set is held against the smallest set that it shares a key
with; verified links give first components.  (3) Sets that share a key are gathered
around the smallest set of that key.  In rounds, every set offers its nearest sets in
other components, one in the first round and four times as many in each further one; what
was not tried before is verified, and links join components.  A set that had no more to
offer is done, and the rounds end when all are.  So no link between components is missed,
every pair of sets that might still link was verified, and a family of copies costs its
sets a few offers each, not all its pairs.  Before the exact count over the texts, a
parity sketch (one bit per hashed slot, four to eight slots an element) bounds the
difference from below; it only drops pairs that cannot link.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, located, staged, workers

WIDTH, PERCENT = 5, 75
CHUNK_SHINGLES, CHUNK_SETS = 500_000, 60_000
#: keys of a part, which one task holds at a time (about 80 bytes a key while they are sorted)
KEYS_PER_PART = 1_000_000
#: partitions of the key shuffle at most; a partition takes its parts one after another
KEY_PARTITIONS = 10_000
ARROW_ROWS = 2000
KEYS_PER_ROW = 4096
BLOCK, BLOCK_ELEMENTS = 2048, 8 << 20
#: shares of a gathering's members while they are dealt out
SALTS = 32
#: each round offers so many times more than the one before
GROWTH = 4
#: cost model: cost of a chance pair (one comparison of sketches, tens of nanoseconds) in keys (hashed, sent and
#: sorted, about a microsecond), share of pairs with a passage in common, its shingles
PAIR_COST, SHARING, PASSAGE = 0.05, 0.01, 40
#: keys of documents up to so many are broadcast to pick their texts; more are joined by a shuffle
BROADCAST_KEYS = 100_000
PAIRS_PER_FLUSH = 500_000
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                  0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; a shorter text is one n-gram,
    a text without words none.  Only A-Z are lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    if not len(w):
        return w
    n = min(width, len(w))
    total = np.full(len(w) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        total = total + w[i:len(w) - n + 1 + i] * (_MULT[i % 8] + np.uint64(2 * (i // 8)))
    return np.unique(mix(total))


def bands(largest: int = 1 << 40, percent: int = PERCENT) -> list[int]:
    """Lower ends of the size bands."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, -(-out[-1] * 100 // percent)))
    return out


def most_apart(a: int, b: int, percent: int = PERCENT) -> int:
    """Largest symmetric difference of two sets of sizes a and b that still link."""
    return (a + b) * (100 - percent) // (100 + percent)


def allocate(ends: list[int], counts: dict[int, int], percent: int = PERCENT) -> list[tuple[int, int, int]]:
    """(segments, smallest size for level 1, smallest size for level 2) by scheme.

    Two ways are weighed: many small segments at level 1, or fewer segments of twice the
    size at level 2 without those of one element.  ``ends`` are the band ends, ``counts``
    the documents by band.
    """
    out = []
    for k in range(len(ends) - 1):
        top = ends[k + 1] - 1
        apart = most_apart(top, top * 100 // percent, percent)
        sets = counts.get(k, 0) + counts.get(k + 1, 0)
        small = max(apart + 1, math.ceil(apart * 1.16) + 3)
        few = max(-(-(apart + 1) // 2), math.ceil(apart * 0.6) + 3)
        chance = PAIR_COST * SHARING * sets * sets / 2
        ways = []
        for m, one, two in ((small, 1, 1 << 60), (few, 2, 3)):
            load = top / m
            keys = m + (top if two < 1 << 60 else 0)
            if one == 1:
                meet = PASSAGE * math.exp(-2 * load)
            else:
                meet = PASSAGE * PASSAGE / (2 * m) * math.exp(-2 * load) * (1 + 2 * load)
            ways.append((sets * keys + chance * meet, (m, one, two)))
        out.append(min(ways)[1])
    return out


def index_keys(h: np.ndarray, ends: list[int], schemes: list[tuple[int, int, int]], percent: int = PERCENT) -> np.ndarray:
    """Index keys (64 bit) of one set under the schemes of its own band and the one below."""
    n = len(h)
    band = int(np.searchsorted(ends, n, side="right")) - 1
    element = mix(h + np.uint64(0x632BE59BD9B4E019))
    upto = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(element, dtype=np.uint64)])
    out = []
    for k in (band, band - 1):
        if k < 0:
            continue
        partner = n * 100 // percent if k == band else ends[band] - 1
        if partner * 100 < n * percent:
            continue
        apart = most_apart(n, partner, percent)
        if not apart:
            continue  # only equal sets link, and they are one set
        m, one, two = schemes[k]
        seg = ((h >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)  # ascending, as h is
        first = np.searchsorted(seg, np.arange(m, dtype=np.uint64))
        size = np.diff(np.append(first, n))
        level = (size >= one).astype(np.int64) + (size >= two)
        if level.sum() <= apart:  # short of the pigeonhole: everything is indexed
            one, two = 0, (0 if two < 1 << 60 else two)
        subset = upto[first + size] - upto[first]
        tag = mix(np.arange(m, dtype=np.uint64) + np.uint64((k + 1) << 40))
        at = size >= one
        out.append(mix(subset[at] + tag[at]))
        if two < 1 << 60:
            s = seg.astype(np.int64)
            at = size[s] >= two
            out.append(mix((subset[s] - element + tag[s])[at]))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, dtype=np.uint64)


def key_parts(ends: list[int], counts: dict[int, int], schemes: list[tuple[int, int, int]], least: int) -> int:
    """Parts of at most about ``KEYS_PER_PART`` keys, ``least`` at least: a set has up to a
    key for each segment of its two schemes, and at level 2 one for each element."""
    keys = 0
    for k, docs in counts.items():
        for m, _, two in schemes[max(0, k - 1):k + 1]:
            keys += docs * (m + (ends[k + 1] - 1 if two < 1 << 60 else 0))
    return max(least, -(-keys // KEYS_PER_PART))


def set_id(h: np.ndarray) -> int:
    """64-bit digest of a set as a signed integer."""
    x = xxhash.xxh3_64_intdigest(h.tobytes())
    return x - (1 << 64) if x >> 63 else x


def sketch(h: np.ndarray) -> bytes:
    """Parity of the elements in each of 2**j slots, four to eight slots an element."""
    slots = 1 << max(6, (4 * len(h) - 1).bit_length())
    return np.packbits((np.bincount((h & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1).astype(np.uint8)).tobytes()


def least_apart(a: bytes, b: bytes) -> int:
    """Lower bound of the symmetric difference of two sets from their sketches."""
    x, y = np.frombuffer(a, dtype="<u8"), np.frombuffer(b, dtype="<u8")
    return int(np.bitwise_count(_fold(x, len(y)) ^ _fold(y, len(x))).sum())


def _fold(x: np.ndarray, size: int) -> np.ndarray:
    while len(x) > size:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x


# ---- job 1: sets and shared keys -------------------------------------------------

def _map_side(width: int, percent: int, parts: int, ends: list[int], schemes: list) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "kind", "key", "n", "id", "payload"]
        ids: dict[int, int] = {}
        keys, owner = [], []
        held, turn = 0, 0

        def blocks() -> Iterator[pa.RecordBatch]:
            key, own = np.concatenate(keys), np.concatenate(owner)
            part = ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            key, own, cut = key[order], own[order], np.searchsorted(part[order], np.arange(parts + 1))
            sid = np.fromiter(ids, dtype=np.uint64, count=len(ids))
            rows, where = [], []
            for p in np.flatnonzero(np.diff(cut)).tolist():
                k, o = key[cut[p]:cut[p + 1]], own[cut[p]:cut[p + 1]]
                have, o = np.unique(o, return_inverse=True)
                rows.append(np.array([len(have), len(k)], dtype="<i8").tobytes() + sid[have].tobytes()
                            + (k & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + (k >> np.uint64(32) & np.uint64(0xFFFF)).astype("<u2").tobytes()
                            + o.astype("<u2").tobytes())
                where.append(p)
            for lo in range(0, len(rows), 32):
                n = len(rows[lo:lo + 32])
                yield pa.RecordBatch.from_arrays([
                    pa.array(where[lo:lo + 32], pa.int32()), pa.array([0] * n, pa.int32()), pa.nulls(n, key_type),
                    pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(rows[lo:lo + 32], pa.binary())], names=names)
            ids.clear(), keys.clear(), owner.clear()

        for batch in batches:
            key_type = batch.schema.field(0).type
            n_of, id_of, sketch_of, part_of = [], [], [], []
            for text in batch.column(1):
                h = shingles(text.as_py(), width)
                turn += 1
                part_of.append(turn * 0x9E3779B1 % parts)
                n_of.append(len(h))
                if not len(h):
                    id_of.append(None), sketch_of.append(None)
                    continue
                id_of.append(set_id(h)), sketch_of.append(sketch(h))
                sid = id_of[-1] % (1 << 64)
                if sid not in ids:
                    k = index_keys(h, ends, schemes, percent)
                    if len(k):
                        keys.append(k), owner.append(np.full(len(k), len(ids), dtype=np.int64))
                        ids[sid] = len(ids)
                        held += len(k)
            n = len(n_of)
            for lo in range(0, n, 1000):
                cut = slice(lo, lo + 1000)
                yield pa.RecordBatch.from_arrays([
                    pa.array(part_of[cut], pa.int32()), pa.array([1] * len(n_of[cut]), pa.int32()), batch.column(0).slice(lo, 1000),
                    pa.array(n_of[cut], pa.int64()), pa.array(id_of[cut], pa.int64()), pa.array(sketch_of[cut], pa.binary())], names=names)
            if held >= CHUNK_SHINGLES or len(ids) >= CHUNK_SETS - 10_000:
                yield from blocks()
                held = 0
        if ids:
            yield from blocks()
    return run


def _shared(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of one key block: (center, member) for every set that shares a key with others;
    the center is the smallest set of the key."""
    sid, key, own, base = [], [], [], 0
    for b in blobs:
        sets, n = np.frombuffer(b, dtype="<i8", count=2)
        at = 16
        sid.append(np.frombuffer(b, dtype="<u8", count=sets, offset=at))
        at += 8 * sets
        low, high = np.frombuffer(b, dtype="<u4", count=n, offset=at), np.frombuffer(b, dtype="<u2", count=n, offset=at + 4 * n)
        key.append(low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32))
        own.append(np.frombuffer(b, dtype="<u2", count=n, offset=at + 6 * n).astype(np.int64) + base)
        base += int(sets)
    if not sid:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    names, own_set = np.unique(np.concatenate(sid), return_inverse=True)
    key, own = np.concatenate(key), own_set[np.concatenate(own)]
    order = np.argsort(key)
    key, own = key[order], own[order]
    again = np.zeros(len(key), dtype=bool)
    again[1:] = key[1:] == key[:-1]
    again[:-1] |= again[1:]
    key, own = key[again], own[again]
    order = np.lexsort((own, key))
    key, own = key[order], own[order]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
    center = np.repeat(own[start], np.diff(np.append(start, len(key))))
    pair = np.unique((center * len(names) + own)[center != own])
    return names[pair // len(names)], names[pair % len(names)]


def _reduce_side() -> Callable:
    """Rows come sorted by part; the key blocks of one part are held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "key", "n", "id", "sketch", "center", "members"]
        blobs: list[bytes] = []
        at, key_type = None, None

        def gatherings() -> Iterator[pa.RecordBatch]:
            center, member = _shared(blobs)
            blobs.clear()
            rows = [(2, int(c), m) for c, m in _runs(center, member)]
            for lo in range(0, len(rows), 256):
                some = rows[lo:lo + 256]
                n = len(some)
                yield pa.RecordBatch.from_arrays([
                    pa.array([k for k, *_ in some], pa.int32()), pa.nulls(n, key_type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.binary()), pa.array(np.array([c for _, c, _ in some], dtype=np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(np.cumsum([0] + [len(m) for *_, m in some]).astype(np.int32),
                                             np.concatenate([m for *_, m in some]).view(np.int64))], names=names)

        for batch in batches:
            key_type = batch.schema.field(2).type
            kind = batch.column(1).to_numpy()
            docs = batch.filter(pa.array(kind == 1))
            n = docs.num_rows
            if n:
                yield pa.RecordBatch.from_arrays([docs.column(1), docs.column(2), docs.column(3), docs.column(4), docs.column(5),
                                                  pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))], names=names)
            for i in np.flatnonzero(kind == 0):
                part = batch.column(0)[i].as_py()
                if part != at:
                    yield from gatherings()
                    at = part
                blobs.append(batch.column(5)[i].as_py())
        yield from gatherings()
    return run


def _runs(center: np.ndarray, member: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    start = np.flatnonzero(np.r_[True, center[1:] != center[:-1]]) if len(center) else []
    for lo, hi in zip(start, [*start[1:], len(center)]):
        for at in range(lo, hi, KEYS_PER_ROW):
            yield center[lo], member[at:min(hi, at + KEYS_PER_ROW)]


# ---- jobs 2 and 3: links ---------------------------------------------------------

def _may_link(percent: int) -> Callable[..., Column]:
    @F.pandas_udf("boolean")
    def run(a, b, n, m):
        import pandas as pd
        return pd.Series([bool(100 * min(i, j) >= percent * max(i, j) and least_apart(x, y) <= most_apart(i, j, percent))
                          for x, y, i, j in zip(a, b, n, m)], dtype=bool)
    return run


def _verify(pairs: DataFrame, docs: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of set ids that link by the exact count over their texts.  Pairs
    of one a are dealt out in units of about 256."""
    many = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("many"))
    pairs = (pairs.join(many, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.ceil(F.col("many") / 256)))
             .select(F.xxhash64("a", "salt").alias("unit"), "a", "b"))
    sides = pairs.select("unit", F.lit(0).alias("side"), F.col("a").alias("id")).distinct().unionByName(
        pairs.select("unit", F.lit(1).alias("side"), F.col("b").alias("id")))
    sides = staged(sides.join(sets.select("id", "rep"), "id"), "join-sides")
    need = sides.select("rep").distinct()
    if need.count() <= BROADCAST_KEYS:
        docs = docs.join(F.broadcast(need), need["rep"].eqNullSafe(docs["key"]), "left_semi")
    texts = (sides.join(docs, sides["rep"].eqNullSafe(docs["key"])).select("unit", "side", "id", "text")
             .repartition(workers(docs.sparkSession), "unit").sortWithinPartitions("unit", "side"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, whole, unit = None, None, None
        for batch in batches:
            found = []
            for u, side, i, text in zip(*map(pa.Array.to_pylist, batch.columns[:3]), batch.column(3)):
                h = shingles(text.as_py(), width)
                if set_id(h) != i:  # another text under a repeated key
                    continue
                if side == 0:
                    a, whole, unit = i, h, u
                elif u == unit:
                    both = len(whole) + len(h) - len(np.union1d(whole, h))
                    if 100 * both >= percent * (len(whole) + len(h) - both):
                        found.append((a, i))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())],
                                             names=["a", "b"])
    return texts.mapInArrow(run, "a long, b long")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(id, root): the smallest id reachable over ``links`` (a, b), for every id in them.

    Each round takes the smallest label next to a node, then the label of that label;
    rounds end when nothing changes.
    """
    links = staged(links.select("a", "b").where("a != b").distinct(), f"{name}-links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed("a", "id"), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        near = both.join(labels.select(F.col("id").alias("b"), "root"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("near"))
        step = labels.join(near, "id").select("id", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("id").alias("root"), F.col("root").alias("next"))
        labels = staged(step.join(jump, "root", "left").select(
            "id", "old", F.least("root", F.coalesce("next", "root")).alias("root")), f"{name}-{turn}")
        changed = not labels.where("old != root").isEmpty()
        labels = labels.select("id", "root")
        if not changed:
            return labels


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (id, root) of all sets after ``links`` (a, b): one link for each pair of
    components is enough."""
    x, y = (labels.select(F.col("id").alias(c), F.col("root").alias(f"r{c}")) for c in "ab")
    between = links.join(x, "a").join(y, "b").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
    moved = components(between, "join-roots").select(F.col("id").alias("root"), F.col("root").alias("to"))
    return staged(labels.join(moved, "root", "left").select("id", F.coalesce("to", "root").alias("root")), "join-labels")


def _offers(members: DataFrame, sets: DataFrame, labels: DataFrame, tried: DataFrame, percent: int, most: int) -> DataFrame:
    """(a, b, rank, more): for each set a, sets b of a gathering that a is in (``members``:
    gid, id), in another component, that may link by their sketches and were not
    tried; the ``most`` nearest of each unit, ranked by distance over all units.  ``more``
    says that a unit held more.

    Gatherings are held against themselves in blocks of about ``BLOCK`` sets or
    ``BLOCK_ELEMENTS`` shingles (a sketch takes at most a byte for each)."""
    members = members.join(labels.join(sets.select("id", "n"), "id"), "id")
    size = members.groupBy("gid").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("elements"),
                                      F.min("root").alias("lo"), F.max("root").alias("hi"))
    open_ = size.where("lo != hi").select(
        "gid", F.ceil(F.greatest(F.col("size") / BLOCK, F.col("elements") / BLOCK_ELEMENTS)).cast("int").alias("blocks"))
    # a gathering may hold a third of all sets: its members come in salted shares
    open_ = open_.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = (members.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(open_, ["gid", "salt"])
            .join(sets.select("id", "sketch"), "id")
            .withColumn("block", F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(F.xxhash64("gid", F.least("block", "other"), F.greatest("block", "other")).alias("unit"),
                    (F.col("block") <= F.col("other")).alias("left"), (F.col("block") >= F.col("other")).alias("right"), "id", "root", "n", "sketch"))
    rows = rows.repartition(workers(sets.sparkSession), "unit").sortWithinPartitions("unit", "n", "id")

    def pairs(some: list) -> np.ndarray:
        """(a, b, gap, more) of one unit, an array of four rows."""
        sides = [r for r in some if r[1]], [r for r in some if r[2]]
        both_ways = [(sides[0], sides[1])] + ([(sides[1], sides[0])] if any(r[1] != r[2] for r in some) else [])
        out = []
        for left, right in both_ways:
            n = np.array([r[5] for r in right])
            root, name = np.array([r[4] for r in right]), np.array([r[3] for r in right])
            by_width: dict[int, np.ndarray] = {}
            for _, _, _, i, own, size, bits in left:
                lo, hi = np.searchsorted(n, [-(-size * percent // 100), size * 100 // percent + 1])
                at = np.arange(lo, hi)
                at = at[root[lo:hi] != own]
                if not len(at):
                    continue
                w = min(len(bits), len(right[lo][6]), len(right[hi - 1][6]))
                if w not in by_width:
                    by_width[w] = np.array([_fold(np.frombuffer(r[6], dtype="<u8"), w // 8) if len(r[6]) >= w else np.zeros(w // 8, "<u8")
                                            for r in right]).reshape(len(right), w // 8)
                gap = np.bitwise_count(by_width[w][at] ^ _fold(np.frombuffer(bits, dtype="<u8"), w // 8)).sum(axis=1, dtype=np.int64)
                may = gap <= (n[at] + size) * (100 - percent) // (100 + percent)
                at, gap = at[may], gap[may]
                more = len(at) > most
                if more:
                    near = np.lexsort((name[at], gap))[:most]
                    at, gap = at[near], gap[near]
                out.append((np.full(len(at), i, dtype=np.int64), name[at], gap, np.full(len(at), more, dtype=np.int64)))
        return np.array([np.concatenate(x) for x in zip(*out)], dtype=np.int64).reshape(4, -1) if out else np.zeros((4, 0), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some: list = []
        found: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            x = np.unique(np.concatenate(found, axis=1), axis=1)  # a pair may share many keys
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in x], names=["a", "b", "gap", "more"])

        for batch in batches:
            for r in zip(*map(pa.Array.to_pylist, batch.columns)):
                if some and some[0][0] != r[0]:
                    found.append(pairs(some))
                    some = []
                    if sum(x.shape[1] for x in found) >= PAIRS_PER_FLUSH:
                        yield out()
                some.append(r)
        if some:
            found.append(pairs(some))
        if found:
            yield out()
    found = rows.mapInArrow(run, "a long, b long, gap long, more long").groupBy("a", "b").agg(F.min("gap").alias("gap"), F.max("more").alias("more"))
    known = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b"))).withColumn("known", F.lit(True))
    found = found.join(known, ["a", "b"], "left")
    # tried pairs rank last; they stay to tell that their set had more
    nearest = Window.partitionBy("a").orderBy(F.col("known").isNotNull(), "gap", "b")
    return found.select("a", "b", F.when(F.col("known").isNull(), F.row_number().over(nearest)).alias("rank"), "more")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
         percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id (smallest key reachable
    by links, itself included) and set_id (equal for equal sets).

    Null texts and texts without words have no shingles and link with nothing; a text of
    fewer than ``width`` words is one shingle; equal sets always link; repeated rows are
    copies of each other; null keys do not become component ids while another key is
    there; an empty table gives no rows; other columns are ignored.  Sets are told apart
    by a 64-bit digest of their hashed shingles: that two different sets of n share one has
    a probability of about n**2 / 2**65 (3 in 100 at 10**9 distinct sets).
    """
    with arrow_rows(docs.sparkSession, ARROW_ROWS):
        return _join(docs, key, text, width, percent)


def _join(docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    ends = bands(percent=percent)
    # documents by band, from the length of the text: a word and its gap take about 6.5 characters
    about = F.greatest(F.lit(1), (F.length("text") / 6.5).cast("long"))
    band = F.floor(F.log(about.cast("double")) * 8).cast("int")
    counts: dict[int, int] = {}
    for r in docs.where(F.col("text").isNotNull()).groupBy(band.alias("band")).count().collect():  # about a hundred rows
        k = int(np.searchsorted(ends, max(1, round(math.exp((r["band"] + 0.5) / 8))), side="right")) - 1
        counts[k] = counts.get(k, 0) + r["count"]
    schemes = allocate(ends, counts, percent)
    parts = key_parts(ends, counts, schemes, workers(spark))
    kind = docs.schema["key"].dataType.simpleString()
    sent = docs.mapInArrow(_map_side(width, percent, parts, ends, schemes),
                           f"part int, kind int, key {kind}, n long, id long, payload binary")
    found = staged(sent.repartition(min(parts, max(KEY_PARTITIONS, workers(spark))), "part").sortWithinPartitions("part").mapInArrow(
        _reduce_side(), f"kind int, key {kind}, n long, id long, sketch binary, center long, members array<long>"),
        "join-found", "kind")
    rows = found.where("kind = 1").select("key", "n", "id", "sketch")
    sets = staged(rows.where("id is not null").groupBy("id").agg(
        F.min("key").alias("rep"), F.max("n").alias("n"), F.max("sketch").alias("sketch")), "join-sets")
    edges = staged(found.where("kind = 2").select(F.col("center").alias("a"), F.explode("members").alias("b")).distinct(),
                   "join-edges")
    may = _may_link(percent)

    def likely(pairs: DataFrame) -> DataFrame:
        x, y = (sets.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")) for c in "ab")
        return pairs.join(x, "a").join(y, "b").where(may("sa", "sb", "na", "nb")).select("a", "b")

    # each set and the smallest one that it shares a key with
    first = staged(likely(edges.groupBy("b").agg(F.min("a").alias("a"))), "join-first")
    tried = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    labels = _joined(sets.select("id", F.col("id").alias("root")), staged(_verify(first, docs, sets, width, percent), "join-links"))
    members = edges.select(F.col("a").alias("gid"), F.col("b").alias("id")).unionByName(
        edges.select(F.col("a").alias("gid"), F.col("a").alias("id")).distinct())
    most = 1
    while True:
        offers = staged(_offers(members, sets, labels, tried, percent, most), "join-offers")
        fresh = staged(offers.where(F.col("rank") <= most).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "join-fresh")
        if not fresh.isEmpty():
            labels = _joined(labels, staged(_verify(fresh, docs, sets, width, percent), "join-links"))
            tried = tried.unionByName(fresh)
        # a pair was offered unless both of its sets had more
        unfinished = staged(offers.where((F.col("rank") > most) | (F.col("more") == 1)).select(F.col("a").alias("id")).distinct(), "join-unfinished")
        if unfinished.isEmpty():
            break
        members = staged(members.join(unfinished, "id", "left_semi"), "join-members")
        most *= GROWTH
    named = sets.join(labels, "id").select("id", "rep", "root")
    smallest = named.groupBy("root").agg(F.min("rep").alias("component"))
    named = named.join(smallest, "root").select("id", "component")
    return rows.drop("sketch").join(named, "id", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "key").alias("component_id"),
        F.col("id").alias("set_id"))


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, less all but the first of each
    component (smallest key, then place in the table; a null key is the smallest).  Rows
    without words are no component and stay; repeated rows are one; an empty table gives no
    rows."""
    placed, at = located(docs, "join-docs")
    ranked = placed.select(F.struct(F.col(key).alias("key"), F.col(at).alias("at")).alias("key"), F.col(text).alias("text"))
    found = join(ranked, "key", "text", **options)
    gone = found.where(F.col("key") != F.col("component_id")).select(F.col("key.at").alias(at))
    return placed.join(gone, at, "left_anti").select(*docs.columns)
