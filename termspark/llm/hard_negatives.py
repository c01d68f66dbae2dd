"""Hard-negative mining by a secondary-sort shuffle (operator 11).

Every vector becomes integers, ``floor(scale * x)``, and is scored against every anchor by
the integer inner product.  An anchor's *positives* are its best other rows of the same
label; around each of them a window of scores, relative to the positive's, holds the
negatives: rows of another label, best first.

Secondary sort.  A scored pair is packed into one binary key that sorts by anchor,
descending score, positives before negatives, and id.  Keys are dealt out by anchor and
sorted within their partitions (``repartition`` + ``sortWithinPartitions``, the DataFrame
form of ``repartitionAndSortWithinPartitions``: the shuffle sorts and spills in the JVM).
A streaming iterator then walks the keys once: a positive opens its window, a negative is
given to the open windows that its score fits, and a window closes when it is full or the
score has fallen below it.  It holds a few windows at a time, never an anchor's pairs.

Before the shuffle.  Two passes over the table keep the shuffle small without losing a
row.  In the first each task keeps, for each anchor, the best positives among its rows; in
the second, with every window known, it keeps for each window the best negatives among its
rows.  The best of all rows are among the best of their tasks, so nothing is dropped that
could be returned, and a common label costs an anchor no more than a rare one.

Anchors are a set stated by the caller, scored against all rows in blocks.  They go to the
tasks in rounds of at most ``ROUND_BYTES`` of vectors, so what is broadcast at once does
not grow with the data; each round reads the table twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, workers

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: a negative's score, in percent of its positive's
LEAST, MOST = 50, 95
ROUND_BYTES = 16 << 20
ROWS_AT_ONCE, ANCHORS_AT_ONCE = 4096, 512
_SIGN = np.uint64(1 << 63)
_NONE = np.iinfo(np.int64).min
#: anchor id, place of the anchor's row, descending score, side (0 positive, 1 negative), id
KEY = np.dtype([("anchor", ">u8"), ("place", ">u8"), ("score", ">u8"), ("side", "u1"), ("id", ">u8")])
FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def pack(anchor: np.ndarray, place: np.ndarray, score: np.ndarray, side: int, ident: np.ndarray) -> pa.Array:
    """Keys whose unsigned byte order is (anchor, place, score descending, side, id)."""
    keys = np.empty(len(score), dtype=KEY)
    keys["anchor"], keys["place"] = anchor.view(np.uint64) ^ _SIGN, place.view(np.uint64) ^ _SIGN
    keys["score"] = ~(score.view(np.uint64) ^ _SIGN)
    keys["side"], keys["id"] = side, ident.view(np.uint64) ^ _SIGN
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(KEY.itemsize), len(keys), [None, pa.py_buffer(keys.tobytes())])
    return fixed.cast(pa.binary())


def unpack(keys: pa.Array) -> tuple[np.ndarray, ...]:
    """anchor, place, score, side and id of packed keys."""
    k = np.frombuffer(b"".join(keys.to_pylist()), dtype=KEY)

    def signed(x: np.ndarray) -> np.ndarray:
        return (x.astype(np.uint64) ^ _SIGN).view(np.int64)
    return signed(k["anchor"]), signed(k["place"]), signed(~k["score"].astype(np.uint64)), k["side"].astype(np.int64), signed(k["id"])


def integers(vectors: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``vectors`` (lists of doubles) without a null or non-finite component, and
    their ``floor(scale * x)``; shorter rows are filled up with zeros."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.array(vectors.value_lengths(), dtype=np.int64)
    end = np.cumsum(size)
    bad = np.concatenate([np.zeros(1, np.int64), np.cumsum(~np.isfinite(flat))])
    good = np.flatnonzero(bad[end] == bad[end - size]) if len(size) else np.zeros(0, np.int64)
    width = int(size.max(initial=0))
    row = np.repeat(np.arange(len(size)), size)
    full = np.zeros((len(size), width))
    with np.errstate(over="ignore", invalid="ignore"):
        full[row, np.arange(len(flat)) - np.repeat(end - size, size)] = np.floor(scale * flat)
    return good, full[good]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` and ``b``, exact; in floating point where no
    sum can reach 2**53, else in integers of any size, held inside the long range."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(width, 1) < 2 ** 53:
        return (a @ b.T).astype(np.int64)
    x, y = ([[int(v) for v in r] for r in np.nan_to_num(m).tolist()] for m in (a, b))
    top = np.iinfo(np.int64).max
    return np.array([[max(-top, min(top, sum(map(int.__mul__, r, s)))) for s in y] for r in x], dtype=np.int64).reshape(len(x), len(y))


class Best:
    """For each of ``n`` lists the ``k`` best of the rows shown so far: highest score, then
    smallest id, then first shown."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), _NONE)
        self.ident, self.place = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)

    def show(self, lists: slice, scores: np.ndarray, ident: np.ndarray, place: np.ndarray) -> None:
        """``scores`` (one row a list, _NONE for rows that do not count) of rows that come
        in the order of (id, place)."""
        at = np.flatnonzero((scores.max(axis=1, initial=_NONE) >= self.score[lists, -1]) & (scores.max(axis=1, initial=_NONE) > _NONE))
        if not len(at):
            return
        scores, at = scores[at], at + lists.start
        new = []
        for _ in range(min(self.score.shape[1], scores.shape[1])):
            best = scores.argmax(axis=1)
            new.append((scores[np.arange(len(at)), best], ident[best], place[best]))
            scores[np.arange(len(at)), best] = _NONE
        score, who, where = (np.column_stack([old[at], *cols]) for old, cols in zip((self.score, self.ident, self.place), zip(*new)))
        order = np.lexsort((where, who, ~score))[:, :self.score.shape[1]]
        self.score[at], self.ident[at], self.place[at] = (np.take_along_axis(x, order, 1) for x in (score, who, where))


def _scored(round_, windows, positives: int, negatives: int, scale: int):
    """Task function: rows (id, label, vector) -> packed keys of the best positives of each
    anchor (``windows`` is None) or of the best negatives of each window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        anchor, place, code, labels, vectors = round_.value
        lo, hi = windows.value if windows is not None else (None, None)
        best = [Best(len(anchor), positives)] if windows is None else [Best(len(anchor), negatives) for _ in range(lo.shape[1])]
        seen = 0
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                good, rows = integers(part.column(2), scale)
                ident = part.column(0).to_numpy()[good]
                own = pc.fill_null(pc.index_in(part.column(1), value_set=labels), -1).to_numpy()[good]
                order = np.argsort(ident, kind="stable")
                rows, ident, own, nth = rows[order], ident[order], own[order], seen + order
                seen += len(good)
                if not len(rows):
                    continue
                for a in range(0, len(anchor), ANCHORS_AT_ONCE):
                    cut = slice(a, min(a + ANCHORS_AT_ONCE, len(anchor)))
                    score = products(vectors[cut], rows)
                    other = ident[None, :] != anchor[cut, None]
                    same = own[None, :] == code[cut, None]
                    if windows is None:
                        best[0].show(cut, np.where(same & other, score, _NONE), ident, nth)
                        continue
                    free = other & ~same
                    for w, b in enumerate(best):
                        b.show(cut, np.where(free & (score >= lo[cut, w, None]) & (score <= hi[cut, w, None]), score, _NONE), ident, nth)
        score, who, nth = (np.column_stack([getattr(b, f) for b in best]) for f in ("score", "ident", "place"))
        if windows is not None:  # a row in several windows is sent once
            order = np.argsort(np.where(score > _NONE, nth, -1), axis=1, kind="stable")
            score, who, nth = (np.take_along_axis(x, order, 1) for x in (score, who, nth))
            again = (nth[:, 1:] == nth[:, :-1]) & (score[:, 1:] > _NONE) & (score[:, :-1] > _NONE)
            score[:, 1:][again] = _NONE
        row, col = np.nonzero(score > _NONE)
        for at in range(0, len(row), 50_000):
            r, c = row[at:at + 50_000], col[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([pack(anchor[r], place[r], score[r, c], int(windows is not None), who[r, c])], names=["key"])
    return run


def _sorted_by_anchor(keys: DataFrame) -> DataFrame:
    """The secondary sort: all keys of an anchor's row in one partition, in key order."""
    return keys.repartition(workers(keys.sparkSession), F.substring("key", 1, 16)).sortWithinPartitions("key")


def _first_positives(count: int):
    """Task function over sorted keys: the first ``count`` of each anchor's row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, taken = None, 0
        for batch in batches:
            anchor, place, *_ = unpack(batch.column(0))
            keep = []
            for i, who in enumerate(zip(anchor.tolist(), place.tolist())):
                if who != at:
                    at, taken = who, 0
                if taken < count:
                    taken += 1
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64()))], names=["key"])
    return run


def window(score: int, least: int, most: int) -> tuple[int, int]:
    """Smallest and largest score of the negatives of a positive."""
    return -(-least * score // 100), most * score // 100


def _mined(positives: int, negatives: int, least: int, most: int):
    """Task function over sorted keys: a positive opens its window, a negative goes to the
    open windows that its score fits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, opened, open_ = None, 0, []
        for batch in batches:
            out = []
            for a, p, score, side, ident in zip(*(x.tolist() for x in unpack(batch.column(0)))):
                if (a, p) != at:
                    at, opened, open_ = (a, p), 0, []
                if side == 0:
                    if opened < positives:
                        opened += 1
                        open_.append([ident, score, *window(score, least, most), 0])
                    continue
                for w in open_:
                    if w[2] <= score <= w[3]:
                        w[4] += 1
                        out.append((a, w[0], w[4], ident, w[1], score))
                open_ = [w for w in open_ if w[4] < negatives and score >= w[2]]
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 2 else pa.int64()) for i, c in enumerate(cols)],
                names=[f.split()[0] for f in FOUND.split(", ")])
    return run


def mine(rows: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST,
         scale: int = SCALE, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """One row per anchor, positive and negative: anchor_id, positive_id, rank (from 1 in
    each anchor and positive), negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition over ``rows``.  Rows with a null key, label or vector, or
    with a null or non-finite component take no part.  Rows that share the anchor's id are
    not its partners; repeated rows count one by one, and each repeated anchor row is mined
    on its own.  Equal scores are ordered by id.  Of vectors of unequal length only the
    common components are multiplied; an empty vector scores 0.  Scores beyond the long
    range are held at its ends.  A window that no score can fit (a negative positive
    score) gives no rows.  An empty table gives none; other columns are ignored.
    """
    spark = rows.sparkSession
    rows = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"),
                       F.col(vector).cast("array<double>").alias("vec"), is_anchor.alias("asked")).dropna(subset=["id", "label", "vec"])
    anchors = staged(rows.where("asked").select("id", "label", "vec", F.monotonically_increasing_id().alias("place")), "mine-anchors")
    size = anchors.agg(F.coalesce(F.sum(F.size("vec") + 4), F.lit(0))).first()[0] * 8
    rounds = -(-size // round_bytes)
    rows = rows.select("id", "label", "vec")
    found = [spark.createDataFrame([], FOUND)]
    for turn in range(rounds):
        mine_now = anchors.where(F.pmod("place", F.lit(rounds)) == turn).toArrow()
        good, vectors = integers(mine_now["vec"].combine_chunks(), scale)
        if not len(good):
            continue
        mine_now = mine_now.take(pa.array(good))
        coded = mine_now["label"].combine_chunks().dictionary_encode()
        anchor, place = mine_now["id"].to_numpy(), mine_now["place"].to_numpy()
        round_ = spark.sparkContext.broadcast((anchor, place, coded.indices.to_numpy(), coded.dictionary, vectors))
        first = staged(_sorted_by_anchor(rows.mapInArrow(_scored(round_, None, positives, negatives, scale), "key binary"))
                       .mapInArrow(_first_positives(positives), "key binary"), "mine-positives")
        # the windows of the round's anchors: at most ``positives`` for each
        lo, hi = np.full((len(anchor), positives), np.iinfo(np.int64).max), np.full((len(anchor), positives), _NONE)
        row_of = {p: i for i, p in enumerate(place.tolist())}
        used = [0] * len(anchor)
        _, where, score, *_ = unpack(first.toArrow()["key"].combine_chunks())
        for p, s in zip(where.tolist(), score.tolist()):
            i = row_of[p]
            lo[i, used[i]], hi[i, used[i]] = window(s, least, most)
            used[i] += 1
        windows = spark.sparkContext.broadcast((lo, hi))
        second = rows.mapInArrow(_scored(round_, windows, positives, negatives, scale), "key binary")
        found.append(staged(_sorted_by_anchor(first.unionByName(second)).mapInArrow(
            _mined(positives, negatives, least, most), FOUND), "mine-found"))
        round_.unpersist(), windows.unpersist()
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out
