"""Mixing sources to target weights (operator 6, native).

Targets: each source gets a share of ``volume`` times all words by weight, stops at
``max_repeats`` times its own words, and what exceeds that is shared again by weight.

Draw: a seeded hash permutes the documents of a source and cuts them into blocks of
about ``BLOCK_ROWS`` documents.  Whole passes take every block; the rest of the target
takes blocks in permuted order, and the block in which the target ends gives only a
prefix of its documents (plus the one document that fits the remaining gap best).

Order: every taken block copy goes to one output shard.  The counts come from a
splitting tree: the exact block counts by source are split between the two halves of
the shards by a multivariate hypergeometric draw, and so on down to single shards.
Each shard then draws its quota as the next blocks of each source's permuted order, so
shards are disjoint, and rows are shuffled inside a shard by a seeded hash.

Only one row per source reaches the driver, and the tree holds sources x shards counts.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, located, staged, word_count

BLOCK_ROWS = 256
#: words of an output shard; the driver's tree holds at most MAX_SHARDS counts for each source, beyond that shards grow
SHARD_WORDS, MAX_SHARDS = 1 << 20, 1 << 17
#: source tables up to so many rows (about 1 MB) are broadcast, larger ones are joined by a shuffle
BROADCAST_SOURCES = 10_000
_SPAN = float(1 << 53)


def targets(sizes: dict, weights: dict, volume: float, max_repeats: float) -> dict:
    """Words wanted of each source: shares of ``volume * sum(sizes)`` by weight, none
    above ``max_repeats`` times its size; the excess is shared again until none is."""
    left, open_ = volume * sum(sizes.values()), [s for s in sizes if weights[s] > 0]
    out = {s: 0.0 for s in sizes}
    while open_:
        total = sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / total > max_repeats * sizes[s]]
        if not over:
            out.update({s: left * weights[s] / total for s in open_})
            break
        for s in over:
            out[s] = float(max_repeats * sizes[s])
        left -= sum(out[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    return out


def _hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Marked items in ``draws`` of ``good`` marked and ``bad`` others: the inverse of
    the distribution function, walked outwards from the mode."""
    low, high = max(0, draws - bad), min(draws, good)
    if low >= high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))

    def ln_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    top = math.exp(ln_choose(good, mode) + ln_choose(bad, draws - mode) - ln_choose(good + bad, draws))
    u, up, down, x, y = rng.random() - top, top, top, mode, mode
    while u > 0 and (x < high or y > low):
        if x < high:
            up *= (good - x) * (draws - x) / ((x + 1) * (bad - draws + x + 1))
            x += 1
            u -= up
            if u <= 0:
                return x
        if y > low:
            down *= y * (bad - draws + y) / ((good - y + 1) * (draws - y + 1))
            y -= 1
            u -= down
            if u <= 0:
                return y
    return mode


def splitting_tree(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Block quotas by shard and source.  Shard totals differ by at most one, and the
    quotas of a source add up to its count."""
    total, out = sum(counts), [[] for _ in range(shards)]
    ends = [total * i // shards for i in range(shards + 1)]
    todo = [(0, shards, list(counts))]
    while todo:
        lo, hi, have = todo.pop()
        if hi - lo == 1:
            out[lo] = have
            continue
        mid, rng = (lo + hi) // 2, random.Random(f"{seed}:{lo}:{hi}")
        draws, rest, left = ends[mid] - ends[lo], sum(have), []
        for c in have:
            rest -= c
            x = _hypergeometric(rng, c, rest, draws)
            draws -= x
            left.append(x)
        todo += [(lo, mid, left), (mid, hi, [a - b for a, b in zip(have, left)])]
    return out


def default_weights(sources: list) -> dict:
    """5, 2, 1 repeating over the sources by code point, null last."""
    names = sorted((s for s in sources if s is not None), key=lambda s: s.encode("utf-8"))
    return {s: (5, 2, 1)[i % 3] for i, s in enumerate(names + [s for s in sources if s is None])}


def _uniform(*cols) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(_SPAN)


def plan(docs: DataFrame, weights=default_weights, volume: float = 1.5, max_repeats: int = 2,
         seed: int = 6, key: str = "doc_id", text: str = "text", source: str = "source",
         shard_words: int = SHARD_WORDS, keep: tuple = ()) -> DataFrame:
    """One row per row of ``docs``: key, source, size (words), source_size, target,
    copies (0 to ``max_repeats``) and shards (the output shard of each copy), and the
    columns of ``keep``.

    Null and empty texts have size 0 and count as documents of their source; a null
    source is a source; sources without words have target 0; repeated rows are drawn
    one by one; an empty table gives no rows.  Columns outside ``keep`` are ignored.
    """
    spark = docs.sparkSession
    rows = staged(docs.select(
        F.col(key).alias("_key"), F.col(source).alias("_source"), word_count(F.col(text)).alias("_size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("_crc"),
        *[F.col(c).alias(f"_keep_{c}") for c in keep]), "mix-rows")
    found = rows.groupBy("_source").agg(F.count(F.lit(1)).alias("n"), F.sum("_size").alias("words")).collect()
    found.sort(key=lambda r: (r["_source"] is None, (r["_source"] or "").encode("utf-8")))  # reruns draw alike
    sizes = {r["_source"]: r["words"] for r in found}
    weight = weights(list(sizes)) if callable(weights) else {s: weights.get(s, 0) for s in sizes}
    wanted = targets(sizes, weight, volume, max_repeats)
    facts = []
    for r in found:
        s, words, t = r["_source"], r["words"], wanted[r["_source"]]
        passes = min(int(max_repeats), int(t // words)) if words else 0
        facts.append((s, words, float(t), passes, float(t - passes * words), max(1, -(-r["n"] // BLOCK_ROWS))))
    few = len(facts) <= BROADCAST_SOURCES
    facts = spark.createDataFrame(facts, "source string, words long, target double, passes int, rest double, blocks int")
    facts = F.broadcast(facts) if few else facts
    placed = (rows.withColumn("_u", _uniform(F.lit(seed), "_key", "_crc"))
              .join(facts, rows["_source"].eqNullSafe(facts["source"]), "left")
              .withColumn("_block", F.floor(F.col("_u") * F.col("blocks")).cast("int")))
    # words of the source before each block, in permuted order
    before = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (placed.groupBy("source", "_block").agg(F.sum("_size").alias("bw"), F.first("rest").alias("rest"),
                                                     F.first("passes").alias("passes"))
              .withColumn("start", F.coalesce(F.sum("bw").over(before), F.lit(0)))
              .withColumn("gap", F.col("rest") - F.col("start"))
              .withColumn("copies", F.col("passes") + (F.col("gap") > 0).cast("int")))
    blocks = staged(blocks, "mix-blocks")
    counts = {r["source"]: r["c"] for r in blocks.groupBy("source").agg(F.sum("copies").alias("c")).collect()}
    names = [r["_source"] for r in found]
    shards = min(MAX_SHARDS, max(1, math.ceil(sum(wanted.values()) / shard_words)))
    quotas = splitting_tree([counts.get(s) or 0 for s in names], shards, seed)
    ranges, done = [], [0] * len(names)
    for shard, quota in enumerate(quotas):
        for i, q in enumerate(quota):
            if q:
                ranges.append((names[i], shard, done[i], done[i] + q - 1))
                done[i] += q
    ranges = (spark.createDataFrame(ranges, "source string, shard int, lo long, hi long")
              .select("source", "shard", F.explode(F.sequence("lo", "hi")).alias("nr")))
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), F.lit("shard"), "_block", "copy"), "_block", "copy")
    copies = (blocks.where("copies > 0")
              .select("source", "_block", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
              .withColumn("nr", (F.row_number().over(order) - 1).cast("long")))
    dealt = (copies.alias("c").join(ranges.alias("r"), (F.col("c.nr") == F.col("r.nr"))
                                    & F.col("c.source").eqNullSafe(F.col("r.source")))
             .groupBy("c.source", "c._block")
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("copy", "shard"))), lambda x: x["shard"]).alias("shards")))
    blocks = (blocks.alias("b").join(dealt.alias("d"), (F.col("b._block") == F.col("d._block"))
                                     & F.col("b.source").eqNullSafe(F.col("d.source")), "left")
              .select(F.col("b.source").alias("bs"), F.col("b._block").alias("bb"), "bw", "gap", "shards"))
    placed = placed.join(blocks, F.col("source").eqNullSafe(F.col("bs")) & (F.col("_block") == F.col("bb")), "left")
    # inside the block in which the target ends: the documents that fit, then the best filler
    inside = Window.partitionBy("source", "_block").orderBy("_u", "_key", "_crc")
    whole = Window.partitionBy("source", "_block")
    ends = (F.col("gap") > 0) & (F.col("gap") < F.col("bw"))
    placed = (placed.withColumn("_upto", F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("_nr", F.row_number().over(inside))
              .withColumn("_fits", F.when(ends, F.col("_upto") <= F.col("gap")).otherwise(F.col("gap") > 0))
              .withColumn("_miss", F.col("gap") - F.max(F.when(F.col("_fits"), F.col("_upto")).otherwise(0)).over(whole))
              .withColumn("_best", F.min(F.when(~F.col("_fits") & (F.col("_size") < 2 * F.col("_miss")),
                                                F.struct(F.abs(F.col("_miss") - F.col("_size")), F.col("_nr").alias("nr")))).over(whole))
              .withColumn("_extra", F.col("_fits") | (ends & (F.col("_nr") == F.coalesce(F.col("_best")["nr"], F.lit(-1))))))
    copies = (F.coalesce(F.col("passes"), F.lit(0)) + F.coalesce(F.col("_extra"), F.lit(False)).cast("int"))
    return placed.select(
        F.col("_key").alias(key), F.col("_source").alias("mix_source"), F.col("_size").alias("size"),
        F.col("words").cast("long").alias("source_size"), "target", copies.alias("copies"),
        F.slice(F.coalesce("shards", F.array().cast("array<int>")), 1, copies).alias("shards"),
        *[F.col(f"_keep_{c}").alias(c) for c in keep if c != key])


def mix(docs: DataFrame, seed: int = 6, key: str = "doc_id", **options) -> DataFrame:
    """The mixed stream: rows of ``docs`` with all their columns, one for each copy, and
    the output shard as ``mix_shard`` (with underscores behind it if there is such a column
    already).  Partitions hold whole shards; inside a shard rows are in a seeded random
    order.  Null and empty texts and sources without words are mixed as ``plan`` says; an
    empty table gives no rows."""
    placed, at = located(docs, "mix-docs")
    drawn = plan(placed, seed=seed, key=key, keep=(at,), **options).where("copies > 0").select(F.col(at).alias("at"), "shards")
    rows = placed.select(F.struct(*docs.columns).alias("doc"), F.col(at).alias("at"))
    rows = rows.join(drawn, "at").select("doc", F.posexplode("shards").alias("copy", "shard"))
    local = F.xxhash64(F.lit(seed), F.lit("slot"), F.col("doc")[key], F.col("copy"))
    rows = rows.repartition("shard").sortWithinPartitions("shard", local)
    return rows.select("doc.*", F.col("shard").alias(free_name(docs, "mix_shard")))
