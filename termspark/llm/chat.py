"""Chat formatting with cumulative-snapshot collapse (operator 3, native).

A log often holds a conversation several times, once after each turn.  Every turn gets
the rolling hash of all turns up to it.  A conversation is a snapshot if its last hash
is also the hash of a turn that another conversation goes on from.  Anti-joins drop
snapshots, and equal conversations keep the smallest identifier; what stays is rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

TEMPLATE = ("<|{role}|>\n", "\n<|end|>\n")


def turn_hashes(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(id, turns, hashes): a conversation's turns in order and the rolling hash up to each."""
    ordered = (turns.where(F.col(conv).isNotNull())
               .groupBy(F.col(conv).alias("id"))
               .agg(F.sort_array(F.collect_list(F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                                                         F.coalesce(F.col(text), F.lit("")).alias("text")))).alias("turns")))
    # sha2 of (previous hash, length of role, role, text): the length keeps role and text apart
    rolled = F.aggregate(
        "turns", F.array().cast("array<string>"),
        lambda done, x: F.concat(done, F.array(F.sha2(F.concat(
            F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit("")), F.lit(":"), F.length(x["role"]).cast("string"),
            F.lit(":"), x["role"], x["text"]).cast("binary"), 256))))
    return ordered.withColumn("hashes", rolled)


def maximal(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text", template: tuple[str, str] = TEMPLATE) -> DataFrame:
    """One row per conversation that no longer one continues: key, n_turns, snapshots
    (equal conversations, itself included), prefix_hash and the rendered text.

    Turns are ordered by number, then role, then text; null roles and texts count as
    empty, null turn numbers come first, and repeated turns stay.  Rows without a
    conversation identifier belong to no conversation.  Of equal conversations the
    smallest identifier stays.  An empty table gives no rows; other columns are ignored.
    """
    convs = staged(turn_hashes(turns, conv, turn, role, text), "chat")
    last = F.element_at("hashes", -1)
    whole = convs.groupBy(last.alias("h")).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("snapshots"))
    inner = convs.select(F.explode(F.slice("hashes", 1, F.size("hashes") - 1)).alias("h")).distinct()
    stays = whole.join(inner, "h", "left_anti")
    opening, closing = template
    before, after = opening.split("{role}")
    rendered = F.array_join(F.transform("turns", lambda x: F.concat(
        F.lit(before), x["role"], F.lit(after), x["text"], F.lit(closing))), "")
    return (convs.join(stays, "id")
            .select(F.col("id").alias(conv), F.size("turns").cast("long").alias("n_turns"), "snapshots",
                    F.col("h").alias("prefix_hash"), rendered.alias("text")))
