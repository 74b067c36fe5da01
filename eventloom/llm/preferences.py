"""Preference formatting: a pair of conversations as one prompt and two masked completions.

The prompt is the longest common prefix of the turns of the chosen and the rejected
conversation, rendered once; what follows in either is its completion, in which only the
text and the end mark of the assistant's turns count for the loss.

Only SQL functions.  ``segments`` keeps one row for each rendered turn, so no conversation,
however long, is gathered in one row; turns are compared by digests, place by place.
``assemble`` joins the segments of pairs whose size is known to be bounded.

Cases: turn numbers are places, a null one comes last; repeated turn numbers follow in the
order of role and text; null roles and texts are rendered as empty ones, but are told apart
from them where the sides are compared; rows without a conversation, conversations without
a pair and pairs with a null pair_id are left out; a pair that is given several times counts
once, and one pair_id must not name several pairs; a pair with one side missing has no
prompt; if one side is a prefix of the other, its completion has no rows; markers inside a
text are broken up, so that no text can end its turn.  Other columns stay out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _plain(c: str) -> Column:
    return F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("<|im_"), F.lit("<| im_"))


def segments(conversations: DataFrame, pairs: DataFrame, *, learned: str = "assistant") -> DataFrame:
    """(pair_id, part, turn, copy, role, rendered, loss_start, loss_end) for ``pairs``
    (pair_id, chosen_id, rejected_id).

    ``part`` is prompt, chosen or rejected; the loss covers the code points of ``rendered``
    from ``loss_start`` up to ``loss_end``, which are equal where nothing is learned.
    """
    copy = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    turns = (conversations.where("conv_id is not null").select("conv_id", "turn", "role", "text")
             .withColumn("copy", F.row_number().over(copy) - 1))
    known = pairs.where("pair_id is not null").select("pair_id", "chosen_id", "rejected_id").distinct()
    sides = known.select("pair_id", F.explode(F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("chosen_id").alias("conv_id")),
        F.struct(F.lit("rejected").alias("side"), F.col("rejected_id").alias("conv_id")))).alias("s")).select(
        "pair_id", "s.side", "s.conv_id")
    place = F.struct(F.col("turn").isNull().alias("last"), F.coalesce("turn", F.lit(0)).alias("turn"), F.col("copy"))
    both = turns.join(sides, "conv_id").withColumn("place", place)

    digest = F.sha2(F.to_json(F.struct("role", "text")), 256)
    spots = both.withColumn("digest", digest).groupBy("pair_id", "place").agg(
        F.count("*").alias("n"), F.min("digest").alias("least"), F.max("digest").alias("most"))
    parting = spots.where("n < 2 or least != most").groupBy("pair_id").agg(F.min("place").alias("parting"))

    shared = F.col("parting").isNull() | (F.col("place") < F.col("parting"))
    head = F.concat(F.lit(OPEN), _plain("role"), F.lit("\n"))
    body = F.concat(_plain("text"), F.lit(CLOSE))
    counts = ~shared & F.coalesce(F.col("role") == learned, F.lit(False))
    return (both.join(parting, "pair_id", "left").where(~shared | (F.col("side") == "chosen"))
            .select("pair_id", F.when(shared, "prompt").otherwise(F.col("side")).alias("part"), "turn", "copy", "role",
                    F.concat(head, body, F.lit("\n")).alias("rendered"),
                    F.when(counts, F.length(head)).otherwise(0).alias("loss_start"),
                    F.when(counts, F.length(head) + F.length(body)).otherwise(0).alias("loss_end")))


def assemble(rows: DataFrame) -> DataFrame:
    """One row for each pair: the texts of prompt, chosen and rejected, and the learned
    stretches of each completion as (from, to) in its code points.

    Gathers a pair in one row, so its turns must fit in one.
    """
    def of(part: str) -> Column:
        own = F.when(F.col("part") == part, F.struct(
            F.col("turn").isNull().alias("last"), "turn", "copy", "rendered", "loss_start", "loss_end"))
        return F.array_sort(F.collect_list(own)).alias(part)

    def text(part: str) -> Column:
        return F.array_join(F.col(f"{part}.rendered"), "").alias(part)

    def learned(part: str) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,to:int>>").alias("spans"))
        folded = F.aggregate(part, zero, lambda acc, t: F.struct(
            (acc["at"] + F.length(t["rendered"])).alias("at"),
            F.when(t["loss_end"] > t["loss_start"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + t["loss_start"]).alias("from"), (acc["at"] + t["loss_end"]).alias("to")))))
            .otherwise(acc["spans"]).alias("spans")))
        return folded["spans"].alias(f"{part}_loss")

    parts = ("prompt", "chosen", "rejected")
    return rows.groupBy("pair_id").agg(*map(of, parts)).select(
        "pair_id", *map(text, parts), learned("chosen"), learned("rejected"))


def neighbours(conversations: DataFrame) -> DataFrame:
    """Pairs of the conversations 2k (chosen) and 2k + 1 (rejected), for tables that carry no
    preferences."""
    k = F.expr("floor(conv_id / 2)").cast("bigint")
    return (conversations.where("conv_id is not null").select(k.alias("pair_id")).distinct()
            .select("pair_id", (F.col("pair_id") * 2).alias("chosen_id"), (F.col("pair_id") * 2 + 1).alias("rejected_id")))
