"""Rules that arrive while actions do: each holds from its arrival until its slot gets another.

A slot is the key of a rule table; at any moment it has one rule.  The pair (previous action,
current action) of a key is matched against the rules that hold at that moment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.joins import MAX_RULES
from eventloom.operators.ordered import ROWS_PER_CHUNK, neighbourhood, running


def versions(rules: DataFrame, place: str = "seq", rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """(rule_seq, until, slot, action1, action2): ``until`` is the place of the slot's next rule,
    null if there is none."""
    own = rules.select("slot", place, "action1", "action2")
    ahead = running(own, ["slot"], [place], {"until": ("min", F.col(place))}, inclusive=False, reverse=True,
                    rows_per_chunk=rows_per_chunk)
    return ahead.select(F.col(place).alias("rule_seq"), "until", "slot", "action1", "action2")


def as_of(paired: DataFrame, rules: DataFrame, bounds: tuple[int | None, int | None], *, place: str = "seq",
          rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """``paired`` (place, action1, action2, ...) with (slot, rule_seq) of each rule that holds and
    asks for just this pair; ``bounds`` are the first and last place of ``paired``.

    Places are cut into as many bins as a slot has rules on average.  A slot has one rule at a
    time, so the rules' copies in the bins that they reach into are at most twice their number,
    however long each one holds, and an action meets only the few rules of its bin: neither
    a pair that most actions have nor a rule that is renewed all the time multiplies rows.
    """
    lo, hi = bounds
    held = versions(rules, place, rows_per_chunk)
    n, slots = held.agg(F.count("*"), F.count_if(F.col("until").isNull())).first()
    if lo is None or not n:
        lo, hi, n, slots = 0, 0, 0, 0
    width = (hi - lo) // max(1, n // max(1, slots)) + 1

    def bin_of(c):
        return F.floor((c - lo) / width).cast("bigint")

    first = F.greatest(F.col("rule_seq"), F.lit(lo))
    last = F.least(F.coalesce("until", F.lit(hi)), F.lit(hi))
    copies = (held.where(first <= last)
              .withColumn("_bin", F.explode(F.sequence(bin_of(first), bin_of(last)))))
    copies = F.broadcast(copies) if 2 * n <= MAX_RULES else copies
    holds = (F.col(place) > F.col("rule_seq")) & (F.col("until").isNull() | (F.col(place) < F.col("until")))
    return (paired.withColumn("_bin", bin_of(F.col(place))).join(copies, ["action1", "action2", "_bin"])
            .where(holds).drop("_bin", "until"))


def match_arriving(actions: DataFrame, rules: DataFrame, key: str, *, place: str = "seq",
                   rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """(place, key, action1, action2, slot, rule_seq) of actions (place, key, action) that
    complete a pair which a rule (place, slot, action1, action2) asked for at that time."""
    bounds = tuple(actions.agg(F.min(place), F.max(place)).first())
    paired = neighbourhood(actions.select(place, key, "action"), [key], [place], 1,
                           lambda w: {"action1": F.lag("action", 1).over(w)}, rows_per_chunk=rows_per_chunk)
    paired = paired.where("action1 is not null").withColumnRenamed("action", "action2")
    return as_of(paired, rules, bounds, place=place, rows_per_chunk=rows_per_chunk).select(
        place, key, "action1", "action2", "slot", "rule_seq")
