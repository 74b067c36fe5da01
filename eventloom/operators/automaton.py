"""Sequence patterns whose steps may repeat, with what became of every match that began.

A pattern is a list of :class:`Step`.  Each row that meets the first step begins a match; the
match goes on with the nearest row that meets what comes next and never branches.  It ends as

* ``matched``: all rows of the pattern were found in time,
* ``timeout``: the time was over; ``reached`` says how many rows of the pattern were found,
* ``pending``: the data ended before (only where the end of the data does not end the wait),

or without a trace, when a row that had to be the very next one was another.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.ordered import ROWS_PER_CHUNK, chunk_rows, running, uncut

ORDER = ("ts_ms", "seq")


@dataclass(frozen=True)
class Step:
    """``times`` rows of the given kinds.  ``next`` asks that its first row follows the step
    before at once, ``consecutive`` that its rows follow one another at once."""

    kinds: tuple[str, ...]
    times: int = 1
    next: bool = False
    consecutive: bool = False


@dataclass(frozen=True)
class Pattern:
    steps: tuple[Step, ...]
    within_ms: int

    @property
    def rows(self) -> list[tuple[frozenset[str], bool]]:
        """The rows of a match: the kinds of each, and whether it must be the very next one."""
        return [(frozenset(s.kinds), (s.next if i == 0 else s.consecutive) and (at > 0 or i > 0))
                for at, s in enumerate(self.steps) for i in range(s.times)]

    @property
    def columns(self) -> list[str]:
        return ["status", "reached", *[f"t{i + 1}" for i in range(len(self.rows))]]


def match_pattern(df: DataFrame, keys: Sequence[str], kind: str, pattern: Pattern, *, ended: bool = False,
                  order: Sequence[str] = ORDER, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """(keys, status, reached, t1 .. tn): one row for each match that began, in as far as it did
    not break.  ``tn`` are the times of its rows, null from ``reached`` on.

    Built from the end: a row that can be the i-th of a match learns the times of the rows that
    go on from it and, where the chain is broken, the time of the row that broke it.  All passes
    share one cut and one partitioning, so a step that repeats costs windows but no shuffle,
    and no partial match is ever copied.  The time limit is applied at the end, as it
    depends on the first row.
    """
    wanted, ms = pattern.rows, order[0]
    n = len(wanted)
    newest = df.agg(F.max(ms)).scalar()
    sets = list(dict.fromkeys(kinds for kinds, _ in wanted))
    meets = {kinds: f"_k{i}" for i, kinds in enumerate(sets)}
    marks = {name: F.coalesce(F.col(kind).isin(*sorted(kinds)), F.lit(False)) for kinds, name in meets.items()}
    rows = chunk_rows(df.withColumns(marks).select(*keys, *order, *marks), keys, order, rows_per_chunk)
    # _path: times from this row on, if it is the i-th of a match, and what broke the chain.
    none = F.lit(None).cast("bigint")
    chain = "struct<times:array<bigint>,broken:bigint>"

    def link(times: Column, broken: Column) -> Column:
        return F.struct(times.alias("times"), broken.alias("broken")).cast(chain)

    rows = rows.withColumn("_path", F.when(F.col(meets[wanted[-1][0]]), link(F.array(ms), none)))
    for i in range(n - 2, -1, -1):
        kinds, strict = wanted[i + 1]
        going_on = F.struct(*order, "_path")
        if not strict:
            going_on = F.when(F.col("_path").isNotNull(), going_on)
        ahead = running(rows, keys, order, {"_ahead": ("min", going_on)}, inclusive=False, reverse=True)
        found, path = F.col("_ahead").isNotNull(), F.col("_ahead")["_path"]
        own = (F.when(~found, link(F.array(ms), none))
               .when(path.isNull(), link(F.array(ms), F.col("_ahead")[ms]))
               .otherwise(link(F.concat(F.array(ms), path["times"]), path["broken"])))
        rows = ahead.withColumn("_path", F.when(F.col(meets[wanted[i][0]]), own)).drop("_ahead")

    deadline = F.col(ms) + pattern.within_ms
    began = (uncut(rows).where("_path is not null")
             .withColumn("_in_time", F.filter("_path.times", lambda t: t < deadline))
             .withColumn("reached", F.size("_in_time").cast("bigint")))
    # A break counts only if it came in time and right after the last row that was found.
    broke = ((F.col("reached") == F.size("_path.times")) & F.col("_path.broken").isNotNull()
             & (F.col("_path.broken") < deadline))
    status = (F.when(F.col("reached") == n, "matched")
              .when(F.lit(ended) | (F.col("_newest") >= deadline), "timeout").otherwise("pending"))
    return (began.withColumn("_newest", newest).where((F.col("reached") == n) | ~F.coalesce(broke, F.lit(False)))
            .select(*keys, status.alias("status"), "reached",
                    *[F.get("_in_time", F.lit(i)).alias(f"t{i + 1}") for i in range(n)]))
