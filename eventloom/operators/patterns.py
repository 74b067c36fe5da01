"""Sequence patterns over keyed, ordered events."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.operators.ordered import ROWS_PER_CHUNK, chunk_rows, neighbourhood, running, uncut

ORDER = ("ts_ms", "seq")


def match_consecutive(df: DataFrame, keys: Sequence[str], steps: Sequence[Column], *,
                      within_ms: int | None = None, order: Sequence[str] = ORDER,
                      rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Strictly consecutive rows of a key that meet ``steps`` one after the other.

    One output row per match, at its last row, with times ``t1 .. tk``.  Matches may
    overlap.  With ``within_ms`` the last row must come less than that after the first.
    """
    k, ms = len(steps), order[0]
    marks = {f"_s{i}": F.coalesce(step, F.lit(False)) for i, step in enumerate(steps)}

    def look_back(w):
        found = F.col(f"_s{k - 1}")
        for i in range(k - 1):
            found = found & F.coalesce(F.lag(f"_s{i}", k - 1 - i).over(w), F.lit(False))
        times = {f"t{i + 1}": F.lag(ms, k - 1 - i).over(w) for i in range(k - 1)}
        return {"_found": found, **times, f"t{k}": F.col(ms)}

    out = neighbourhood(df.withColumns(marks).select(*keys, *order, *marks), keys, order, k - 1, look_back,
                        rows_per_chunk=rows_per_chunk).where("_found")
    if within_ms is not None:
        out = out.where(F.col(f"t{k}") - F.col("t1") < within_ms)
    return out.select(*keys, *[f"t{i + 1}" for i in range(k)])


def match_times(df: DataFrame, keys: Sequence[str], condition: Column, times: int, *,
                within_ms: int | None = None, order: Sequence[str] = ORDER,
                rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """``times`` consecutive rows that all meet one condition."""
    return match_consecutive(df, keys, [condition] * times, within_ms=within_ms, order=order,
                             rows_per_chunk=rows_per_chunk)


def match_sequence(df: DataFrame, keys: Sequence[str], steps: Sequence[Column], strict: Sequence[bool],
                   within_ms: int, *, order: Sequence[str] = ORDER,
                   rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Rows of a key that meet ``steps`` in turn; one match at most for each first row.

    Between step i and i + 1 lie no other rows if ``strict[i]``, else any number, and the
    nearest row that meets step i + 1 is taken.  The last row must come less than
    ``within_ms`` after the first.  Times come out as ``t1 .. tk``.

    Built from the end: each row learns the nearest row ahead that goes on, with its times.
    All passes share one cut and one partitioning.
    """
    k, ms = len(steps), order[0]
    marks = {f"_s{i}": F.coalesce(step, F.lit(False)) for i, step in enumerate(steps)}
    rows = chunk_rows(df.withColumns(marks).select(*keys, *order, *marks), keys, order, rows_per_chunk)
    rows = rows.withColumn("_times", F.when(F.col(f"_s{k - 1}"), F.array(ms)))
    for i in range(k - 2, -1, -1):
        going_on = F.struct(*order, "_times")
        if not strict[i]:
            going_on = F.when(F.col(f"_s{i + 1}"), going_on)
        ahead = running(rows, keys, order, {"_ahead": ("min", going_on)}, inclusive=False, reverse=True)
        rows = (ahead.withColumn("_times", F.when(F.col(f"_s{i}"), F.concat(F.array(ms), F.col("_ahead._times"))))
                .drop("_ahead"))
    times = [F.col("_times")[i].alias(f"t{i + 1}") for i in range(k)]
    return (uncut(rows).where(F.col("_times").isNotNull() & (F.col("_times")[k - 1] - F.col("_times")[0] < within_ms))
            .select(*keys, *times))


def match_followed_by(df: DataFrame, keys: Sequence[str], first: Column, second: Column, within_ms: int, *,
                      ended: bool = False, order: Sequence[str] = ORDER, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """For every ``first`` row, the next ``second`` row of its key, other rows in between allowed.

    ``status`` is ``matched`` if it comes less than ``within_ms`` later, ``timeout`` if the
    data reaches the deadline without it, ``pending`` if the data ends before.  With ``ended``
    the end of the data ends every wait: what was pending is a ``timeout``.
    """
    ms = order[0]
    newest = df.agg(F.max(ms)).scalar()
    position = F.struct(*order)
    marked = df.withColumns({"_first": first, "_second": second}).where("_first or _second")
    ahead = running(marked.select(*keys, *order, "_first", "_second"), keys, order,
                    {"_next": ("min", F.when(F.col("_second"), position))},
                    inclusive=False, reverse=True, rows_per_chunk=rows_per_chunk)
    second_ms = F.col("_next")[ms]
    matched = second_ms - F.col(ms) < within_ms
    status = (F.when(matched, "matched")
              .when(F.col("_newest") >= F.col(ms) + within_ms, "timeout")
              .otherwise("timeout" if ended else "pending"))
    return (
        ahead.where("_first").withColumn("_newest", newest)
        .select(*keys, F.col(ms).alias("first_ms"), F.when(matched, second_ms).alias("second_ms"),
                status.alias("status"))
    )


@dataclass(frozen=True)
class Machine:
    """A state machine: ``moves[state][event]`` is the next state.

    An event without a move, and the ``reset`` target, lead to ``initial``.  The ``accept``
    target reports a match and leaves the state as it is, so matches may overlap.
    """

    states: tuple[str, ...]
    initial: str
    moves: Mapping[str, Mapping[str, str]]
    accept: str = "Matched"
    reset: str = "Terminal"

    @property
    def events(self) -> list[str]:
        return sorted({event for moves in self.moves.values() for event in moves})

    def step(self, state: str, event: str | None) -> tuple[str, bool]:
        target = self.moves.get(state, {}).get(event, self.initial)
        if target == self.accept:
            return state, True
        return (self.initial if target == self.reset else target), False

    def effect(self, event: str | None) -> Column:
        """What one event does to every state: the number of the next state, by state number."""
        return F.array(*[F.lit(self.states.index(self.step(state, event)[0])) for state in self.states])


# An event maps states to states, and a run of events is the composition of such maps.
# Composition is associative, so stretches of a key can be composed apart and then chained.

def _rows_of_maps(column: pa.ListArray, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, n)


def _column_of_maps(maps: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(maps) + 1, dtype=np.int32) * maps.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(maps.astype(np.int32).ravel()))


def _compose_batch(maps: np.ndarray, opens: np.ndarray, carry: np.ndarray) -> np.ndarray:
    """Inclusive composition along each run; ``opens`` marks where a run begins."""
    run = np.cumsum(opens)
    out = maps.copy()
    step = 1
    while step < len(out):
        rows = np.nonzero(run[step:] == run[:-step])[0] + step
        if not len(rows):
            break
        out[rows] = np.take_along_axis(out[rows], out[rows - step], axis=1)
        step *= 2
    going_on = run == 0
    out[going_on] = out[going_on][:, carry]
    return out


def _scan(n_states: int):
    identity = np.arange(n_states, dtype=np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = identity
        for batch in batches:
            if not batch.num_rows:
                continue
            maps = _rows_of_maps(batch.column("_map"), n_states)
            opens = batch.column("_opens").to_numpy(zero_copy_only=False)
            through = _compose_batch(maps, opens, carry)
            before = np.vstack([carry[None, :], through[:-1]])
            before[opens] = identity
            carry = through[-1]
            names = [*batch.schema.names, "_before", "_through"]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, _column_of_maps(before), _column_of_maps(through)], names)

    return run


def _compose(df: DataFrame, run_keys: Sequence[str], order: Sequence[str], n_states: int) -> DataFrame:
    """Add ``_before`` and ``_through``: the composed ``_map`` of a run up to and with the row.

    The window puts the rows of a run next to each other and in order; the Arrow step then
    passes over them batch by batch, so a run of any length takes constant memory.
    """
    w = Window.partitionBy(*run_keys).orderBy(*order)
    flagged = df.withColumn("_opens", F.row_number().over(w) == 1)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in flagged.schema.fields)
    return flagged.mapInArrow(_scan(n_states), f"{fields}, _before array<int>, _through array<int>").drop("_opens")


def run_machine(df: DataFrame, keys: Sequence[str], event: str, machine: Machine, *,
                order: Sequence[str] = ORDER, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Run a machine over each key; returns the rows that report a match, with their state."""
    keys, n = list(keys), len(machine.states)
    move = machine.effect(None)
    for name in machine.events:
        move = F.when(F.col(event) == name, machine.effect(name)).otherwise(move)
    rows = chunk_rows(df.select(*keys, *order, event), keys, order, rows_per_chunk).withColumn("_map", move)

    within = _compose(rows, [*keys, "_chunk"], order, n)
    chunk_map = (
        _compose(rows.where("_cut"), [*keys, "_chunk"], order, n)
        .groupBy(*keys, "_chunk").agg(F.max_by("_through", F.struct(*order)).alias("_map")))
    chained = _compose(chunk_map, keys, ["_chunk"], n).select(
        *[F.col(k).alias("_h_" + k) for k in keys], F.col("_chunk").alias("_h_chunk"),
        F.col("_before").alias("_start_map"))
    same = F.col("_chunk") == F.col("_h_chunk")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("_h_" + k))

    initial = machine.states.index(machine.initial)
    start = F.coalesce(F.col("_start_map")[initial], F.lit(initial))
    placed = (within.join(F.broadcast(chained), same, "left")
              .withColumn("_s", start)
              .withColumn("state_no", F.col("_before")[F.col("_s")]))
    reports = F.lit(False)
    for i, state in enumerate(machine.states):
        for name in machine.events:
            if machine.step(state, name)[1]:
                reports = reports | ((F.col("state_no") == i) & (F.col(event) == name))
    names = F.array(*[F.lit(s) for s in machine.states])
    return uncut(placed.where(reports)).select(
        *keys, *order, F.element_at(names, F.col("state_no") + 1).alias("state"))


# The three-failures machine.
THREE_FAILURES = Machine(
    states=("Initial", "S1", "S2"),
    initial="Initial",
    moves={
        "Initial": {"fail": "S1", "success": "Terminal"},
        "S1": {"fail": "S2", "success": "Terminal"},
        "S2": {"fail": "Matched", "success": "Terminal"},
    },
)
