"""Stateful per-key processors.

Two families.  *Arrival* processors act on rows as they come, in ``seq`` order within a
micro-batch.  *Event-time* processors hold rows back until the watermark passes them and
then act in (ts_ms, seq) order, so the result does not depend on how input was batched.

State is proportional to what the operator must remember, never to a key's history,
except for the held-back rows, which the watermark bounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventloom.operators.automaton import Pattern
from eventloom.operators.patterns import Machine

Rows = Iterator[pd.DataFrame]


def _cut(total: int, n: int) -> int:
    """Integer quotient cut towards zero, as SQL has it."""
    return total // n if total >= 0 else -(-total // n)


def frame(columns: list[str], rows: list[tuple]) -> pd.DataFrame:
    """Values stay what they are, so that a null among long numbers turns none into a double."""
    return pd.DataFrame(rows, columns=columns, dtype=object)


def listed(state: Any) -> list[tuple]:
    """The entries of list state, none if there is no state: one call less than to ask first."""
    return list(map(tuple, state.get()))


def keep(state: Any, entries: list[tuple], had: bool) -> None:
    """Replace list state, of which the caller knows whether it ``had`` entries."""
    if entries:
        state.put(entries)
    elif had:
        state.clear()


class ArrivalProcessor(StatefulProcessor):
    """Collects the rows of one key and micro-batch in ``seq`` order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open()

    def open(self) -> None:
        raise NotImplementedError

    def on_rows(self, key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        raise NotImplementedError

    def handleInputRows(self, key: tuple, rows: Rows, timerValues: Any) -> Rows:
        frames = list(rows)
        pdf = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]
        if not pdf["seq"].is_monotonic_increasing:
            pdf = pdf.sort_values("seq", ignore_index=True)
        out = self.on_rows(key, pdf)
        if len(out):
            yield out

    def close(self) -> None:
        pass

    @staticmethod
    def value_or(state: Any, default: tuple) -> tuple:
        held = state.get()
        return default if held is None else tuple(held)


class EveryNth(ArrivalProcessor):
    """Integer average of ``ts_ms`` over each run of n rows, then start again."""

    OUT = "user_id long, group_no long, avg_ts_ms long"

    def __init__(self, n: int) -> None:
        self.n = n

    def open(self) -> None:
        self.state = self.handle.getValueState("open_run", "seen long, total long")

    def on_rows(self, key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        seen, total = self.value_or(self.state, (0, 0))
        group = (seen + np.arange(len(pdf))) // self.n
        sums = pdf["ts_ms"].groupby(group).sum()
        if total:
            sums.iloc[0] += total
        seen += len(pdf)
        full = sums[sums.index < seen // self.n]
        rest = int(sums.iloc[-1]) if seen % self.n else 0
        self.state.update((seen, rest))
        return pd.DataFrame({"user_id": key[0], "group_no": full.index.astype("int64"),
                             "avg_ts_ms": (full // self.n).to_numpy("int64")})


class BufferedBatches(ArrivalProcessor):
    """Buffer ``size`` rows per shard and flush them as one row; the rest waits in state."""

    OUT = "shard long, batch_no long, n long, first_seq long, last_seq long, urls string"

    def __init__(self, size: int) -> None:
        self.size = size

    def open(self) -> None:
        self.buffer = self.handle.getListState("buffer", "seq long, url string")
        self.flushed = self.handle.getValueState("flushed", "n long")

    def on_rows(self, key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        held = list(self.buffer.get()) if self.buffer.exists() else []
        rows = [*map(tuple, held), *zip(pdf["seq"].tolist(), pdf["url"].tolist())]
        (first,) = self.value_or(self.flushed, (0,))
        full = len(rows) // self.size
        out = []
        for b in range(full):
            part = rows[b * self.size:(b + 1) * self.size]
            out.append((key[0], first + b, self.size, part[0][0], part[-1][0], ",".join(u for _, u in part)))
        rest = rows[full * self.size:]
        self.buffer.put(rest) if rest else self.buffer.clear()
        self.flushed.update((first + full,))
        return frame(["shard", "batch_no", "n", "first_seq", "last_seq", "urls"], out)


class CountWindow(ArrivalProcessor):
    """At every ``slide``-th row of a key, count and maximum of its last ``size`` rows."""

    OUT = "seq long, user_id long, row_no long, cnt long, max_value double"

    def __init__(self, size: int, slide: int) -> None:
        self.size, self.slide = size, slide

    def open(self) -> None:
        self.recent = self.handle.getListState("recent", "value double")
        self.seen = self.handle.getValueState("seen", "n long")

    def on_rows(self, key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        held = [r[0] for r in self.recent.get()] if self.recent.exists() else []
        (seen,) = self.value_or(self.seen, (0,))
        values = pd.Series([*held, *pdf["value"].tolist()])
        tops = values.rolling(self.size, min_periods=1).max().to_numpy()[len(held):]
        row_no = seen + 1 + np.arange(len(pdf))
        self.seen.update((int(row_no[-1]),))
        self.recent.put([(float(v),) for v in values.iloc[max(0, len(values) - self.size + 1):]])
        out = pd.DataFrame({"seq": pdf["seq"], "user_id": key[0], "row_no": row_no,
                            "cnt": np.minimum(row_no, self.size), "max_value": tops})
        return out[out["row_no"] % self.slide == 0]


class CountChangelog(ArrivalProcessor):
    """Changes of a grouped count: +I for the first row, then -U old and +U new."""

    OUT = "seq long, user_id long, op string, cnt long"

    def open(self) -> None:
        self.count = self.handle.getValueState("count", "n long")

    def on_rows(self, key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        (seen,) = self.value_or(self.count, (0,))
        n, seq = len(pdf), pdf["seq"].to_numpy()
        cnt = seen + 1 + np.arange(n)
        first = 0 if seen else 1  # the first row of a key replaces nothing
        self.count.update((seen + n,))
        return pd.DataFrame({"seq": np.concatenate([seq[first:], seq]), "user_id": key[0],
                             "op": ["-U"] * (n - first) + ["+I"] * first + ["+U"] * (n - first),
                             "cnt": np.concatenate([cnt[first:] - 1, cnt])})


class RunningCount(ArrivalProcessor):
    """The count of a key after each of its rows."""

    OUT = "seq long, user_id long, cnt long"

    def open(self) -> None:
        self.count = self.handle.getValueState("count", "n long")

    def on_rows(self, key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        (seen,) = self.value_or(self.count, (0,))
        self.count.update((seen + len(pdf),))
        return pd.DataFrame({"seq": pdf["seq"], "user_id": key[0], "cnt": seen + 1 + np.arange(len(pdf))})


class PreviousAction(ArrivalProcessor):
    """Pair each action with the key's previous one; rules are joined afterwards."""

    OUT = "seq long, user_id long, action1 string, action2 string"

    def open(self) -> None:
        self.last = self.handle.getValueState("last", "action string")

    def on_rows(self, key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        (last,) = self.value_or(self.last, (None,))
        before = [last, *pdf["action"].tolist()[:-1]]
        self.last.update((pdf["action"].iloc[-1],))
        out = pd.DataFrame({"seq": pdf["seq"], "user_id": key[0], "action1": before, "action2": pdf["action"]})
        return out[out["action1"].notna()]


class HistoryPartners(ArrivalProcessor):
    """Join with the whole history of the other side: how many partners a row has so far, and
    the newest one.  State is two counts and two numbers per key, not the rows."""

    OUT = "user_id long, seq long, side string, n_partners long, newest_partner long"

    def open(self) -> None:
        self.seen = self.handle.getValueState("seen", "n_left long, n_right long, left long, right long")

    def on_rows(self, key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        n_left, n_right, newest_left, newest_right = self.value_or(self.seen, (0, 0, -1, -1))
        seq, left = pdf["seq"].to_numpy("int64"), (pdf["side"] == "left").to_numpy()
        lefts, rights = n_left + np.cumsum(left), n_right + np.cumsum(~left)
        last_left = np.maximum.accumulate(np.where(left, seq, newest_left))
        last_right = np.maximum.accumulate(np.where(left, newest_right, seq))
        self.seen.update((int(lefts[-1]), int(rights[-1]), int(last_left[-1]), int(last_right[-1])))
        partners, newest = np.where(left, rights, lefts), np.where(left, last_right, last_left)
        return pd.DataFrame({"user_id": key[0], "seq": seq, "side": pdf["side"], "n_partners": partners,
                             "newest_partner": pd.array(newest, dtype="Int64")}).assign(
            newest_partner=lambda d: d["newest_partner"].where(d["n_partners"] > 0))


class RunMachine(ArrivalProcessor):
    """A table-driven state machine per key."""

    OUT = "user_id long, ts_ms long, seq long, state string"

    def __init__(self, machine: Machine) -> None:
        self.machine = machine

    def open(self) -> None:
        self.state = self.handle.getValueState("state", "name string")

    def on_rows(self, key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        (state,) = self.value_or(self.state, (self.machine.initial,))
        out = []
        for seq, ms, kind in zip(pdf["seq"].tolist(), pdf["ts_ms"].tolist(), pdf["kind"].tolist()):
            after, reports = self.machine.step(state, kind)
            if reports:
                out.append((key[0], ms, seq, state))
            state = after
        self.state.update((state,))
        return frame(["user_id", "ts_ms", "seq", "state"], out)


class StateProfile(ArrivalProcessor):
    """Value, list, map, reducing and aggregating state side by side.

    The list keeps one entry per micro-batch (its row count), not every row.
    """

    OUT = ("user_id long, list_size long, map_count long, reduced_url string, reduced_ts long, "
           "agg_text string")

    def __init__(self, ttl_ms: int | None = None) -> None:
        self.ttl_ms = ttl_ms

    def open(self) -> None:
        ttl = {"ttlDurationMs": self.ttl_ms} if self.ttl_ms else {}
        self.latest = self.handle.getValueState("latest", "url string", **ttl)
        self.sizes = self.handle.getListState("sizes", "n long", **ttl)
        self.per_user = self.handle.getMapState("per_user", "user_id long", "n long", **ttl)
        self.reduced = self.handle.getValueState("reduced", "url string, ts_ms long", **ttl)
        self.total = self.handle.getValueState("total", "n long", **ttl)

    def on_rows(self, key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        self.latest.update((pdf["url"].iloc[-1],))
        self.sizes.appendValue((len(pdf),))
        had = self.per_user.getValue(key)[0] if self.per_user.containsKey(key) else 0
        self.per_user.updateValue(key, (had + len(pdf),))
        first_url = self.value_or(self.reduced, (pdf["url"].iloc[0], 0))[0]
        self.reduced.update((first_url, int(pdf["ts_ms"].iloc[-1])))
        (total,) = self.value_or(self.total, (0,))
        self.total.update((total + len(pdf),))
        self.latest.clear()
        listed = sum(r[0] for r in self.sizes.get())
        url, ms = self.reduced.get()
        return frame(["user_id", "list_size", "map_count", "reduced_url", "reduced_ts", "agg_text"],
                     [(key[0], listed, self.per_user.getValue(key)[0], url, ms, f"count: {self.total.get()[0]}")])


class EventTimeProcessor(StatefulProcessor):
    """Holds rows until the watermark reaches them, then hands them over in time order.

    ``delay_ms`` is set where the wanted watermark is not the stream's own (see
    :class:`EventTimer`).  One timer per key is pending: the earliest thing to do.

    An entry of the held state is a stretch of rows, a list for each column, not one row: what
    an entry costs in the state store and on the way there is paid once for many rows.
    """

    HELD = "ts_ms long, seq long, url string"
    ROWS_PER_ENTRY = 10_000
    delay_ms = 0

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        fields = [f.split() for f in self.HELD.split(",")]
        self.names = [name for name, _ in fields]
        self.held = handle.getListState("held", ", ".join(f"{name} array<{kind}>" for name, kind in fields))
        self.due = handle.getValueState("due", "ms long")
        self.open()

    def open(self) -> None:
        pass

    def on_ready(self, key: tuple, ready: list[tuple], watermark: int) -> tuple[list[tuple], int | None]:
        """Act on rows up to the watermark; return output rows and the next deadline."""
        raise NotImplementedError

    def columns(self) -> list[str]:
        return [f.strip().split(" ")[0] for f in self.OUT.split(",")]

    def _emits(self, key: str, columns: list[str]) -> None:
        """Output of the key (name and type) and long columns, unless the class says otherwise."""
        if not hasattr(self, "OUT"):
            self.OUT = ", ".join([key, *[c if " " in c else f"{c} long" for c in columns]])

    def _arm(self, wanted: int, now: int | None) -> None:
        """Move the timer of the key from ``now``, if it has one, to ``wanted``."""
        if now == wanted:
            return
        if now is not None:
            self.handle.deleteTimer(now)
        self.handle.registerTimer(wanted)
        self.due.update((wanted,))

    def handleInputRows(self, key: tuple, rows: Rows, timerValues: Any) -> Rows:
        times = []
        for pdf in rows:
            self.held.appendValue(tuple(pdf[c].tolist() for c in self.names))
            times.append(int(pdf["ts_ms"].min()) - self.delay_ms)
        due = self.due.get()
        now = None if due is None else due[0]
        self._arm(min(times if now is None else [*times, now]), now)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Rows:
        watermark = timerValues.getCurrentWatermarkInMs() + self.delay_ms
        entries = listed(self.held)
        held = sorted(row for entry in entries for row in zip(*entry))
        ready = [r for r in held if r[0] <= watermark]
        rest = held[len(ready):]
        if ready:
            keep(self.held, [tuple(map(list, zip(*rest[i:i + self.ROWS_PER_ENTRY])))
                             for i in range(0, len(rest), self.ROWS_PER_ENTRY)], bool(entries))
        out, deadline = self.on_ready(key, ready, watermark)
        times = [t for t in ([rest[0][0]] if rest else []) + [deadline] if t is not None]
        if times:
            self._arm(min(times) - self.delay_ms, None)  # the engine removes the timer that fired
        else:
            self.due.clear()
        if out:
            yield frame(self.columns(), out)

    def close(self) -> None:
        pass


class OverAverage(EventTimeProcessor):
    """Integer average of ``ts_ms`` over the current and the preceding rows."""

    OUT = "seq long, user_id long, avg_ts_ms long"

    def __init__(self, preceding: int) -> None:
        self.preceding = preceding

    def open(self) -> None:
        self.recent = self.handle.getListState("recent", "ts_ms long")

    def on_ready(self, key, ready, watermark):
        times = [t for t, in listed(self.recent)]
        old = len(times)
        times += [r[0] for r in ready]
        out = []
        for i, row in enumerate(ready, start=old):
            span = times[max(0, i - self.preceding):i + 1]
            out.append((row[1], key[0], _cut(sum(span), len(span))))
        if ready:
            self.recent.put([(t,) for t in times[max(0, len(times) - self.preceding):]])
        return out, None


class ConsecutiveMatch(EventTimeProcessor):
    """``times`` consecutive rows of one kind, optionally within a time bound."""

    def __init__(self, kind: str, times: int, within_ms: int | None = None, key: str = "user_id long") -> None:
        self.kind, self.times, self.within_ms = kind, times, within_ms
        self._emits(key, [f"t{i + 1}" for i in range(times)])

    def open(self) -> None:
        self.run = self.handle.getListState("run", "ts_ms long")

    def on_ready(self, key, ready, watermark):
        run = [t for t, in listed(self.run)]
        had, out = bool(run), []
        for ms, _, kind in ready:
            run = [*run, ms][-self.times:] if kind == self.kind else []
            if len(run) == self.times and (self.within_ms is None or run[-1] - run[0] < self.within_ms):
                out.append((key[0], *run))
        run = run[1 - self.times:] if self.times > 1 else []
        keep(self.run, [(t,) for t in run], had)
        return out, None


class SequenceMatch(EventTimeProcessor):
    """A sequence of steps, each with its kinds of row; see ``patterns.match_sequence``.

    ``strict[i]`` asks that step i + 1 is the very next row.  State holds the open matches,
    which ``within_ms`` bounds: those at one step share their fate and move together.
    """

    def __init__(self, steps: list[list[str]], strict: list[bool], within_ms: int, key: str = "user_id long") -> None:
        self.steps, self.strict, self.within_ms = [frozenset(s) for s in steps], strict, within_ms
        self._emits(key, [f"t{i + 1}" for i in range(len(steps))])

    def open(self) -> None:
        times = ", ".join(f"t{i + 1} long" for i in range(len(self.steps) - 1))
        self.partial = self.handle.getListState("partial", f"reached long, {times}")

    def on_ready(self, key, ready, watermark):
        last = len(self.steps) - 1
        waits: list[list[tuple]] = [[] for _ in range(last)]
        partial = listed(self.partial)
        for reached, *times in partial:
            waits[reached - 1].append(tuple(times[:reached]))
        out = []
        for ms, _, kind in ready:
            moved = [[] for _ in range(last)]
            for i in range(last):
                if kind in self.steps[i + 1]:
                    grown = [(*m, ms) for m in waits[i] if ms - m[0] < self.within_ms]
                    waits[i] = []
                    if i + 1 == last:
                        out += [(key[0], *m) for m in grown]
                    else:
                        moved[i + 1] = grown
                elif self.strict[i]:
                    waits[i] = []
            for i in range(1, last):
                waits[i] += moved[i]
            if kind in self.steps[0]:
                waits[0].append((ms,))
        left = [(i + 1, *m, *[0] * (last - len(m))) for i, wait in enumerate(waits) for m in wait
                if m[0] + self.within_ms > watermark]
        keep(self.partial, left, bool(partial))
        return out, None


class PatternMatch(EventTimeProcessor):
    """A pattern whose steps may repeat; see ``automaton.match_pattern``.

    State holds the matches that are open, which the time limit bounds.  Those that have found
    equally many rows wait for the same next one, so they are moved, broken or kept together.
    """

    def __init__(self, pattern: Pattern, key: str = "user_id long") -> None:
        self.rows, self.within_ms = pattern.rows, pattern.within_ms
        self._emits(key, ["status string", *pattern.columns[1:]])

    def open(self) -> None:
        times = ", ".join(f"t{i + 1} long" for i in range(len(self.rows)))
        self.partial = self.handle.getListState("partial", f"reached long, {times}")

    def _row(self, key: tuple, status: str, times: tuple) -> tuple:
        return (key[0], status, len(times), *times, *[None] * (len(self.rows) - len(times)))

    def on_ready(self, key, ready, watermark):
        n = len(self.rows)
        waits: list[list[tuple]] = [[] for _ in range(n)]  # by the number of rows found
        partial = listed(self.partial)
        for reached, *times in partial:
            waits[reached].append(tuple(times[:reached]))
        out: list[tuple] = []
        for ms, _, kind in ready:
            moved: list[tuple[int, list[tuple]]] = []
            for i in range(1, n):
                kinds, strict = self.rows[i]
                if not waits[i] or not (kind in kinds or strict):
                    continue
                out += [self._row(key, "timeout", m) for m in waits[i] if ms - m[0] >= self.within_ms]
                if kind in kinds:
                    moved.append((i + 1, [(*m, ms) for m in waits[i] if ms - m[0] < self.within_ms]))
                waits[i] = []
            if kind in self.rows[0][0]:
                moved.append((1, [(ms,)]))
            for reached, grown in moved:
                if reached == n:
                    out += [self._row(key, "matched", m) for m in grown]
                else:
                    waits[reached] += grown
        out += [self._row(key, "timeout", m) for wait in waits for m in wait if m[0] + self.within_ms <= watermark]
        left = [(i, *m, *[0] * (n - i)) for i, wait in enumerate(waits) for m in wait if m[0] + self.within_ms > watermark]
        keep(self.partial, left, bool(partial))
        return out, min((r[1] + self.within_ms for r in left), default=None)


class LivingCounts(EventTimeProcessor):
    """Counters of a key that live for a time after their last touch; see ``state_life``.

    ``roles`` says of each kind of row which counter it touches and whether it writes.  Each
    counter is an entry of map state with its last touch; the earliest end of a life is the
    one timer, and what has ended by then is removed, so state holds live counters only.
    """

    OUT = "seq long, user_id long, entry string, value long"

    def __init__(self, roles: dict[str, tuple[str, bool]], ttl_ms: int, refresh: str = "read_write") -> None:
        self.roles, self.ttl_ms, self.refresh = roles, ttl_ms, refresh

    def open(self) -> None:
        self.entries = self.handle.getMapState("entries", "entry string", "touched long, value long")

    def on_ready(self, key, ready, watermark):
        old = {k[0]: tuple(v) for k, v in self.entries.iterator()}
        live, out = dict(old), []
        for ms, seq, kind in ready:
            if kind not in self.roles:
                continue
            entry, writes = self.roles[kind]
            touched, value = live.get(entry, (None, 0))
            if touched is None or ms - touched >= self.ttl_ms:
                value = 0
                live.pop(entry, None)
            if writes:
                value += 1
            if writes or (value and self.refresh == "read_write"):
                live[entry] = (ms, value)
            out.append((seq, key[0], entry, value))
        live = {e: t for e, t in live.items() if t[0] + self.ttl_ms > watermark}
        for entry in old.keys() - live.keys():
            self.entries.removeKey((entry,))
        for entry, state in live.items():
            if old.get(entry) != state:
                self.entries.updateValue((entry,), state)
        return out, min((t + self.ttl_ms for t, _ in live.values()), default=None)


class FollowedBy(EventTimeProcessor):
    """Each ``first`` row waits for the next ``second`` row; its deadline is a timer."""

    OUT = "user_id long, first_ms long, second_ms long, status string"

    def __init__(self, first: str, second: str, within_ms: int) -> None:
        self.first, self.second, self.within_ms = first, second, within_ms

    def open(self) -> None:
        self.waiting = self.handle.getListState("waiting", "ts_ms long")

    def on_ready(self, key, ready, watermark):
        waiting = [t for t, in listed(self.waiting)]
        had, out = bool(waiting), []
        for ms, _, kind in ready:
            if kind == self.second:
                out += [(key[0], t, ms, "matched") if ms - t < self.within_ms else (key[0], t, None, "timeout")
                        for t in waiting]
                waiting = []
            elif kind == self.first:
                waiting.append(ms)
        out += [(key[0], t, None, "timeout") for t in waiting if t + self.within_ms <= watermark]
        waiting = [t for t in waiting if t + self.within_ms > watermark]
        keep(self.waiting, [(t,) for t in waiting], had)
        return out, (waiting[0] + self.within_ms if waiting else None)


class EventTimer(EventTimeProcessor):
    """Each row sets a timer ``after_ms`` past its time; equal timers of a key fire once.

    A timer is due when the watermark, taken back by ``after_ms``, has reached the row.
    """

    OUT = "user_id long, timer_ms long"

    def __init__(self, after_ms: int) -> None:
        self.after_ms = after_ms
        self.delay_ms = -after_ms

    def on_ready(self, key, ready, watermark):
        return [(key[0], ms + self.after_ms) for ms in sorted({r[0] for r in ready})], None


class PeriodicCount(EventTimeProcessor):
    """Cumulative row count of a key at first + k * period; the count is never reset."""

    OUT = "user_id long, tick_ms long, pv long"

    def __init__(self, period_ms: int) -> None:
        self.period_ms = period_ms

    def open(self) -> None:
        self.state = self.handle.getValueState("ticks", "next_tick long, seen long")

    def on_ready(self, key, ready, watermark):
        ticks = self.state.get()
        tick, seen = (ready[0][0] + self.period_ms, 0) if ticks is None else tuple(ticks)
        out, i = [], 0
        while tick <= watermark:
            while i < len(ready) and ready[i][0] <= tick:
                i += 1
            out.append((key[0], tick, seen + i))
            tick += self.period_ms
        self.state.update((tick, seen + len(ready)))
        return out, tick


class TumblingByHand(StatefulProcessor):
    """A tumbling window from map state (window start -> count) and timers at window end - 1.

    Only the earliest open window of a key has a timer; when it fires, every window that
    has ended by then is emitted and removed.
    """

    OUT = "url string, window_start long, window_end long, cnt long"

    def __init__(self, size_ms: int) -> None:
        self.size_ms = size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "window_start long", "cnt long")
        self.due = handle.getValueState("due", "ms long")

    def _arm(self, start: int) -> None:
        wanted = start + self.size_ms - 1
        if self.due.exists():
            now = self.due.get()[0]
            if now <= wanted:
                return
            self.handle.deleteTimer(now)
        self.handle.registerTimer(wanted)
        self.due.update((wanted,))

    def handleInputRows(self, key: tuple, rows: Rows, timerValues: Any) -> Rows:
        per_window = pd.concat([pdf["ts_ms"] // self.size_ms * self.size_ms for pdf in rows]).value_counts()
        open_counts = {k[0]: v[0] for k, v in self.counts.iterator()} if self.counts.exists() else {}
        for start, n in per_window.items():
            self.counts.updateValue((int(start),), (int(n) + open_counts.get(start, 0),))
        self._arm(int(per_window.index.min()))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Rows:
        watermark = timerValues.getCurrentWatermarkInMs()
        self.due.clear()
        counts = {k[0]: v[0] for k, v in self.counts.iterator()} if self.counts.exists() else {}
        closed = sorted(s for s in counts if s + self.size_ms - 1 <= watermark)
        for start in closed:
            self.counts.removeKey((start,))
        still_open = counts.keys() - set(closed)
        if still_open:
            self._arm(min(still_open))
        if closed:
            yield frame(["url", "window_start", "window_end", "cnt"],
                        [(key[0], s, s + self.size_ms, counts[s]) for s in closed])

    def close(self) -> None:
        pass


class ProcessingTimer(StatefulProcessor):
    """Reports each row on arrival and again ``after_ms`` of wall-clock time later."""

    OUT = "user_id long, what string, seq long"

    def __init__(self, after_ms: int) -> None:
        self.after_ms = after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "due long, seq long")

    def handleInputRows(self, key: tuple, rows: Rows, timerValues: Any) -> Rows:
        due = timerValues.getCurrentProcessingTimeInMs() + self.after_ms
        for pdf in rows:
            seqs = pdf["seq"].tolist()
            self.waiting.appendList([(due, s) for s in seqs])
            yield frame(["user_id", "what", "seq"], [(key[0], "arrived", s) for s in seqs])
        self.handle.registerTimer(due)

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Rows:
        due = expiredTimerInfo.getExpiryTimeInMs()
        waiting = list(map(tuple, self.waiting.get())) if self.waiting.exists() else []
        fired = [s for t, s in waiting if t <= due]
        rest = [r for r in waiting if r[0] > due]
        self.waiting.put(rest) if rest else self.waiting.clear()
        if fired:
            yield frame(["user_id", "what", "seq"], [(key[0], "timer", s) for s in fired])

    def close(self) -> None:
        pass
