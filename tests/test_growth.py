"""Streams whose work must grow no faster than their input: what is carried or kept is bounded."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventloom.operators import aggregates
from eventloom.operators.automaton import Pattern, Step
from eventloom.sources.tables import EVENTS_SCHEMA, as_clicks
from eventloom.streaming import jobs, kept, processors
from eventloom.streaming import replay as replays
from tests.fixtures import SHIFT, rows
from tests.test_sliding_outer import outer_pairs


def payments(seed, n=400):
    """Keys that repeat, also with equal times, and a key with a third of all rows."""
    rng = random.Random(seed)
    left = [(rng.choice([0, 0, 1, 2, 3, 4]), rng.randrange(0, 2000) * 100) for _ in range(n)]
    right = [(rng.choice([0, 0, 1, 2, 3, 5]), rng.randrange(0, 2000) * 100) for _ in range(n)]
    return left + left[:20], right + right[:20]


def log_of(spark, left, right):
    data = [(k, "app", t) for k, t in left] + [(k, "third", t) for k, t in right]
    return spark.createDataFrame(data, "order_id long, side string, ms long")


@pytest.mark.parametrize("ordered", [True, False])
@pytest.mark.parametrize("per_slice", [150, 1000])
def test_reconciled_in_slices(spark, monkeypatch, ordered, per_slice):
    """For any number of micro-batches the rows of the batch join, also where a store keeps no order of files."""
    if not ordered:
        monkeypatch.setattr(replays, "_in_order", lambda *_: False)
    left, right = payments(6)
    out = replays.replay_log(spark, log_of(spark, left, right), "ms", kept.reconciled("order_id", 500, 300),
                             closing={"order_id": -1, "side": "app"}, rows_per_slice=per_slice)
    assert out.select("batch_id").distinct().count() > (5 if per_slice == 150 else 0)
    got = sorted(map(tuple, out.select("order_id", "app_ms", "third_ms").collect()), key=str)
    assert got == outer_pairs(left, right, -300, 500)
    status = F.when(F.col("third_ms").isNull(), "third_missing").when(F.col("app_ms").isNull(), "app_missing").otherwise("matched")
    assert out.where(F.col("status") != status).count() == 0


def test_reconciled_carries_the_waits_only(spark):
    """What waits between two micro-batches is a stretch of both waits, not the log so far."""
    left, right = payments(7)
    carried, step = [], kept.reconciled("order_id", 500, 300)

    def watched(batch, batch_id, folder):
        out = step(batch, batch_id, folder)
        waiting = spark.read.parquet(f"{folder}/open/{batch_id}").agg(F.count("*"), F.max("ms") - F.min("ms")).first()
        carried.append(tuple(waiting))
        return out
    replays.replay_log(spark, log_of(spark, left, right), "ms", watched, closing={"order_id": -1, "side": "app"},
                       rows_per_slice=150)
    assert len(carried) > 5 and carried[-1][0] == 1  # the closing row
    assert all(0 < n < 30 and span <= 800 for n, span in carried[:-1])


def test_reconciled_nothing(spark):
    out = replays.replay_log(spark, log_of(spark, [(1, 100)], []), "ms", kept.reconciled("order_id", 500, 300),
                             closing={"order_id": -1, "side": "app"})
    assert [tuple(r) for r in out.drop("batch_id").collect()] == [(1, 100, None, "third_missing")]
    out = replays.replay_log(spark, log_of(spark, [(1, 100)], []).limit(0), "ms", kept.reconciled("order_id", 500, 300),
                             closing={"order_id": -1, "side": "app"})
    assert out.count() == 0


class Store:
    """The state of one key, in which every call that crosses to the state store is counted."""

    def __init__(self):
        self.calls, self.timers, self.entries = 0, set(), {}

    def getValueState(self, name, schema, **_):
        return Entry(self, name)

    getListState = getValueState

    def getMapState(self, name, key, value, **_):
        return Entry(self, name)

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.calls += 1
        self.timers.discard(ms)

    def getCurrentWatermarkInMs(self):
        return self.watermark


class Entry:
    def __init__(self, store, name):
        self.store, self.name = store, name

    def _at(self, new=None):
        self.store.calls += 1
        if new is not None:
            self.store.entries[self.name] = new
        return self.store.entries.get(self.name)

    def exists(self):
        return self._at() is not None

    def get(self):
        held = self._at()
        return iter(held or []) if isinstance(held, list) or held is None and self.name in ("held", "partial") else held

    def update(self, value):
        self._at(value)

    put = update

    def appendValue(self, value):
        self._at([*self.store.entries.get(self.name, []), value])

    def appendList(self, values):
        self._at([*self.store.entries.get(self.name, []), *values])

    def clear(self):
        self._at()
        self.store.entries.pop(self.name, None)

    def iterator(self):
        return iter([((k,), v) for k, v in (self._at() or {}).items()])

    def updateValue(self, key, value):
        self._at({**self.store.entries.get(self.name, {}), key[0]: value})

    def removeKey(self, key):
        self._at({k: v for k, v in self.store.entries[self.name].items() if k != key[0]})


def fired(processor, data, watermark):
    """What a key's rows give when they came in one micro-batch, the state calls of both firings, its state."""
    store = Store()
    processor.init(store)
    frames = [pd.DataFrame(data[i:i + 1000], columns=["ts_ms", "seq", "url"]) for i in range(0, len(data), 1000)]
    list(processor.handleInputRows((1,), iter(frames), store))
    came, store.calls, store.watermark = store.calls, 0, watermark
    held = store.entries["held"]
    store.timers.clear()
    out = [tuple(r) for pdf in processor.handleExpiredTimer((1,), store, None) for r in pdf.itertuples(index=False)]
    return out, came, store.calls, held, store


REPEAT = Pattern((Step(("error",), times=2, consecutive=True), Step(("view",))), 50)


@pytest.mark.parametrize("processor", [processors.PatternMatch(REPEAT), processors.LivingCounts({"click": ("c", True)}, 50)])
def test_state_calls_do_not_grow_with_the_rows(processor):
    """2000 rows of a key are two entries of its state, not 2000, and each call is made once."""
    data = [(i, i, "click") for i in range(2000)]
    random.Random(1).shuffle(data)
    out, came, went, held, store = fired(processor, data, 1499)
    assert len(held) == 2 and came <= 5 and went <= 7
    rest = [row for entry in store.entries["held"] for row in zip(*entry)]
    assert rest == [(i, i, "click") for i in range(1500, 2000)] and 1500 in {min(store.timers), 1500}
    assert out == ([] if isinstance(processor, processors.PatternMatch) else [(i, 1, "c", i + 1) for i in range(1500)])


def test_large_times_beside_nulls():
    """A null among the times of a pattern must not turn the others into doubles."""
    first = 2**60 + 1
    data = [(first, 0, "error"), (first + 1, 1, "error"), (first + 2, 2, "view"), (first + 4, 3, "error")]
    out, *_ = fired(processors.PatternMatch(REPEAT), data, first + 100)
    assert out == [(1, "matched", 3, first, first + 1, first + 2), (1, "timeout", 1, first + 4, None, None)]


def test_changelog_asks_its_state_once():
    store, processor = Store(), processors.CountChangelog()
    processor.init(store)
    for seqs in ([3, 1, 2], [4]):
        store.calls = 0
        pdf, = processor.handleInputRows((7,), iter([pd.DataFrame({"seq": seqs, "user_id": 7})]), None)
        assert store.calls == 2
        got = sorted(pdf.itertuples(index=False, name=None))
        assert got == ([(1, 7, "+I", 1), (2, 7, "+U", 2), (2, 7, "-U", 1), (3, 7, "+U", 3), (3, 7, "-U", 2)] if len(seqs) > 1
                       else [(4, 7, "+U", 4), (4, 7, "-U", 3)])


def test_slices_of_a_restarted_stream_are_written_by_all_cores(spark, tmp_path, monkeypatch):
    """A slice is several files, so that no task writes all of its rows."""
    ts = F.timestamp_millis(F.lit(SHIFT) + F.col("id")).cast("timestamp_ntz").alias("ts")
    events = spark.range(300).select(F.col("id").alias("event_id"), ts, (F.col("id") % 5).alias("user_id"),
                                     F.lit("click").alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props"))
    events.write.parquet(str(tmp_path / "events"))
    found, stream = [], replays.click_stream

    def watched(session, path, files=None):
        found.append(len(spark.read.parquet(path).inputFiles()))
        return stream(session, path, files)
    monkeypatch.setattr(replays, "click_stream", watched)
    out = replays.replay(spark, lambda s: jobs.stateful(s.select("seq", "user_id"), "user_id", processors.CountChangelog()),
                         str(tmp_path / "events"), order="event_id", rows_per_slice=100, restarts=True)
    want = aggregates.count_changelog(as_clicks(spark.read.schema(EVENTS_SCHEMA).parquet(str(tmp_path / "events"))), "user_id")
    assert rows(out, "seq", "op", "cnt") == rows(want, "seq", "op", "cnt")
    assert len(found) == 3 and found[0] > 1
