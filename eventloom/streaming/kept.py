"""Steps over micro-batches that carry something small from one to the next.

Each works on what a keyed job emitted (:func:`eventloom.streaming.replay.replay` with ``step``),
in arrival order, by the batch operator, so that the result is that of the batch form for any
number of micro-batches.  What is carried is bounded by the operator, not by the stream: rules
that hold, one leader, a head of n keys, a few numbers for each input, open sessions, rows that
still wait for a partner.

A step reads what micro-batch ``n - 1`` left in the shared folder and writes its own ``n``, so
one that runs again after a failure gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators import joins, lateness, ranking, rules, windows
from eventloom.operators.lateness import InputsSoFar
from eventloom.operators.ordered import running
from eventloom.streaming.late import Step


def _written(rows: DataFrame, path: str) -> DataFrame:
    """The rows of a micro-batch, stored, so that the state behind them is used once."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _carried(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """What the micro-batch before this one left; nothing for the first."""
    return spark.read.schema(schema).parquet(f"{path}/{batch_id - 1}") if batch_id else spark.createDataFrame([], schema)


def leader(key: str) -> Step:
    """After each row (seq, key, cnt), the key with the highest count so far, as
    ``aggregates.running_leader``; carried is the leader."""
    schema = f"cnt long, seq long, {key} long"

    def step(batch: DataFrame, batch_id: int, folder: str) -> DataFrame:
        rows = _written(batch, f"{folder}/rows/{batch_id}")
        old = _carried(batch.sparkSession, f"{folder}/leader", batch_id, schema)
        own = F.struct("cnt", "seq", key)
        first = old.agg(F.max(own)).first()[0]
        known = F.lit(None).cast(f"struct<cnt:bigint,seq:bigint,{key}:bigint>")
        if first is not None:
            known = F.struct(F.lit(first["cnt"]).cast("bigint").alias("cnt"), F.lit(first["seq"]).cast("bigint").alias("seq"),
                             F.lit(first[key]).cast("bigint").alias(key))
        best = running(rows, [], ["seq"], {"_best": ("max", own)}).withColumn("_best", F.greatest("_best", known))
        (rows.select("cnt", "seq", key).unionByName(old).agg(F.max(own).alias("m")).where("m is not null").select("m.*")
         .write.mode("overwrite").parquet(f"{folder}/leader/{batch_id}"))
        return best.select("seq", F.col(f"_best.{key}").alias("leader"), F.col("_best.cnt").alias("leader_cnt"))
    return step


def head_changes(key: str, n: int) -> Step:
    """The changelog of a top-N of rising counts (seq, key, cnt); carried is the head."""
    schema = f"{key} long, cnt long"

    def step(batch: DataFrame, batch_id: int, folder: str) -> DataFrame:
        rows = _written(batch, f"{folder}/rows/{batch_id}")
        old = _carried(batch.sparkSession, f"{folder}/head", batch_id, schema)
        start = sorted(((r["cnt"], r[key]) for r in old.collect()), key=lambda h: (-h[0], h[1]))  # at most n rows
        counts = rows.where(F.col(key).isNotNull()).select(key, "cnt").unionByName(old)
        (ranking.own_heads(counts, [], key, n).select(key, "cnt")
         .write.mode("overwrite").parquet(f"{folder}/head/{batch_id}"))
        return ranking.top_n_changes(rows, key, n, start=start)
    return step


RULE = "seq long, slot long, action1 string, action2 string"


def arriving_rules(key: str) -> Step:
    """Pairs of actions with the rules that hold, as ``rules.match_arriving``.

    The micro-batch has pairs (seq, key, action1, action2) and rules, which have ``slot``;
    carried is the rule of each slot.
    """
    def step(batch: DataFrame, batch_id: int, folder: str) -> DataFrame:
        rows = _written(batch, f"{folder}/rows/{batch_id}")
        old = _carried(batch.sparkSession, f"{folder}/rules", batch_id, RULE)
        log = old.unionByName(rows.where("slot is not null").select("seq", "slot", "action1", "action2"))
        (log.groupBy("slot").agg(F.max_by(F.struct("seq", "action1", "action2"), "seq").alias("r"))
         .select("r.seq", "slot", "r.action1", "r.action2").write.mode("overwrite").parquet(f"{folder}/rules/{batch_id}"))
        pairs = rows.where("slot is null").drop("slot")
        bounds = tuple(pairs.agg(F.min("seq"), F.max("seq")).first())
        return rules.as_of(pairs, log, bounds).select("seq", key, "action1", "action2", "slot", "rule_seq")
    return step


def sessions(key: str, gap_ms: int) -> Step:
    """Sessions of a key when the watermark, the newest time so far, has passed their end.

    The rows of a micro-batch are made to partial sessions by the batch operator, which cuts
    a hot key into stretches, and joined with the open sessions that are carried, one row for
    each key that was seen within the gap.  Micro-batches follow the time of the rows.
    """
    schema = f"{key} long, window_start long, window_end long, cnt long"

    def step(batch: DataFrame, batch_id: int, folder: str) -> DataFrame:
        rows = _written(batch, f"{folder}/rows/{batch_id}")
        old = _carried(batch.sparkSession, f"{folder}/open", batch_id, schema)
        own = windows.sessions(rows, [key], gap_ms).select(key, "window_start", "window_end", "cnt")
        merged = _written(windows.merged_sessions(own.unionByName(old), [key]), f"{folder}/merged/{batch_id}")
        newest = rows.agg(F.max("ts_ms")).first()[0]
        closed = F.lit(False) if newest is None else F.col("window_end") < newest
        merged.where(~closed).select(*old.columns).write.mode("overwrite").parquet(f"{folder}/open/{batch_id}")
        return merged.where(closed)
    return step


def reconciled(key: str, app_wait_ms: int, third_wait_ms: int) -> Step:
    """Two payment logs matched as in ``joins.reconcile``; a row whose wait is over when the
    watermark, the newest time so far, has passed its end comes out alone.

    The micro-batch has rows (key, side, ms), where side is ``app`` or ``third``, and follows the
    time of the rows.  Carried are the rows of both waits together: those that may still meet
    a row, and those that such a row may have met before.
    """
    schema = f"{key} long, side string, ms long"

    def step(batch: DataFrame, batch_id: int, folder: str) -> DataFrame:
        spark = batch.sparkSession
        rows = _written(batch.select(key, "side", "ms"), f"{folder}/rows/{batch_id}")
        old = _carried(spark, f"{folder}/open", batch_id, schema)
        before = _carried(spark, f"{folder}/newest", batch_id, "newest long").agg(F.max("newest")).first()[0]
        newest = max((t for t in (before, rows.agg(F.max("ms")).first()[0]) if t is not None), default=None)
        spark.createDataFrame([(newest,)], "newest long").write.mode("overwrite").parquet(f"{folder}/newest/{batch_id}")
        known = rows.withColumn("_new", F.lit(True)).unionByName(old.withColumn("_new", F.lit(False)))
        until = F.lit(newest).cast("bigint")
        (known.where(F.col("ms") + app_wait_ms + third_wait_ms >= until).select(*old.columns)
         .write.mode("overwrite").parquet(f"{folder}/open/{batch_id}"))

        def log(side: str) -> DataFrame:
            return known.where(F.col("side") == side).select(key, F.col("ms").alias(f"{side}_ms"),
                                                             F.col("_new").alias(f"_{side}_new"))

        def over(side: str, wait_ms: int):
            end = F.col(f"{side}_ms") + wait_ms
            return (end < until) & (F.col(f"_{side}_new") | (end >= F.lit(before).cast("bigint")))

        met = F.col("_app_new") | F.col("_third_new")
        out = (F.when(F.col("status") == "matched", met).when(F.col("status") == "third_missing", over("app", app_wait_ms))
               .otherwise(over("third", third_wait_ms)))
        both = joins.reconcile(log("app"), log("third"), key, app_wait_ms, third_wait_ms, keep=["_app_new", "_third_new"])
        return both.where(out).drop("_app_new", "_third_new")
    return step


def lowest_watermark(inputs: int, bound_ms: int, idle_rows: int) -> Step:
    """The watermark of a union after each row, as ``lateness.union_watermark``; carried are the
    number of rows, two numbers for each input and the watermark."""
    fields = [f"{name}{i}" for name in ("newest", "last") for i in range(inputs)]
    schema = ", ".join(f"{c} long" for c in ["n", *fields, "watermark"])

    def step(batch: DataFrame, batch_id: int, folder: str) -> DataFrame:
        rows = _written(batch, f"{folder}/rows/{batch_id}")
        kept = _carried(batch.sparkSession, f"{folder}/inputs", batch_id, schema).first()
        before = InputsSoFar.none(inputs)
        if kept is not None:
            before = InputsSoFar(kept["n"], tuple(kept[f"newest{i}"] for i in range(inputs)),
                                 tuple(kept[f"last{i}"] for i in range(inputs)), kept["watermark"])
        marked = _written(lateness.union_watermark(rows, inputs, bound_ms, idle_rows, before), f"{folder}/marked/{batch_id}")
        own = marked.agg(F.count("*").alias("n"), F.max("watermark").alias("watermark"),
                         *[F.max(F.when(F.col("source") == i, F.col("ts_ms"))).alias(f"newest{i}") for i in range(inputs)],
                         *[F.max(F.when(F.col("source") == i, F.struct(*lateness.ARRIVAL))).alias(f"at{i}")
                           for i in range(inputs)]).first()
        # The place of an input's last row is the number of rows up to it.
        places = [(i, own[f"at{i}"]) for i in range(inputs) if own[f"at{i}"] is not None]
        upto = [(F.col("arrival") < at["arrival"]) | ((F.col("arrival") == at["arrival"]) & (F.col("seq") <= at["seq"]))
                for _, at in places]
        counts = marked.agg(F.lit(0), *map(F.count_if, upto)).first()[1:]
        last = list(before.last)
        for (i, _), n in zip(places, counts):
            last[i] = before.rows + n
        newest = [max((v for v in (own[f"newest{i}"], before.newest[i]) if v is not None), default=None)
                  for i in range(inputs)]
        mark = own["watermark"] if own["watermark"] is not None else before.watermark
        (batch.sparkSession.createDataFrame([(before.rows + own["n"], *newest, *last, mark)], schema)
         .write.mode("overwrite").parquet(f"{folder}/inputs/{batch_id}"))
        return marked
    return step
