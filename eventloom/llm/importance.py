"""Importance resampling towards a target: documents that look like the target are drawn.

Features are the runs of 1 to ``most_words`` words of a text, hashed into buckets by CRC-32.
A task finds the distinct features of a batch with Arrow kernels, groups them by their
length in bytes into matrices, and updates the checksums of all rows of a matrix column by
column; the buckets are scattered back to the places of the features.  One pass keeps the
buckets of each document and the totals of each task; a document's weight is the mean
log-ratio of target and corpus over its features, and a score adds Gumbel noise from a hash
of its key, so that the highest scores are a sample without replacement.

The drawn rows are ranked without a global sort: the histogram of scores, whose size the
noise and the counts bound, says where each score starts, and rows of a score are ranked in
stretches of the key.

Cases: null and empty texts have no features and weight 0; documents below ``least_words``
words are never drawn; rows with the same key have the same noise and are drawn each, ties
going to smaller keys, then a null one; an empty table gives no rows, an empty target makes
rare features heavy.  Other columns stay out of ``scored`` and pass through ``resampled``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import free_names, ranked, stored
from eventloom.llm.tokens import slices

# Features above this length are so rare that a matrix would have one row; they go one by one.
LONGEST_COLUMN = 512
ROWS_PER_STRETCH = 1_000_000
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table.astype(np.uint32)


_TABLE = _crc_table()


def crc32s(values: pa.Array) -> np.ndarray:
    """CRC-32 of each string, by one matrix for each length."""
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + len(values) + 1].astype(np.int64)
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    start, size = offsets[:-1], np.diff(offsets)
    out = np.zeros(len(values), np.uint32)
    order = np.argsort(size, kind="stable")
    lengths, first = np.unique(size[order], return_index=True)
    for length, rows in zip(lengths.tolist(), np.split(order, first[1:])):
        if length > LONGEST_COLUMN:
            for i in rows.tolist():
                out[i] = zlib.crc32(data[start[i]:start[i] + length])
            continue
        matrix = data[start[rows][:, None] + np.arange(length)]
        crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for column in matrix.T:
            crc = _TABLE[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
        out[rows] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in a row, and how many each text has."""
    lowered = pc.ascii_lower(pc.fill_null(texts, ""))
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(lowered)], lowered), "\n")[0]
    buffer = np.frombuffer(joined.as_buffer(), np.uint8) if len(lowered) else np.empty(0, np.uint8)
    inside = _WORD_BYTE[buffer]
    edges = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    offsets = np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(buffer[inside].tobytes()))
    sizes = pc.binary_length(lowered).to_numpy(zero_copy_only=False).astype(np.int64)
    stops = np.cumsum(sizes + 1)
    counts = np.diff(np.concatenate([[0], np.searchsorted(begins, stops)]))
    return words, counts


def _features(texts: pa.Array, most_words: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, text by text, with the numbers of features and words."""
    words, n_words = words_of(texts)
    coded = words.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    distinct = coded.dictionary
    owner = np.repeat(np.arange(len(n_words)), n_words)
    parts, owners = [], []
    run, places = index, np.arange(len(index))
    for n in range(1, most_words + 1):
        if n > 1:  # runs of n words: those of n - 1 and the next word of the same text
            going_on = places + n - 1 < len(index)
            going_on[going_on] = owner[places[going_on]] == owner[places[going_on] + n - 1]
            places, run = places[going_on], run[going_on]
            longer = pc.binary_join_element_wise(distinct.take(pa.array(run)),
                                                 coded.dictionary.take(pa.array(index[places + n - 1])), " ")
            recoded = longer.dictionary_encode()
            distinct, run = recoded.dictionary, recoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        parts.append((crc32s(distinct) % np.uint32(buckets)).astype(np.int64)[run])
        owners.append(owner[places])
    own, whose = np.concatenate(parts), np.concatenate(owners)
    order = np.argsort(whose, kind="stable")
    return own[order], np.bincount(whose, minlength=len(n_words)), n_words


_MADE = "key bigint, n_words bigint, n_features bigint, features binary, bucket int, n bigint"


def _counted(docs: DataFrame, key: str | None, text: str, most_words: int, buckets: int) -> DataFrame:
    """A row for each document with its buckets, and of each task a row for each bucket with
    its number of features (``bucket`` not null); without ``key`` only the latter."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            at = 0
            for part in slices(batch.column(1)):
                own, n_features, n_words = _features(part, most_words, buckets)
                totals += np.bincount(own, minlength=buckets)
                keys, at = batch.column(0).slice(at, len(part)), at + len(part)
                if key is None:
                    continue
                width = np.dtype(kind).itemsize
                offsets = np.concatenate([[0], np.cumsum(n_features) * width]).astype(np.int32)
                raw = pa.BinaryArray.from_buffers(pa.binary(), len(part), [
                    None, pa.py_buffer(offsets), pa.py_buffer(own.astype(kind).tobytes())])
                none = pa.nulls(len(part))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()), raw,
                     none.cast(pa.int32()), none.cast(pa.int64())],
                    ["key", "n_words", "n_features", "features", "bucket", "n"])
        used = np.flatnonzero(totals)
        none = pa.nulls(len(used))
        yield pa.RecordBatch.from_arrays(
            [none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary()),
             pa.array(used, pa.int32()), pa.array(totals[used], pa.int64())],
            ["key", "n_words", "n_features", "features", "bucket", "n"])

    own = F.col(key).cast("bigint") if key else F.lit(None).cast("bigint")
    return docs.select(own.alias("key"), F.col(text).alias("text")).mapInArrow(run, _MADE)


def _totals(made: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket; at most ``buckets`` rows come to the driver."""
    out = np.zeros(buckets, np.int64)
    for bucket, n in made.where("bucket is not null").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains_of(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths, from its features in target and corpus."""
    t, s = target.astype(np.float64), corpus.astype(np.float64)
    ratio = (t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from a hash of the key."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share))).cast("bigint")


def scored(docs: DataFrame, target: DataFrame, *, key: str = "doc_id", text: str = "text", target_text: str = "text",
           most_words: int = 1, buckets: int = 10_000, seed: int = 2024) -> DataFrame:
    """(key, n_words, n_features, weight, score) of every document, stored."""
    made = stored(_counted(docs, key, text, most_words, buckets), "importance-features")
    aim = _counted(target, None, target_text, most_words, buckets)
    gains = gains_of(_totals(aim, buckets), _totals(made, buckets))
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def weigh(features: pa.Array) -> pa.Array:
        sizes = pc.binary_length(features).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(kind).itemsize
        own = gains[np.frombuffer(pc.binary_join(pa.ListArray.from_arrays([0, len(features)], features), b"")[0].as_py()
                                  if len(features) else b"", kind)]
        sums = np.concatenate([[0], np.cumsum(own)])
        ends = np.cumsum(sizes)
        return pa.array((sums[ends] - sums[ends - sizes]) // np.maximum(sizes, 1), pa.int64())

    weighed = made.where("bucket is null").select(
        "key", "n_words", "n_features", F.arrow_udf(weigh, "bigint")("features").alias("weight"))
    return stored(weighed.withColumn("score", F.col("weight") + noise(F.col("key"), seed)), "importance-scores")


def draw(rows: DataFrame, *, percent: int = 10, least_words: int = 20) -> DataFrame:
    """Add ``rank`` (1, 2, ...; null if not drawn) to the rows of ``scored``: of those with
    ``least_words`` words, ``percent`` in a hundred with the highest scores."""
    fit = F.col("n_words") >= least_words
    # A score is a mean of logarithms plus noise in thousandths: some 100,000 values at most.
    histogram = rows.where(fit).groupBy("score").agg(F.count("*").alias("n")).orderBy(F.col("score").desc()).collect()
    most = sum(r["n"] for r in histogram) * percent // 100
    starts, before = [], 0
    for r in histogram:
        if before >= most:
            break
        starts.append((r["score"], before))
        before += r["n"]
    none = F.lit(None).cast("bigint")
    if not starts:
        return rows.withColumn("rank", none)
    least = starts[-1][0]
    near = fit & (F.col("score") >= least)
    lo, hi, n = rows.where(near).agg(F.min("key"), F.max("key"), F.count("*")).first()
    width = max(1, ((hi or 0) - (lo or 0)) // max(1, -(-n // ROWS_PER_STRETCH)) + 1)
    # A null key comes after the others.
    stretch = F.coalesce(F.expr(f"(key - {lo or 0}) div {width}"), F.lit(n + 1).cast("bigint"))
    first = rows.sparkSession.createDataFrame(starts, "score bigint, first bigint")
    order = [F.col("key").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    in_score = ranked(rows.where(near).withColumn("stretch", stretch), "score", order, "stretch", "place")
    place = F.col("first") + F.col("place") + 1
    drawn = (in_score.join(F.broadcast(first), "score")
             .withColumn("rank", F.when(place <= most, place)).select(*rows.columns, "rank"))
    rest = rows.where(~F.coalesce(near, F.lit(False))).withColumn("rank", none)
    return drawn.unionByName(rest)


def resampled(docs: DataFrame, target: DataFrame, *, key: str = "doc_id", percent: int = 10, least_words: int = 20,
              **options) -> DataFrame:
    """The documents that are drawn, with all their columns; keys must be unique, and rows
    without a key are left out."""
    name, = free_names(docs, "drawn_key")
    drawn = draw(scored(docs, target, key=key, **options), percent=percent, least_words=least_words)
    return docs.join(drawn.where("rank is not null").select(F.col("key").alias(name)),
                     F.col(key).cast("bigint") == F.col(name), "left_semi")
