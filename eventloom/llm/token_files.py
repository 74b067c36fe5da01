"""Token ids in raw shard files, with a minimal perfect hash index.

``write`` lays ids out in shards in ascending key order: documents are range-partitioned by
key, encoded in the task that writes their shard, and written by Spark's text writer, whose
commit keeps only one attempt of each task and which reaches any store that Spark does.
A record is raw bytes; the writer ends each with one byte, so the payload of a shard lies in
blocks of ``BLOCK`` bytes with one byte between them, and the place of an id in the file
follows from its place in the payload.  Then come the shard's entries: one (key, hash of
text, tokens) each.

``entries`` reads the shard files back; ``build_index`` maps (key, copy) to shard, start and
length; ``look_up`` answers keys in constant time each, and tells unknown ones by their
fingerprint (wrong for one unknown key in 4 billion); ``fetch`` cuts the ids of the answers
from the files.

Cases: a null text is empty and has the end id only; a null key comes first; rows with the
same key are its copies 0, 1, ... in file order, and equal rows are stored each; an empty
table gives no shards.  Other columns stay out.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.llm.common import shuffle_partitions, stored
from eventloom.llm.mph import PerfectHash, fingerprints, mixed
from eventloom.llm.tokens import encoder, slices
from eventloom.session import work_dir

BLOCK = 1 << 20
SHARD_TEXT_BYTES = 64 << 20
NULL_KEY = -(1 << 63)
KEYS_PER_BUCKET = 50_000
FOOT = "<QQB7s"  # payload bytes, documents, bytes of an id, magic
_MAGIC = b"TOKENS1"


def write(docs: DataFrame, tokenizer: str, *, end_id: int, key: str = "doc_id", text: str = "text",
          width: int = 2, shards: int | None = None, label: str = "token-files") -> str:
    """Write all documents; returns the folder of the shards.

    ``width`` is the bytes of an id: 2 for vocabularies up to 65,536 ids, else 4.  Unless
    ``shards`` says how many, a shard gets at most about ``SHARD_TEXT_BYTES`` of text, or
    less where there are more shuffle partitions.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, label)
    tail = int(end_id).to_bytes(width, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, True, width)
        held, payload = bytearray(), 0
        entries: list[bytes] = []
        for batch in batches:
            keys = [NULL_KEY if k is None else k for k in batch.column(0).to_pylist()]
            at = 0
            for part in slices(batch.column(1)):
                for ids in enc.encode(part):
                    held += ids
                    held += tail
                    payload += len(ids) + width
                    entries.append(struct.pack("<qQ", keys[at], len(ids) // width + 1))
                    at += 1
                full = len(held) // BLOCK * BLOCK
                if full:
                    yield _records([bytes(held[i:i + BLOCK]) for i in range(0, full, BLOCK)])
                    del held[:full]
        if entries:
            last = bytes(held) + b"".join(entries) + struct.pack(FOOT, payload, len(entries), width, _MAGIC)
            yield _records([last])

    # Equal rows are told apart by their place in the input, so that copies fill several shards.
    rows = docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t"), F.xxhash64(text).alias("h"),
                       F.monotonically_increasing_id().alias("i"))
    if shards is None:
        size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
        shards = max(shuffle_partitions(spark), -(-size // SHARD_TEXT_BYTES))
    order = [F.col("k").asc_nulls_first(), F.col("h"), F.col("i")]
    laid = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    laid.select("k", "t").mapInArrow(encode, "value binary").select(
        F.col("value").cast("string")).write.option("compression", "none").text(folder)
    return folder


def _records(rows: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])


class Shard:
    """The content of one shard file."""

    def __init__(self, raw: bytes):
        body = raw[:-1]
        size, n, self.width, magic = struct.unpack_from(FOOT, body, len(body) - struct.calcsize(FOOT))
        if magic != _MAGIC:
            raise ValueError("not a shard file")
        blocks = size // BLOCK
        # Blocks are one byte apart; the last one and the entries follow without a gap.
        self.payload = b"".join(body[i * (BLOCK + 1):i * (BLOCK + 1) + BLOCK] for i in range(blocks))
        rest = blocks * (BLOCK + 1)
        self.payload += body[rest:rest + size - blocks * BLOCK]
        table = np.frombuffer(body, [("key", "<i8"), ("n", "<u8")], n, rest + size - blocks * BLOCK)
        self.keys, self.lengths = table["key"], table["n"].astype(np.int64)

    @staticmethod
    def width_of(raw: bytes) -> int:
        return struct.unpack_from(FOOT, raw, len(raw) - 1 - struct.calcsize(FOOT))[2]

    def ids(self, start: int, n: int) -> np.ndarray:
        return np.frombuffer(self.payload, f"<u{self.width}", n, start * self.width)


def file_place(start: int, width: int) -> int:
    """Byte of a shard file at which the id number ``start`` of the shard lies."""
    at = start * width
    return at + at // BLOCK


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, content) of the shard files; a file is as large as its shard, see ``write``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    number = F.regexp_extract("path", r"/part-([0-9]+)", 1).cast("bigint")
    return files.where("length > 0").select(number.alias("shard"), "content")


def entries(spark: SparkSession, folder: str) -> DataFrame:
    """(key, copy, shard, shard_start, start, n_tokens, ids_crc32) of all documents, read from
    the files: ``start`` counts the ids of all documents before, ``shard_start`` those in the
    shard; the checksum is over the ids as 32-bit integers."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = Shard(raw.as_py())
                starts = np.cumsum(shard.lengths) - shard.lengths
                sums = [zlib.crc32(shard.ids(s, n).astype("<u4").tobytes())
                        for s, n in zip(starts.tolist(), shard.lengths.tolist())]
                size = len(starts)
                opens = np.flatnonzero(np.concatenate([[True], shard.keys[1:] != shard.keys[:-1]]))
                copy = np.arange(size) - np.repeat(opens, np.diff(np.append(opens, size)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.keys, pa.int64()), pa.array(np.full(size, number), pa.int64()),
                     pa.array(np.arange(size), pa.int64()), pa.array(copy, pa.int64()), pa.array(starts, pa.int64()),
                     pa.array(shard.lengths, pa.int64()), pa.array(sums, pa.int64())],
                    ["key", "shard", "place", "own_copy", "shard_start", "n_tokens", "ids_crc32"])

    found = stored(_files(spark, folder).mapInArrow(
        read, "key bigint, shard bigint, place bigint, own_copy bigint, shard_start bigint, n_tokens bigint, "
              "ids_crc32 bigint"), "token-entries")
    # One row for each shard from here to the end: where it starts, and how many copies of its
    # first key lie in earlier shards.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = stored(found.groupBy("shard").agg(
        F.sum("n_tokens").alias("tokens"), F.min_by("key", "place").alias("first_key")).select(
        "shard", "first_key", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("shard_first")), "token-shards")
    edges = shards.select(F.col("first_key").alias("key")).distinct()
    of_key = Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (found.join(F.broadcast(edges), "key").groupBy("key", "shard").count()
               .select("shard", F.col("key").alias("first_key"),
                       F.coalesce(F.sum("count").over(of_key), F.lit(0)).alias("earlier")))
    placed = shards.join(earlier, ["shard", "first_key"])
    own_first = F.col("key") == F.col("first_key")
    return (found.join(F.broadcast(placed), "shard").withColumn("start", F.col("shard_first") + F.col("shard_start"))
            .withColumn("copy", F.col("own_copy") + F.when(own_first, F.col("earlier")).otherwise(0))
            .select("key", "copy", "shard", "shard_start", "start", "n_tokens", "ids_crc32"))


_INDEXED = ("shard", "shard_start", "start", "n_tokens")


def _key64(keys: pa.Array, copies: pa.Array) -> np.ndarray:
    k = keys.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return mixed(k, 2_000) + mixed(copies.to_numpy(zero_copy_only=False).astype(np.uint64), 3_000)


def _bucketed(keys: DataFrame, buckets: int) -> DataFrame:
    return keys.withColumn("bucket", F.pmod(F.xxhash64("key", "copy"), F.lit(buckets)))


def build_index(found: DataFrame, keys_per_bucket: int = KEYS_PER_BUCKET) -> tuple[DataFrame, int]:
    """The index of ``entries`` as stored rows (bucket, hash, slots), and the number of buckets.

    Keys are dealt to buckets by a hash, so that a task holds about ``keys_per_bucket`` keys.
    """
    buckets = max(1, -(-found.count() // keys_per_bucket))

    def build(group: pa.Table) -> pa.Table:
        keys = _key64(group["key"].combine_chunks(), group["copy"].combine_chunks())
        mph = PerfectHash.build(keys)
        slot = mph.slots(keys)
        values = np.empty((len(keys), 1 + len(_INDEXED)), "<i8")
        values[slot, 0] = fingerprints(keys)
        for i, name in enumerate(_INDEXED):
            values[slot, i + 1] = group[name].to_numpy()
        return pa.table({"bucket": pa.array([group["bucket"][0].as_py()], pa.int64()),
                         "hash": pa.array([mph.to_bytes()], pa.binary()),
                         "slots": pa.array([values.tobytes()], pa.binary())})

    rows = _bucketed(found.select("key", "copy", *_INDEXED), buckets)
    return stored(rows.groupBy("bucket").applyInArrow(build, "bucket bigint, hash binary, slots binary"),
                  "token-index"), buckets


def look_up(keys: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """(key, copy, shard, shard_start, start, n_tokens) of those keys that the index has."""
    def find(asked: pa.Table, own: pa.Table) -> pa.Table:
        out = {"key": asked["key"], "copy": asked["copy"]}
        if not own.num_rows or not asked.num_rows:
            out = {c: pa.array([], pa.int64()) for c in ("key", "copy", *_INDEXED)}
            return pa.table(out)
        mph = PerfectHash.from_bytes(own["hash"][0].as_py())
        values = np.frombuffer(own["slots"][0].as_py(), "<i8").reshape(-1, 1 + len(_INDEXED))
        hashed = _key64(asked["key"].combine_chunks(), asked["copy"].combine_chunks())
        slot = mph.slots(hashed)
        known = (slot >= 0) & (values[slot, 0] == fingerprints(hashed))
        for i, name in enumerate(_INDEXED):
            out[name] = pa.array(values[slot, i + 1])
        return pa.table(out).filter(pa.array(known))

    return (_bucketed(keys.select("key", "copy"), buckets).groupBy("bucket")
            .cogroup(index.groupBy("bucket"))
            .applyInArrow(find, "key bigint, copy bigint, shard bigint, shard_start bigint, start bigint, n_tokens bigint"))


def fetch(spark: SparkSession, folder: str, places: DataFrame) -> DataFrame:
    """(key, copy, ids) of the rows of ``look_up``: each shard that is asked for is read once,
    and the ids are cut from its bytes at the places of the index."""
    def cut(asked: pa.Table, file: pa.Table) -> pa.Table:
        out = []
        if file.num_rows:
            raw = file["content"][0].as_py()
            width = Shard.width_of(raw)
            for start, n in zip(asked["shard_start"].to_pylist(), asked["n_tokens"].to_pylist()):
                own = raw[file_place(start, width):file_place(start + n - 1, width) + width]
                gaps = range(BLOCK - start * width % BLOCK, len(own), BLOCK + 1)
                own = b"".join(own[a:b] for a, b in zip([0, *[g + 1 for g in gaps]], [*gaps, len(own)]))
                out.append(np.frombuffer(own, f"<u{width}").astype(np.int32))
        else:
            asked = asked.slice(0, 0)
        return pa.table({"key": asked["key"], "copy": asked["copy"], "ids": pa.array(out, pa.list_(pa.int32()))})

    asked = places.select("key", "copy", "shard", "shard_start", "n_tokens")
    return asked.groupBy("shard").cogroup(_files(spark, folder).groupBy("shard")).applyInArrow(
        cut, "key bigint, copy bigint, ids array<int>")
