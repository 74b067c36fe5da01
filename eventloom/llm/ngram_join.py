"""N-gram Jaccard join by MinHash banding.

A document is the set of its n-grams of words (runs of characters other than ASCII white
space); one with fewer words is the single gram of all of them.  The number of bands follows
from the rows of a band and the target recall at the threshold.  Documents with the same set
form a class, classes that agree in a band are candidates, and candidates are verified on
their full sets.

Cases: a null or empty text has no grams and is linked with nothing; a null key is linked
with nothing and kept; rows that repeat a key are one document and share its component;
an empty table gives no rows.  Other columns stay out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import links
from eventloom.llm.common import free_names, stored
from eventloom.llm.mph import mixed

WORDS_CACHED = 250_000
LONGEST_CACHED = 64  # bytes; longer words are hashed each time, so the cache is bounded in bytes
_word_hash: dict[bytes, int] = {}


def forget_words() -> None:
    """Free the cache at the end of a task; the worker may go on to other work."""
    _word_hash.clear()


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """Bands that find a pair of the threshold's similarity with this probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


def grams(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.uint64)
    known = list(map(_word_hash.get, words))
    if None in known:
        if len(_word_hash) > WORDS_CACHED:
            _word_hash.clear()
        for i, w in enumerate(words):
            if known[i] is None:
                known[i] = xxhash.xxh3_64_intdigest(w)
                if len(w) <= LONGEST_CACHED:
                    _word_hash[w] = known[i]
    h = np.array(known, np.uint64)
    width = min(n, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        out = mixed(out + h[i:len(h) - width + 1 + i], i)
    return np.unique(out)


def signature(hashes: np.ndarray, scale: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Minima of the hashes under each of the linear permutations."""
    out = np.full(len(scale), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 256):
        out = np.minimum(out, (hashes[at:at + 256, None] * scale + shift).min(0))
    return out


def _permutations(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    top = np.iinfo(np.uint64).max
    return (rng.integers(0, top, count, np.uint64) | np.uint64(1)), rng.integers(0, top, count, np.uint64)


def sketches(docs: DataFrame, key: str, text: str, n: int, bands: int, rows: int, seed: int) -> DataFrame:
    """(doc_id, digest of the set, its bytes, keys: one for each band); all null without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale, shift = _permutations(bands * rows, seed)
        for batch in batches:
            digests, sizes, keys = [], [], []
            for t in batch.column(1).to_pylist():
                g = grams(t, n)
                if not len(g):
                    digests.append(None)
                    sizes.append(None)
                    keys.append(None)
                    continue
                digests.append(hashlib.md5(g.tobytes()).digest())
                sizes.append(g.nbytes)
                low = signature(g, scale, shift).reshape(bands, rows)
                band = np.arange(bands, dtype=np.uint64)
                for i in range(rows):
                    band = mixed(band + low[:, i], i + 50)
                keys.append(band.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "digest", "bytes", "keys"])
        forget_words()

    return docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id bigint, digest binary, bytes bigint, keys array<bigint>")


def similar(threshold: float):
    """Pairs of gram sets, as bytes, whose Jaccard similarity reaches the threshold."""
    ratio = Fraction(threshold).limit_denominator(10_000)

    def linked(data: list[bytes]) -> np.ndarray:
        sets = [np.frombuffer(d, np.uint64) for d in data]
        size = np.array([len(s) for s in sets], np.int64)
        if len(sets) == 2:
            both = np.zeros((2, 2), np.int64)
            both[0, 1] = both[1, 0] = len(np.intersect1d(*sets, assume_unique=True))
        else:
            _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            row = np.repeat(np.arange(len(sets)), size)
            shared = times[column] > 1
            order = np.argsort(column[shared], kind="stable")
            row, column = row[shared][order], column[shared][order]
            if len(column):
                column = np.concatenate([[0], np.cumsum(column[1:] != column[:-1])])
            both = np.zeros((len(sets), len(sets)), np.float32)  # exact below 2**24
            for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
                lo, hi = np.searchsorted(column, [at, at + 4096])
                has = np.zeros((len(sets), 4096), np.float32)
                has[row[lo:hi], column[lo:hi] - at] = 1
                both += has @ has.T
            both = both.astype(np.int64)
        union = size[:, None] + size[None, :] - both
        return both * ratio.denominator >= union * ratio.numerator

    return linked


def _sets(docs: DataFrame, key: str, text: str, n: int):
    def payload(nodes: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data = [grams(t, n).tobytes() for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["node", "data"])
            forget_words()

        own = docs.select(F.col(key).cast("bigint").alias("node"), F.col(text).alias("text"))
        return own.join(links.small(nodes), "node").select("node", "text").mapInArrow(run, "node bigint, data binary")
    return payload


def join(docs: DataFrame, *, key: str = "doc_id", text: str = "text", n: int = 5, threshold: float = 0.8,
         recall: float = 0.9999, rows: int = 5, seed: int = 3) -> DataFrame:
    """(doc_id, class_id, class_size, n_links, component_id, kept) of every document.

    ``class_id`` is the smallest key with the same set, ``n_links`` counts the other
    documents of at least this similarity, copies included, and ``component_id`` is the
    smallest key that links lead to; ``kept`` marks one document of each component.
    """
    bands = bands_for(threshold, recall, rows)
    made = stored(sketches(docs, key, text, n, bands, rows, seed), "ngram-sketches")
    classes = stored(made.where("digest is not null and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.count("*").alias("size"), F.first("bytes").alias("bytes"),
        F.first("keys").alias("keys")), "ngram-classes")
    found = links.find(classes, _sets(docs, key, text, n), similar(threshold), "ngram").select(
        "digest", "node", "size", "links", "component")
    return (made.select("doc_id", "digest").join(found, "digest", "left")
            .select("doc_id", F.coalesce("node", "doc_id").alias("class_id"),
                    F.coalesce("size", F.lit(1)).alias("class_size"),
                    F.when(F.col("doc_id").isNull(), 0).otherwise(F.coalesce(F.col("size") - 1 + F.col("links"), F.lit(0)))
                    .cast("bigint").alias("n_links"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))))


def deduplicated(docs: DataFrame, *, key: str = "doc_id", **options) -> DataFrame:
    """Documents with one of each component left; columns as they were."""
    name, = free_names(docs, "dropped_key")
    dropped = stored(join(docs, key=key, **options).where("not kept").select(F.col("doc_id").alias(name)).distinct(),
                     "ngram-dropped")
    return docs.join(links.small(dropped), F.col(key).cast("bigint") == F.col(name), "left_anti")
