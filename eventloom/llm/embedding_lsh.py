"""Near-duplicate vectors by p-stable hashing of Euclidean distance.

Normalised vectors are projected on Gaussian directions; a projection is shifted at random
and cut into steps of ``width``.  The steps of ``depth`` projections are the bucket of a
table.  On the unit sphere a cosine is a distance, so the chance that a pair shares a step is
known; the depth grows with the logarithm of the number of vectors, so that unrelated
vectors seldom meet, and the number of tables follows from the target recall.  Vectors that
meet are compared by their exact cosine in double precision.

Cases: a vector that is null, zero, or has null or non-finite components is linked with
nothing and kept, and so is one whose key is null; vectors of other lengths are never linked;
equal vectors form a class whose members are linked without comparison; rows that repeat a
key are one vector and share its component; an empty table gives no rows.  Other columns
stay out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import links
from eventloom.llm.common import stored
from eventloom.llm.mph import mixed


def step_chance(distance: float, width: float) -> float:
    """Probability that two points of this distance fall into the same step."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def tables_for(count: int, cosine: float, recall: float, width: float) -> tuple[int, int]:
    """(depth, tables) for so many vectors: unrelated ones meet in a table with a chance of
    about 1 / (8 count); pairs at the threshold meet in one of the tables with the recall."""
    far = step_chance(math.sqrt(2), width)
    depth = max(4, math.ceil(math.log(8 * max(2, count)) / -math.log(far)))
    near = step_chance(math.sqrt(2 - 2 * cosine), width) ** depth
    return depth, math.ceil(math.log(1 - recall) / math.log(1 - near))


def usable(vector: list[float | None] | None) -> np.ndarray | None:
    """The vector in double precision, or None if it has no direction."""
    if vector is None or not len(vector) or any(v is None for v in vector):
        return None
    v = np.array(vector, np.float64)
    return v if np.isfinite(v).all() and v.any() else None


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max()  # so that squares neither overflow nor vanish
    return v / np.sqrt((v * v).sum())


def sketches(vectors: DataFrame, key: str, vector: str, depth: int, tables: int, width: float, seed: int) -> DataFrame:
    """(vec_id, digest, data: the vector's bytes, keys: one for each table)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bases: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            digests, data, keys = [], [], []
            for values in batch.column(1).to_pylist():
                v = usable(values)
                if v is None:
                    digests.append(None), data.append(None), keys.append(None)
                    continue
                if len(v) not in bases:
                    rng = np.random.default_rng([seed, len(v)])
                    bases[len(v)] = (rng.standard_normal((tables * depth, len(v))), rng.uniform(0, width, tables * depth))
                base, shift = bases[len(v)]
                steps = np.floor((base @ unit(v) + shift) / width).astype(np.int64).reshape(tables, depth)
                bucket = np.arange(tables, dtype=np.uint64) + np.uint64(len(v)) * np.uint64(tables)
                for i in range(depth):
                    bucket = mixed(bucket + steps[:, i].view(np.uint64), i)
                raw = v.tobytes()
                digests.append(hashlib.md5(raw).digest()), data.append(raw), keys.append(bucket.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(data, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["vec_id", "digest", "data", "keys"])

    return vectors.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).alias("v")).mapInArrow(
        run, "vec_id bigint, digest binary, data binary, keys array<bigint>")


def alike(cosine: float):
    def linked(data: list[bytes]) -> np.ndarray:
        out = np.zeros((len(data), len(data)), bool)
        size = np.array([len(d) for d in data])
        for n in np.unique(size):
            at = np.flatnonzero(size == n)
            x = np.stack([unit(np.frombuffer(data[i], np.float64)) for i in at])
            out[np.ix_(at, at)] = x @ x.T >= cosine
        return out
    return linked


def near_duplicates(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.9,
                    recall: float = 0.97, width: float = 2.0, seed: int = 9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    depth, tables = tables_for(vectors.count(), cosine, recall, width)
    made = stored(sketches(vectors, key, vector, depth, tables, width, seed), "lsh-sketches")
    classes = stored(made.where("digest is not null and vec_id is not null").groupBy("digest").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("size"), F.first(F.octet_length("data")).cast("bigint").alias("bytes"),
        F.first("keys").alias("keys"),
        F.first("data").alias("data")), "lsh-classes")

    def payload(nodes: DataFrame) -> DataFrame:
        return classes.select("node", "data").join(nodes, "node")

    found = links.find(classes.drop("data"), payload, alike(cosine), "lsh").select(
        "digest", "node", "size", "links", "component")
    return (made.select("vec_id", "digest").join(found, "digest", "left")
            .select("vec_id",
                    F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce(F.col("size") - 1 + F.col("links"), F.lit(0)))
                    .cast("bigint").alias("n_links"),
                    F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id")).alias("component_id"))
            .withColumn("kept", F.col("vec_id").isNull() | (F.col("vec_id") == F.col("component_id"))))
