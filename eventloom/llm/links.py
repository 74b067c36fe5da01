"""Links between rows that share bucket keys: grouping, exact verification, components.

Every key has a pivot, the smallest node that has it.  Nodes with a common key have a common
pivot, so rows (pivot, node), of which there are fewer than (key, node), bring all candidates
together.  A group is verified in blocks of a bounded number of nodes, block against block;
what leaves a task is, for each node, the weight of its links and one node that it hangs
together with, never a list of pairs.  A pair that meets at several pivots counts at the
smallest one only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import components, runs, stored

BROADCAST_ROWS = 2_000_000
BLOCK_BYTES = 16_000_000

# Of the payloads of a block, which pairs are linked.
Linked = Callable[[list[bytes]], np.ndarray]


def small(ids: DataFrame) -> DataFrame:
    """Mark a frame of one number a row for broadcast, but only up to a fixed size."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def meetings(classes: DataFrame, label: str) -> DataFrame:
    """(pivot, node, bytes) for all ``classes`` (node, bytes, keys) that share a key with another one."""
    keys = classes.select("node", "bytes", F.explode("keys").alias("k"))
    shared = keys.groupBy("k").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    return stored(keys.join(shared, "k").select("pivot", "node", "bytes").distinct(), f"{label}-meetings")


def _roots(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix the smallest index that it hangs together with."""
    label = np.arange(len(linked))
    whole = linked | np.eye(len(linked), dtype=bool)
    while True:
        new = np.where(whole, label[None, :], len(linked)).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _share(lists: list[list[int]], below: int) -> np.ndarray:
    """Which rows have a common number below ``below``."""
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    values = np.array([v for x in lists for v in x], np.int64)
    rows, values = rows[values < below], values[values < below]
    names, column = np.unique(values, return_inverse=True)
    has = np.zeros((len(lists), len(names)), np.float32)
    has[rows, column] = 1
    return has @ has.T > 0


def _verify(linked: Linked) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["pivot", "a", "b"]):
            nodes, first = np.unique(group["node"].to_numpy(), return_index=True)
            if len(nodes) < 2:
                continue
            group = group.take(pa.array(first))
            pivot, a, b = (group[c][0].as_py() for c in ("pivot", "a", "b"))
            hit = linked(group["data"].to_pylist())
            np.fill_diagonal(hit, False)
            if a != b:  # inside a block the pairs are those of (a, a)
                block = group["x"].to_numpy()
                hit &= block[:, None] != block[None, :]
            if not hit.any():
                continue
            hit &= ~_share(group["pivots"].to_pylist(), pivot)
            weight = hit @ group["size"].to_numpy().astype(np.int64)
            own = weight > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[own]), pa.array(weight[own]), pa.array(nodes[_roots(hit)][own])],
                ["node", "links", "root"])
    return run


def find(classes: DataFrame, payload: Callable[[DataFrame], DataFrame], linked: Linked, label: str,
         block: int = 256) -> DataFrame:
    """``classes`` (node, size, bytes, keys) with ``links``, the sizes of the classes that a class is
    linked to, and ``component``, the smallest node it hangs together with.

    ``payload`` gets the frame of nodes that need verification, (node), and returns
    (node, data) with what ``linked`` compares, of about ``bytes`` bytes.  A block has about
    ``block`` nodes, fewer where their data would be above ``BLOCK_BYTES``.
    """
    meet = meetings(classes, label)
    nodes = stored(meet.groupBy("node").agg(F.collect_set("pivot").alias("pivots")), f"{label}-nodes")
    sizes = meet.groupBy("pivot").agg(F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("bytes") / BLOCK_BYTES))
                                      .cast("int").alias("blocks"))
    x, y = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.col("y")
    dealt = (meet.drop("bytes").join(sizes, "pivot").withColumn("x", x)
             .withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("pivot", "node", "x", F.least("x", y).alias("a"), F.greatest("x", y).alias("b")))
    known = nodes.join(classes.select("node", "size"), "node").join(payload(nodes.select("node")), "node")
    groups = (dealt.join(known, "node").select("pivot", "a", "b", "node", "x", "size", "pivots", "data")
              .repartition("pivot", "a", "b").sortWithinPartitions("pivot", "a", "b"))
    found = stored(groups.mapInArrow(_verify(linked), "node bigint, links bigint, root bigint"), f"{label}-links")
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), label)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    return (classes.join(links, "node", "left").join(joined, "node", "left")
            .select(*classes.columns, F.coalesce("links", F.lit(0)).alias("links"),
                    F.coalesce("component", "node").alias("component")))
