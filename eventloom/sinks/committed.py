"""A sink for external stores with a commit protocol, as a data source for streams.

Each task stages its rows in the store and returns a token; when all tasks of a micro-batch
have done so, the tokens are published together under its number, and if one fails they are
discarded.  A reader sees whole micro-batches only, and one that is published again, after a
failure between publishing and the stream's own log, replaces itself.

A store is anything with the four methods of :class:`Store`; it is pickled to the executors.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter


class Store(Protocol):
    def stage(self, rows: Iterator[Any]) -> str:
        """Write the rows of a task where no reader looks; a token for them."""

    def publish(self, batch_id: int, tokens: list[str]) -> None:
        """Make the staged rows the content of a micro-batch, at once."""

    def discard(self, tokens: list[str]) -> None:
        """Forget staged rows."""


@dataclass
class Staged(WriterCommitMessage):
    token: str


def sink_of(store: Store, name: str) -> type[DataSource]:
    """The store as a data source called ``name``."""
    class Writer(DataSourceStreamWriter):
        def write(self, iterator: Iterator[Any]) -> Staged:
            return Staged(store.stage(iterator))

        def commit(self, messages: list[Staged | None], batchId: int) -> None:
            store.publish(batchId, [m.token for m in messages if m is not None])

        def abort(self, messages: list[Staged | None], batchId: int) -> None:
            store.discard([m.token for m in messages if m is not None])

    class Sink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def streamWriter(self, schema: Any, overwrite: bool) -> DataSourceStreamWriter:
            return Writer()

    return Sink


def writer(stream: DataFrame, store: Store, checkpoint: str) -> DataStreamWriter:
    """Write a stream to a store."""
    name = f"store_{uuid.uuid4().hex}"
    # The name is looked up in the session that is active when the stream starts.
    for session in (stream.sparkSession, SparkSession.active()):
        session.dataSource.register(sink_of(store, name))
    return stream.writeStream.format(name).outputMode("append").option("checkpointLocation", checkpoint)


class JsonFolder:
    """A store in a folder that all executors have mounted: staged files of JSON lines, and for
    each micro-batch a list of those that belong to it, which appears in one step."""

    def __init__(self, root: str):
        self.root = root.removeprefix("file://")
        if "://" in self.root:
            raise ValueError("the folder must be mounted on all executors")

    def _file(self, token: str) -> str:
        return f"{self.root}/rows/{token}.json"

    def stage(self, rows: Iterable[Any]) -> str:
        token = uuid.uuid4().hex
        os.makedirs(f"{self.root}/rows", exist_ok=True)
        try:
            with open(self._file(token), "x", encoding="utf-8") as f:
                for row in rows:
                    f.write(json.dumps(row.asDict(recursive=True), ensure_ascii=False) + "\n")
        except BaseException:
            self.discard([token])
            raise
        return token

    def publish(self, batch_id: int, tokens: list[str]) -> None:
        os.makedirs(f"{self.root}/batches", exist_ok=True)
        whole, part = f"{self.root}/batches/{batch_id}.json", f"{self.root}/batches/.{uuid.uuid4().hex}"
        with open(part, "x", encoding="utf-8") as f:
            json.dump(tokens, f)
        os.replace(part, whole)

    def discard(self, tokens: list[str]) -> None:
        for token in tokens:
            if os.path.exists(self._file(token)):
                os.remove(self._file(token))

    def published(self) -> list[str]:
        tokens = []
        for name in sorted(os.listdir(f"{self.root}/batches")) if os.path.isdir(f"{self.root}/batches") else []:
            if not name.startswith("."):
                with open(f"{self.root}/batches/{name}", encoding="utf-8") as f:
                    tokens += json.load(f)
        return tokens

    def read(self, spark: SparkSession, schema: str) -> DataFrame:
        """The published rows; what is staged or was discarded is not seen."""
        tokens = self.published()
        if not tokens:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).json([f"file://{self._file(t)}" for t in tokens])

    def sweep(self, older_than_s: float) -> None:
        """Remove what tasks of a broken-off micro-batch have staged, which no reader sees."""
        kept, names = set(self.published()), os.listdir(f"{self.root}/rows") if os.path.isdir(f"{self.root}/rows") else []
        for name in names:
            if name.removesuffix(".json") not in kept and time.time() - os.path.getmtime(f"{self.root}/rows/{name}") >= older_than_s:
                os.remove(f"{self.root}/rows/{name}")
