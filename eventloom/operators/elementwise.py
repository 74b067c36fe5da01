"""Row-level operators: projection, filtering, 0..n output rows, tagging, typed union."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions import scalar


def emit(df: DataFrame, keep: list[str], out: str, rows: Column) -> DataFrame:
    """One output row per element of the array ``rows``; an empty array emits nothing."""
    return df.select(*keep, F.explode(rows).alias(out))


def fields_as_rows(user: str, url: str, ms: str) -> Column:
    return F.array(F.col(user).cast("string"), F.col(url), F.col(ms).cast("string"))


def no_rows() -> Column:
    return F.array().cast("array<string>")


def tokens(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """(word, one) per word; a line ends at a newline, words are separated by one space."""
    return (df.select(*keep, F.explode(scalar.lines(F.col(text))).alias("line"))
            .select(*keep, F.explode(scalar.words(F.col("line"))).alias("word"))
            .withColumn("one", F.lit(1).cast("bigint")))


def parse_lines(df: DataFrame, text: str, delimiter: str, names: tuple[str, str, str]) -> DataFrame:
    """``a<delim>b<delim>long`` lines to typed columns.

    Adds ``ok``; a line without a readable third field keeps what could be read and has
    ``ok = false``, so the caller can branch good and bad rows without a second parse.
    """
    parts = F.split(F.col(text), re.escape(delimiter))
    field = [F.trim(F.get(parts, i)) for i in range(3)]
    number = field[2].try_cast("bigint")
    return df.withColumns({names[0]: field[0], names[1]: field[1], names[2]: number,
                           "ok": number.isNotNull()})


def tagged(df: DataFrame, branches: Mapping[str, Column], otherwise: str) -> DataFrame:
    """Add ``tag``: the name of the first branch whose condition holds."""
    tag = None
    for name, cond in branches.items():
        tag = F.when(cond, name) if tag is None else tag.when(cond, name)
    return df.withColumn("tag", tag.otherwise(otherwise))


def branch(df: DataFrame, tag: str) -> DataFrame:
    return df.where(F.col("tag") == tag)


def co_map(left: DataFrame, left_expr: Column, right: DataFrame, right_expr: Column,
           out: str) -> DataFrame:
    """Map two differently typed inputs into one output column."""
    return left.select(left_expr.alias(out)).unionByName(right.select(right_expr.alias(out)))


def map_with_resource(df: DataFrame, schema: T.StructType | str,
                      open_resource: Callable[[], Any], map_batch: Callable[[Any, Any], Any],
                      close_resource: Callable[[Any], None]) -> DataFrame:
    """Map Arrow batches with a resource that is opened and closed once per task."""

    def run(batches: Iterator[Any]) -> Iterator[Any]:
        resource = open_resource()
        try:
            for batch in batches:
                yield map_batch(resource, batch)
        finally:
            close_resource(resource)

    return df.mapInPandas(run, schema)
