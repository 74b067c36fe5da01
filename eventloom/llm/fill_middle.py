"""Fill-in-middle transformation with an indexable skip list over the units of a text.

Units are code points, or the matches of a pattern (words, lines) with what lies between
them.  Two hashes of the key choose the units at which a text is cut in three; the skip list
finds the code points of both cuts: each express lane has links over ``FAN`` links of the
lane below, with their width in units and in code points, and a search goes down from the
highest lane, adding widths as long as the rank is not passed.  The parts are put in prefix,
suffix, middle order (psm) or suffix first (spm) between marker strings, and ``restore``
gives the exact text back.

Cases: a null text is empty; empty texts, texts that contain a marker, and a share of all
by a third hash stay plain; a null key is hashed as an empty one; repeated rows come out
alike.  Other columns pass through ``transform``, which replaces its own.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import free_names

FAN = 32
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_TYPE = ("struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,{}>")


class SkipList:
    """Units in a row, found by rank.  ``lanes[0]`` are the units; a link of a higher lane
    leads over ``FAN`` links of the one below."""

    def __init__(self, widths: np.ndarray):
        self.n = len(widths)
        units, chars = np.broadcast_to(np.int64(1), self.n), widths
        self.lanes = [(units, chars)]
        while len(units) > FAN:
            starts = np.arange(0, len(units), FAN)
            units, chars = np.add.reduceat(units, starts), np.add.reduceat(chars, starts)
            self.lanes.append((units, chars))

    def chars_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        if not 0 <= rank <= self.n:
            raise IndexError(rank)
        left, link, done = rank, 0, 0
        for units, chars in reversed(self.lanes):
            while left and link < len(units) and units[link] <= left:
                left -= int(units[link])
                done += int(chars[link])
                link += 1
            link *= FAN
        return done


def unit_widths(text: str, unit: str | None) -> np.ndarray:
    """Code points of each unit: matches of the pattern, each with what follows up to the
    next one; what comes before the first match belongs to it."""
    if unit is None:
        return np.broadcast_to(np.int64(1), len(text))
    starts = [m.start() for m in re.finditer(unit, text) if m.end() > m.start()]
    return np.diff([0, *starts[1:], len(text)]) if starts else np.array([len(text)] if text else [], np.int64)


@dataclass(frozen=True)
class Shape:
    """How texts are transformed; shares in percent."""

    seed: int = 1
    plain_from: int = 90  # h3 % 100 at or above this stays plain
    spm_below: int = 20  # h4 % 100 below this is suffix first
    unit: str | None = None

    def hashes(self, key: int | None) -> list[int]:
        digest = hashlib.sha256(f"{self.seed}:{'' if key is None else key}".encode()).hexdigest()
        return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]

    def apply(self, key: int | None, text: str | None) -> tuple[int, str, int | None, int | None, str]:
        """(units, form, code points of the prefix, of the middle, output)."""
        text = text or ""
        units = SkipList(unit_widths(text, self.unit))
        h1, h2, h3, h4 = self.hashes(key)
        if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= self.plain_from:
            return units.n, "plain", None, None, text
        low, high = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
        a, b = units.chars_before(low), units.chars_before(high)
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h4 % 100 < self.spm_below:
            return units.n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
        return units.n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text that was transformed.  No part contains a marker, and a marker does not begin
    within another one, so the first of each is the one that was put in."""
    if form == "plain":
        return output
    rest, middle = output.split(MIDDLE, 1)
    if form == "spm":
        suffix, prefix = rest.removeprefix(SUFFIX).split(PREFIX, 1)
    else:
        prefix, suffix = rest.removeprefix(PREFIX).split(SUFFIX, 1)
    return prefix + middle + suffix


def _shaped(keys: pa.Array, texts: pa.Array, shape: Shape, last: list[str], of) -> pa.Array:
    rows = [shape.apply(k.as_py(), t.as_py()) for k, t in zip(keys, texts)]
    n, form, prefix, middle, output = zip(*rows) if rows else ((),) * 5
    ends = zip(*map(of, output, form)) if rows else ((),) * len(last)
    return pa.StructArray.from_arrays(
        [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
         pa.array(middle, pa.int64()), *(pa.array(e, pa.string()) for e in ends)],
        ["n", "form", "prefix_chars", "middle_chars", *last])


def transform(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shape: Shape = Shape()) -> DataFrame:
    """Add ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``."""
    def run(keys: pa.Array, texts: pa.Array) -> pa.Array:
        return _shaped(keys, texts, shape, ["output"], lambda output, form: (output,))

    made = ["n", "form", "prefix_chars", "middle_chars", "output"]
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in made]
    name, = free_names(docs, "shaped_")
    udf = F.arrow_udf(run, _TYPE.format("output:string"))
    return docs.withColumn(name, udf(F.col(key).cast("bigint"), F.col(text))).select(*kept, f"{name}.*")


def restored(output: str | Column, form: str | Column) -> Column:
    """The texts of transformed rows; null where one of both is null."""
    def run(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        return pa.array([None if o is None or f is None else restore(o, f)
                         for o, f in zip(outputs.to_pylist(), forms.to_pylist())], pa.string())

    return F.arrow_udf(run, "string")(output, form)


def digests(key: str, text: str, shape: Shape = Shape()) -> Column:
    """struct(n, form, prefix_chars, middle_chars, output_sha256, restored_sha256): transforms
    a text, restores it from the output alone and keeps only the digests of both."""
    def both(output: str, form: str) -> tuple[str, str]:
        return (hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256(restore(output, form).encode()).hexdigest())

    def run(keys: pa.Array, texts: pa.Array) -> pa.Array:
        return _shaped(keys, texts, shape, ["output_sha256", "restored_sha256"], both)

    return F.arrow_udf(run, _TYPE.format("output_sha256:string,restored_sha256:string"))(
        F.col(key).cast("bigint"), F.col(text))
