"""Token ids of whole texts by a tokenizer file.

Both kinds of tokenizer here cut a text at blanks before they merge, so the ids of a text
are those of its chunks in a row.  A slice of texts is split and its distinct chunks are
found by Arrow kernels; those that are a word with punctuation are parted into the two,
and units that are new go through the library together.  The ids of the slice are gathered
with numpy, so no Python runs for a single word.  Units that were met before are kept up to
a number of bytes, which changes no result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KEPT_BYTES = 32_000_000
SLICE_BYTES = 3_000_000
_GATHERED = 1 << 16  # chunks whose ids are gathered at once
_CALL = 4096  # units of a library call

# A blank at the start or end, or before more white space of Unicode (and the separators
# that Python counts as such).
_ODD = r"^ | (?:[\t-\r\x1c-\x20\x{85}\p{Z}]|$)"
_BEFORE_WORD = re.compile(r"(?= \S)")
# Words of Latin-1 letters, with punctuation that no rule of the tokenizers joins to letters.
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?"
_WORD = f"^[{_LETTERS}]+[{_MARKS}]*$"


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task on each core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Runs of texts of about ``most`` bytes, to bound what is held at once; a longer text
    is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield texts.slice(at, to - at)
        at = to


def before_words(text: str) -> list[str]:
    """Cut before every blank that a visible character follows; chunks but for the first
    have lost their blank."""
    parts = _BEFORE_WORD.split(text)
    return parts[:1] + [p[1:] for p in parts[1:]]


class Ragged:
    """Rows of ids of different lengths, in one array."""

    def __init__(self, ids: np.ndarray, size: np.ndarray):
        self.ids, self.size = ids, size
        self.start = np.cumsum(size) - size

    @classmethod
    def of(cls, rows: list[bytes], kind: str) -> Ragged:
        ids = np.frombuffer(b"".join(rows), kind)
        return cls(ids, np.fromiter(map(len, rows), np.int64, len(rows)) // ids.itemsize)

    def then(self, other: Ragged) -> Ragged:
        return Ragged(np.concatenate([self.ids, other.ids]), np.concatenate([self.size, other.size]))

    def take(self, index: np.ndarray) -> Ragged:
        size = self.size[index]
        ends = np.concatenate([[0], np.cumsum(size)])
        out = np.empty(ends[-1], self.ids.dtype)
        for at in range(0, len(index), _GATHERED):
            n = size[at:at + _GATHERED]
            first, last = ends[at], ends[at + len(n)]
            shift = self.start[index[at:at + _GATHERED]] - (ends[at:at + len(n)] - first)
            out[first:last] = self.ids[np.repeat(shift, n) + np.arange(last - first)]
        return Ragged(out, size)


class Coder:
    """Ids of texts as little-endian unsigned integers of ``width`` bytes.

    ``keeps_blanks`` tells whether blanks are part of tokens (byte-level) or white space is
    dropped.  A subclass gives the ids of new units: texts that the tokenizer cuts from their
    neighbours (with blanks: a chunk and the blank before it).
    """

    def __init__(self, keeps_blanks: bool, width: int, kept: int):
        self.keeps_blanks, self.kind, self.kept = keeps_blanks, f"<u{width}", kept
        self.known = pa.array([], pa.string())
        self.rows = Ragged.of([], self.kind)

    def new(self, units: pa.Array) -> Ragged:
        raise NotImplementedError

    def heads(self, texts: list[str]) -> list[bytes]:
        """The ids of beginnings of texts, where blanks are kept."""
        raise NotImplementedError

    def _units(self, units: pa.Array) -> Ragged:
        """The ids of distinct units."""
        # The units of the slice are the smaller table, so the kept ones are looked up in them.
        at = pc.index_in(self.known, value_set=units)
        met = np.flatnonzero(pc.is_valid(at).to_numpy(zero_copy_only=False))
        index = np.full(len(units), -1, np.int64)
        index[pc.drop_null(at).to_numpy()] = met
        missed = index < 0
        wanted = units.filter(pa.array(missed))
        rows = self.rows
        if len(wanted):
            rows = rows.then(self.new(wanted))
            index[missed] = len(self.known) + np.arange(len(wanted))
        own = rows.take(index)
        if len(wanted):
            known = pa.concat_arrays([self.known, wanted])
            if known.nbytes + rows.ids.nbytes + 2 * rows.size.nbytes <= self.kept:
                self.known, self.rows = known, rows
            else:  # start again from what this slice has
                fits = units.nbytes + own.ids.nbytes + 2 * own.size.nbytes <= self.kept
                self.known, self.rows = (units, own) if fits else (units.slice(0, 0), Ragged.of([], self.kind))
        return own

    def _chunks(self, chunks: pa.Array) -> Ragged:
        """The ids of distinct chunks."""
        words = pc.match_substring_regex(chunks, _WORD)
        is_word = words.to_numpy(zero_copy_only=False)
        whole = chunks.filter(words)
        bare = pc.utf8_rtrim(whole, _MARKS)
        marks = pc.replace_substring_regex(whole, f"^[{_LETTERS}]+", "")
        first = pa.concat_arrays([chunks.filter(pc.invert(words)), bare if self.keeps_blanks else pc.utf8_lower(bare)])
        if self.keeps_blanks:
            first = pc.binary_join_element_wise("", first, " ")  # the last argument is the separator
        parts = pa.concat_arrays([first, marks]).dictionary_encode()
        index = parts.indices.to_numpy().astype(np.int64)
        # Chunk by chunk: its only or first unit, then its punctuation.
        n, others = len(chunks), len(chunks) - len(whole)
        pairs = np.empty((n, 2), np.int64)
        empty = len(parts.dictionary)
        pairs[~is_word, 0], pairs[~is_word, 1] = index[:others], empty
        pairs[is_word, 0], pairs[is_word, 1] = index[others:n], index[n:]
        none = Ragged(np.empty(0, self.kind), np.zeros(1, np.int64))
        taken = self._units(parts.dictionary).then(none).take(pairs.ravel())
        return Ragged(taken.ids, taken.size.reshape(n, 2).sum(axis=1))

    def encode(self, texts: pa.Array | list[str | None]) -> list[memoryview]:
        """The ids of each text, null being empty; for texts that fit in memory some ten times."""
        pa.default_memory_pool().release_unused()  # what earlier slices needed
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        texts = pc.fill_null(texts, "")
        if not self.keeps_blanks:
            return self._gathered(pc.ascii_split_whitespace(texts))
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._gathered(pc.split_pattern(texts, " "))
        out: list = [None] * len(texts)
        cut = pa.array([before_words(t) for t in texts.filter(pa.array(odd)).to_pylist()], pa.list_(pa.string()))
        for rows, lists in ((odd, cut), (~odd, pc.split_pattern(texts.filter(pa.array(~odd)), " "))):
            for i, ids in zip(np.flatnonzero(rows).tolist(), self._gathered(lists)):
                out[i] = ids
        return out

    def _gathered(self, lists: pa.ListArray) -> list[memoryview]:
        """The ids of texts that are given as lists of chunks."""
        if not len(lists):
            return []
        bounds = lists.offsets.to_numpy().astype(np.int64)
        values = lists.values.slice(bounds[0], bounds[-1] - bounds[0])
        bounds = bounds - bounds[0]
        coded = values.dictionary_encode()
        index = coded.indices.to_numpy().astype(np.int64)
        rows = self._chunks(coded.dictionary)
        if self.keeps_blanks:  # every text has a first chunk, which stands by itself
            rows = rows.then(Ragged.of(self.heads(values.take(pa.array(bounds[:-1])).to_pylist()), self.kind))
            index[bounds[:-1]] = len(coded.dictionary) + np.arange(len(lists))
        taken = rows.take(index)
        raw = memoryview(taken.ids.view(np.uint8))
        ends = np.concatenate([[0], np.cumsum(taken.size)])
        places = (ends[bounds] * taken.ids.itemsize).tolist()
        return [raw[a:b] for a, b in zip(places[:-1], places[1:])]


class ChunkEncoder(Coder):
    """Ids by the tokenizers library."""

    def __init__(self, path: str, keeps_blanks: bool, width: int, kept: int = KEPT_BYTES):
        super().__init__(keeps_blanks, width, kept)
        self.tokenizer = load(path)
        # Tokens at which a unit of several in one library call begins or ends.
        names = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.bounds = np.array([t.startswith("Ġ") if keeps_blanks else t.endswith("</w>")
                                for t in (names.get(i, "") for i in range(max(names) + 1))])
        # A special token parts the texts that nothing else tells apart.
        special = max(self.tokenizer.get_added_tokens_decoder().items())
        self.mark, self.mark_id = special[1].content, special[0]

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def heads(self, texts: list[str]) -> list[bytes]:
        """Texts of any kind: joined by the mark where none has its first character."""
        out: list[bytes] = [b""] * len(texts)
        plain = [i for i, t in enumerate(texts) if "<" not in t]
        for at in range(0, len(plain), 512):
            some = plain[at:at + 512]
            ids = np.array(self._encode(["".join(texts[i] + self.mark for i in some)])[0], self.kind)
            raw, width, start = ids.tobytes(), ids.itemsize, 0
            for i, end in zip(some, (np.flatnonzero(ids == self.mark_id) * width).tolist(), strict=True):
                out[i] = raw[start:end]
                start = end + width
        rest = [i for i, t in enumerate(texts) if "<" in t]
        for i, ids in zip(rest, self._encode([texts[i] for i in rest])):
            out[i] = np.array(ids, self.kind).tobytes()
        return out

    def new(self, units: pa.Array) -> Ragged:
        if self.keeps_blanks:
            # A blank and what is visible: its first token is its only one that begins with a blank.
            alike = pc.match_substring_regex(units, r"^ [^ <]+$")
        else:
            # A word or punctuation: its last token is its only one with the end of a word.
            alike = pc.match_substring_regex(units, f"^(?:[{_LETTERS}]+|[{_MARKS}]+)$")
        own, is_own = units.filter(alike), alike.to_numpy(zero_copy_only=False)
        ids, sizes = [np.empty(0, self.kind)], [np.empty(0, np.int64)]
        for at in range(0, len(own), _CALL):
            some = own.slice(at, _CALL)
            glue = "" if self.keeps_blanks else " "
            text = pc.binary_join(pa.ListArray.from_arrays([0, len(some)], some), glue)[0].as_py()
            got = np.array(self._encode([text])[0], self.kind)
            edges = np.flatnonzero(self.bounds[got])
            edges = np.append(edges, len(got)) if self.keeps_blanks else np.append(0, edges + 1)
            if len(edges) != len(some) + 1:
                raise ValueError("units and ids differ")
            ids.append(got)
            sizes.append(np.diff(edges))
        rest = Ragged.of(self.heads(units.filter(pc.invert(alike)).to_pylist()), self.kind)
        rows = Ragged(np.concatenate(ids), np.concatenate(sizes)).then(rest)
        order = np.empty(len(units), np.int64)
        order[is_own] = np.arange(len(own))
        order[~is_own] = len(own) + np.arange(len(units) - len(own))
        return rows.take(order)


@lru_cache(maxsize=2)
def encoder(path: str, keeps_blanks: bool, width: int) -> ChunkEncoder:
    """One encoder for each worker process."""
    return ChunkEncoder(path, keeps_blanks, width)
