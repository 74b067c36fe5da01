"""Byte-pair encoding by backtracking, and decoding by an offset table.

``Backtracker`` gives the merges of a piece without performing them: an Aho-Corasick
automaton lists the tokens that match at each place, the longest is tried first, and two
neighbours are accepted only if they are compatible, that is if no merge would ever have
joined them.  A place from which no compatible token leads on is never tried again, since a
prefix has only one encoding, so the work is linear in the length of the piece.

The lifetimes that compatibility rests on: the last symbol of the left token at a time is
made by one merge and used up by a later one, and so is the first symbol of the right one; a
merge joins them if it comes while both exist.  Of two overlapping uses of the same merge
the left one is made, hence the unequal comparisons.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.llm.tokens import KEPT_BYTES, Coder, Ragged, load, slices

_NEVER = 1 << 60
KNOWN_PAIRS = 200_000

# Letters, numbers and white space of Latin-1 after lower-casing.
_LETTERS, _NUMBERS, _SPACES = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
_LATIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")


def byte_characters() -> list[str]:
    """The visible character that stands for each byte: itself where it is visible Latin-1,
    else the next one from U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


class Backtracker:
    """Encoder of one vocabulary; symbols are the byte characters, the last one of a piece
    with the end-of-word suffix if the vocabulary has one."""

    END = "￿"

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.suffix = suffix
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, int] = {}
        parts: dict[int, tuple[int, int]] = {}
        joined: dict[tuple[int, int], int] = {}
        for r, (a, b) in enumerate(merges):
            left = a[:-len(suffix)] if suffix and a.endswith(suffix) and a + b not in vocab else a
            new = vocab[left + b]
            pair = (vocab[a], vocab[b])
            self.rank.setdefault(pair, r)
            joined.setdefault(pair, new)
            if new not in self.made:
                self.made[new], parts[new] = r, pair
        self.parts = parts
        self._compatible: dict[tuple[int, int], bool] = {}
        self._first: dict[int, list[tuple[int, int, int]]] = {}
        self._last: dict[int, list[tuple[int, int, int]]] = {}
        text = {i: self._symbols(t) for t, i in vocab.items()}
        self.automaton = ahocorasick.Automaton()
        good: dict[int, bool] = {}
        own: dict[str, int] = {}
        for i in sorted(text, key=lambda i: self.made.get(i, -1)):
            # A token that its own text does not lead to never occurs.
            good[i] = i not in parts or (all(good.get(p, False) for p in parts[i])
                                         and self._apart(*parts[i], self.made[i]))
            if good[i]:
                own[text[i]] = i
                self.automaton.add_word(text[i], (len(text[i]), i))
        self.automaton.make_automaton()
        # Of each token its length and the longest other one that it begins with.
        self.length = {i: len(t) for t, i in own.items()}
        self.shorter = {i: next((own[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in own), -1)
                        for t, i in own.items()}

    def _symbols(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix) and token != self.suffix:
            return token[:-len(self.suffix)] + self.END
        return token

    def _edge(self, token: int, side: int, known: dict) -> list[tuple[int, int, int]]:
        """(symbol, merge that makes it, merge that uses it up) along one edge of a token."""
        spine = known.get(token)
        if spine is None:
            spine, at, end = [], token, _NEVER
            while True:
                birth = self.made.get(at, -1)
                spine.append((at, birth, end))
                if at not in self.parts:
                    break
                at, end = self.parts[at][side], birth
            known[token] = spine
        return spine

    def _apart(self, left: int, right: int, before: int = _NEVER) -> bool:
        """Whether no merge earlier than ``before`` joins the two tokens."""
        for a, a_birth, a_end in self._edge(left, 1, self._last):
            for b, b_birth, b_end in self._edge(right, 0, self._first):
                r = self.rank.get((a, b))
                if r is not None and a_birth < r < a_end and b_birth < r <= b_end and r < before:
                    return False
        return True

    def compatible(self, left: int, right: int) -> bool:
        pair = (left, right)
        known = self._compatible.get(pair)
        if known is None:
            if len(self._compatible) >= KNOWN_PAIRS:
                self._compatible.clear()
            known = self._compatible[pair] = self._apart(left, right)
        return known

    def encode(self, piece: str) -> array:
        """Ids of one piece, given in byte characters.

        What is kept of a place is the next token to try there, four bytes, so a piece of
        many megabytes costs a few times its size.
        """
        if self.suffix:
            piece += self.END
        size = len(piece)
        fits = array("i", [-1]) * size
        for end, (length, token) in self.automaton.iter(piece):
            fits[end + 1 - length] = token  # the longest one comes last
        at, out, length, shorter = 0, array("I"), self.length, self.shorter
        while at < size:
            while (token := fits[at]) >= 0:
                fits[at] = shorter[token]
                to = at + length[token]
                if (to == size or fits[to] >= 0) and (not out or self.compatible(out[-1], token)):
                    out.append(token)
                    at = to
                    break
            else:
                if not out:
                    raise ValueError("a symbol is missing in the vocabulary")
                at -= length[out.pop()]
        return out


class WordBpe(Coder):
    """Ids of whole texts for a tokenizer that drops white space; the library normalises and
    cuts, the merges are found by ``Backtracker``."""

    def __init__(self, path: str, kept: int = KEPT_BYTES):
        super().__init__(False, 4, kept)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = load(path)
        model = spec["model"]
        self.bpe = Backtracker(model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"] or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        chars = byte_characters()
        self.visible = {i: "".join(chars[b] for b in chr(i).encode()) for i in range(256)
                        if chr(i).encode() != chars[i].encode() or i > 127}
        names = model["vocab"] | self.special
        self.decoder = OffsetTable({i: t for t, i in names.items()})

    def new(self, units: pa.Array) -> Ragged:
        return Ragged.of([self._chunk(u) for u in units.to_pylist()], self.kind)

    def _piece(self, piece: str) -> bytes:
        return self.bpe.encode(piece).tobytes()

    def _plain(self, text: str) -> bytes:
        """Latin-1 has no combining marks, so there lower-casing is all that the
        normaliser does and the cut needs no Unicode tables; all else asks the library."""
        if text.isascii() or max(text) < "\u0100":
            found = _LATIN.findall(text.lower())
            return b"".join([self._piece(p.translate(self.visible)) for p in found])
        norm = self.tokenizer.normalizer.normalize_str(text)
        return b"".join(self._piece(p) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(norm))

    def _chunk(self, text: str) -> bytes:
        if "<" not in text:
            return self._plain(text)
        out = []
        while text:
            hits = [(at, name) for name in self.special if (at := text.find(name)) >= 0]
            at, name = min(hits, default=(len(text), ""))
            out.append(self._plain(text[:at]))
            if name:
                out.append(self.special[name].to_bytes(4, "little"))
            text = text[at + len(name):]
        return b"".join(out)


class OffsetTable:
    """All token texts in one buffer; decoding copies the stretches of the ids, with a blank
    before each token but the first."""

    STEP = 1 << 16

    def __init__(self, names: dict[int, str]):
        rows = [(" " + names[i]).encode() if i in names else b"" for i in range(max(names) + 1)]
        self.buffer = np.frombuffer(b"".join(rows), np.uint8)
        self.size = np.array([len(r) for r in rows], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def decode(self, ids: np.ndarray) -> bytes:
        out = []
        for at in range(0, len(ids), self.STEP):
            part = ids[at:at + self.STEP]
            size = self.size[part]
            ends = np.cumsum(size)
            out.append(self.buffer[np.repeat(self.start[part] - ends + size, size) + np.arange(ends[-1])].tobytes())
        return b"".join(out)[1:]


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """One coder for each worker process."""
    return WordBpe(path)


def encoded(text: str | Column, tokenizer: str) -> Column:
    """Ids of each whole text as binary; a null text gives no ids."""
    def run(texts: pa.Array) -> pa.Array:
        coder = word_bpe(tokenizer)
        return pa.array([ids for part in slices(texts) for ids in coder.encode(part)], pa.binary())

    return F.arrow_udf(run, "binary")(text)


def decoded(ids: str | Column, tokenizer: str) -> Column:
    """The text of binary ids; null ids give an empty text."""
    def run(column: pa.Array) -> pa.Array:
        table = word_bpe(tokenizer).decoder
        return pa.array([table.decode(np.frombuffer(i or b"", "<u4")).decode() for i in column.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")(ids)


def digests(text: str | Column, tokenizer: str) -> Column:
    """struct(n_tokens, ids_sha256, decoded_sha256) of each whole text: encodes, decodes the
    ids again and keeps only the digests, so that neither leaves the task."""
    import hashlib

    def run(texts: pa.Array) -> pa.Array:
        coder = word_bpe(tokenizer)
        n, ids_sha, text_sha = [], [], []
        for part in slices(texts):
            for raw in coder.encode(part):
                n.append(len(raw) // 4)
                ids_sha.append(hashlib.sha256(raw).hexdigest())
                text_sha.append(hashlib.sha256(coder.decoder.decode(np.frombuffer(raw, "<u4"))).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
            ["n_tokens", "ids_sha256", "decoded_sha256"])

    return F.arrow_udf(run, "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")(text)
