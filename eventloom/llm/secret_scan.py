"""Secrets in texts: fixed patterns, and strings that a primed compressor cannot explain.

The base patterns find assignments, access keys and hexadecimal strings.  Beyond them, each
string of letters and digits that follows a sensitive word closely is a candidate, and its
novelty is what it adds to the zstandard size of the code around it, the compressor being
primed with a dictionary of identifiers: a name made of known words, or one that occurs
nearby, costs a few bytes, a random string most of its entropy.  Candidates above
``least_bits`` bits a character are reported as kind ``novel``; they do not touch base spans.

Each text is judged by itself, so rows of any number and order are independent.  Places are
code points, ends exclusive.

Cases: null and empty texts have no spans; repeated rows come out alike; a text of any
length is searched whole, in time linear in its length and its candidates.  Other columns
pass through ``with_spans``, which replaces its own.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
# A run that is too short cannot hold a longer match of these two, so the bound is in the pattern.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

_SENSITIVE = (r"passw(?:or)?d|passphrase|pwd|secret|token|api.?key|access.?key|private.?key|signing.?key|credential"
              r"|bearer|authorization|auth")
_WORD = re.compile(_SENSITIVE, re.IGNORECASE | re.ASCII)
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{12,}={0,2}")
# Texts without any of this have no span; the engine of this search also folds letters beyond ASCII.
_ANY = rf"(?i:{_SENSITIVE})|AKIA|[0-9a-f]{{24}}"

SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint,bits:double>>"

# Words that names in code are made of, most telling last, as a compressor looks back from its end.
IDENTIFIERS = (
    "function return import export default class public private protected static const async await "
    "string integer boolean object array list dict value values key keys index count length size "
    "config configuration settings options environment production development staging testing example "
    "sample placeholder changeme your_value_here none null true false undefined default_value "
    "http https localhost server client request response header headers content type application json "
    "user username user_name account email session cookie connection database host port path file name "
    "version timeout retry callback handler manager service provider factory controller repository "
    "access_key access_token refresh_token api_key api_token secret_key client_id client_secret "
    "private_key public_key signing_key encryption_key password passwd passphrase credential credentials "
    "authorization authentication authenticate bearer oauth oauth2 token tokens token_type expires_in "
    "expires_at get_secret_value get_password set_password reset_password hash_password password_hash "
    "0123456789 1234567890 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ xxxxxxxxxxxxxxxx 0000000000000000")


@dataclass(frozen=True)
class Novelty:
    """What counts as unexplained: ``reach`` code points from a sensitive word to a candidate,
    ``around`` code points of context on each side, ``least_bits`` a character."""

    dictionary: str = IDENTIFIERS
    reach: int = 40
    around: int = 200
    least_bits: float = 6.0
    level: int = 12


@lru_cache(maxsize=4)
def _compressor(dictionary: str, level: int) -> zstandard.ZstdCompressor:
    primed = zstandard.ZstdCompressionDict(dictionary.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=level, dict_data=primed, write_content_size=False, write_checksum=False,
                                    write_dict_id=False)


def novelty(text: str, start: int, end: int, rule: Novelty = Novelty()) -> float:
    """Bits a character that the stretch adds to the compressed size of what is around it."""
    size = _compressor(rule.dictionary, rule.level).compress
    before, after = text[max(0, start - rule.around):start], text[end:end + rule.around]
    # The candidate comes last, so that both sides may explain it.
    around = f"{before}\n{after}\n".encode()
    own = text[start:end]
    return 8 * (len(size(around + own.encode())) - len(size(around))) / len(own)


def base_spans(text: str) -> list[tuple[int, int, str, float | None]]:
    out = [(*m.span(), "assign", None) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(*m.span(), "access", None) for m in _ACCESS.finditer(text)]
    out += [(*m.span(), "hex", None) for m in _HEX.finditer(text)]
    return out


def _mixed(value: str) -> bool:
    """Digits and letters, as generated strings have and most names do not."""
    return any(c.isdigit() for c in value) and any(c.isalpha() for c in value)


def spans(text: str | None, rule: Novelty = Novelty()) -> list[tuple[int, int, str, float | None]]:
    """(start, end, kind, bits) by start, then kind in the order of ``KINDS``."""
    if not text:
        return []
    out = base_spans(text)
    ends = np.array([m.end() for m in _WORD.finditer(text)], np.int64)
    if len(ends):
        taken = sorted((a, b) for a, b, _, _ in out)
        upto = np.maximum.accumulate([b for _, b in taken]) if taken else np.empty(0, np.int64)
        begins = np.array([a for a, _ in taken], np.int64)
        for m in _CANDIDATE.finditer(text):
            a, b = m.span()
            word = np.searchsorted(ends, a, side="right") - 1
            if word < 0 or a - ends[word] > rule.reach or not _mixed(m[0]):
                continue
            before = np.searchsorted(begins, b) - 1  # the last base span that begins before the end
            if before >= 0 and upto[before] > a:
                continue
            bits = novelty(text, a, b, rule)
            if bits >= rule.least_bits:
                out.append((a, b, "novel", bits))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def with_spans(docs: DataFrame, name: str, *, text: str = "text", rule: Novelty = Novelty()) -> DataFrame:
    """Add the spans of each text as an array of (kind, start, end, bits)."""
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())]))

    def run(texts: pa.Array) -> pa.Array:
        hits = pc.fill_null(pc.match_substring_regex(texts, _ANY), False)
        found = iter(texts.filter(hits).to_pylist())
        return pa.array([[{"kind": k, "start": a, "end": b, "bits": bits} for a, b, k, bits in spans(next(found), rule)]
                         if hit else [] for hit in hits.to_pylist()], kinds)

    return docs.withColumn(name, F.arrow_udf(run, SPAN_TYPE)(text))


def listed(spans_: str | Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, *, text: str = "text", rule: Novelty = Novelty()) -> DataFrame:
    """Replace each stretch covered by spans by the kind of its first one in brackets."""
    def run(texts: pa.Array) -> pa.Array:
        hits = pc.fill_null(pc.match_substring_regex(texts, _ANY), False).to_pylist()
        out = []
        for hit, t in zip(hits, texts.to_pylist()):
            parts, at, end = [], 0, 0
            for a, b, kind, _ in spans(t, rule) if hit else ():
                if a >= end:
                    parts += [t[at:a], f"[{kind}]"]
                end = at = max(end, b)
            out.append("".join([*parts, t[at:]]) if parts else t)
        return pa.array(out, pa.string())

    return docs.withColumn(text, F.arrow_udf(run, "string")(text))
