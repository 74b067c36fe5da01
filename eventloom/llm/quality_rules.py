"""Quality rules: a decision list learned from labelled statistics of texts.

``with_statistics`` adds the statistics of each whole text, ``learn`` grows and prunes
conjunctions of thresholds by sequential covering on a bounded sample of labelled rows, and
``verdict`` turns them into one ordered Spark conditional expression.

Cases: a null text counts as empty; an empty text has no words and fails the base rule;
labels that are null or of unknown documents are left out; of contradicting labels of one
document the worse counts; repeated rows are judged alike;
without labelled rows of both classes the list is empty and keeps all.  Other columns, of
whatever name, pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import free_names


# Counts of a text that UDF ``_counts`` returns.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_upper", "n_letters", "n_bangs", "n_distinct", "n_stutter")
COUNT_TYPE = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"

# What rules may test, as SQL over the counts.
RATIOS = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(n_letters, 1)",
    "bangs_per_word": "n_bangs / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "stutter_share": "n_stutter / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "dup_lines_per_word": "n_dup_lines / greatest(n_words, 1)",
    "n_words": "cast(n_words as double)",
}

_BLANKS = b"\t\n\v\f\r "
_NO_SYMBOLS = bytes(set(range(256)) - set(b"#*$%&|<>"))
_NO_UPPER = bytes(set(range(256)) - set(range(65, 91)))
_NO_LETTERS = bytes(set(range(128)) - set(range(65, 91)) - set(range(97, 123))) + bytes(range(128, 256))
_CONTINUATION = bytes(range(0x80, 0xC0))


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of one whole text, in the order of ``COUNTS``.

    A word is a run of characters other than blank, tab, \\n, \\v, \\f and \\r, so the work
    is done on UTF-8 bytes, whose split has just these separators.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return (0,) * len(COUNTS)
    seen: set[bytes] = set()
    dup = 0
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    place: dict[bytes, int] = {}
    ids = np.fromiter((place.setdefault(w, len(place)) for w in words), np.int64, n)
    repeat = 0
    if n > 3:
        _, pair = np.unique(ids[:-1] * len(place) + ids[1:], return_inverse=True)
        _, which, times = np.unique(pair[:-1] * len(place) + ids[2:], return_inverse=True, return_counts=True)
        again = times[which] > 1
        marked = np.zeros(n, bool)
        marked[:-2] |= again
        marked[1:-1] |= again
        marked[2:] |= again
        repeat = int(marked.sum())
    letters = raw.translate(None, _NO_LETTERS)
    return (n, len(raw.translate(None, _BLANKS + _CONTINUATION)), len(raw.translate(None, _NO_SYMBOLS)), dup, repeat,
            len(letters.translate(None, _NO_UPPER)), len(letters), raw.count(b"!"), len(place),
            int((ids[1:] == ids[:-1]).sum()))


def _counts(texts: pa.Array) -> pa.Array:
    rows = [text_counts(t) for t in texts.to_pylist()]
    columns = np.array(rows, np.int64).reshape(len(rows), len(COUNTS)).T
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], list(COUNTS))


def with_statistics(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """Add struct ``name`` with the counts of each text."""
    return docs.withColumn(name, F.arrow_udf(_counts, COUNT_TYPE)(text))


def ratios(stats: str) -> list[Column]:
    """The columns that rules test, from the struct ``stats``."""
    def of(sql: str) -> Column:
        for c in sorted(COUNTS, key=len, reverse=True):
            sql = sql.replace(c, f"`{stats}`.`{c}`") if f"`{c}`" not in sql else sql
        return F.expr(sql)
    return [of(sql).alias(n) for n, sql in RATIOS.items()]


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float


Rule = tuple[Condition, ...]


def _holds(x: np.ndarray, names: list[str], rule: Rule) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        v = x[:, names.index(c.feature)]
        out &= (v > c.threshold) if c.above else (v <= c.threshold)
    return out


def _grow(x: np.ndarray, bad: np.ndarray, names: list[str], most: int, cuts: int) -> Rule:
    """Add the condition with the best information gain until no good row is covered."""
    rule: list[Condition] = []
    live = np.ones(len(x), bool)
    while len(rule) < most and bad[live].any() and not bad[live].all():
        p0, n0 = bad[live].sum(), live.sum()
        best, gain = None, 1e-9
        for j, name in enumerate(names):
            values = np.unique(np.quantile(x[live, j], np.linspace(0, 1, cuts + 1)))
            middles = (values[1:] + values[:-1]) / 2
            for t in middles:
                for above in (True, False):
                    hit = live & ((x[:, j] > t) if above else (x[:, j] <= t))
                    p, n = bad[hit].sum(), hit.sum()
                    if p:
                        g = p * (np.log2(p / n) - np.log2(p0 / n0))
                        if g > gain:
                            best, gain = Condition(name, above, float(t)), g
        if best is None:
            break
        rule.append(best)
        live &= _holds(x, names, (best,))
    return tuple(rule)


def _worth(x: np.ndarray, bad: np.ndarray, names: list[str], rule: Rule) -> float:
    hit = _holds(x, names, rule)
    p, n = bad[hit].sum(), (~bad[hit]).sum()
    return float(p - n) / max(1, p + n)


def fit(x: np.ndarray, bad: np.ndarray, names: list[str], *, least_precision: float = 0.97,
        most_rules: int = 12, most_conditions: int = 4, cuts: int = 32, seed: int = 7) -> list[Rule]:
    """Sequential covering: grow a rule on two thirds of the rows, drop its last conditions
    while that does not make it worse on the other third, keep it if enough of what it
    covers on that third is bad, remove what it covers, go on."""
    rng = np.random.default_rng(seed)
    rules: list[Rule] = []
    live = np.arange(len(x))
    while len(rules) < most_rules and bad[live].sum() >= 2:
        mix = rng.permutation(live)
        a, b = mix[: len(mix) * 2 // 3], mix[len(mix) * 2 // 3:]
        rule = _grow(x[a], bad[a], names, most_conditions, cuts)
        if not rule:
            break
        while len(rule) > 1 and _worth(x[b], bad[b], names, rule[:-1]) >= _worth(x[b], bad[b], names, rule):
            rule = rule[:-1]
        proof = _holds(x[b], names, rule)
        if not proof.any() or bad[b][proof].mean() < least_precision:
            break
        rules.append(rule)
        live = live[~_holds(x[live], names, rule)]
    return rules


def learn(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", label: str = "quality",
          stats: str | None = None, text: str = "text", sample_rows: int = 20_000, seed: int = 7,
          **options: float) -> list[Rule]:
    """Rules for bad documents (label 0) from at most about ``sample_rows`` labelled rows.

    The sample is drawn from the labels by a hash of the key, so only its ids, a bounded
    number, are broadcast; ``stats`` names a column made by ``with_statistics``.
    """
    own, good = free_names(docs, "key_", "good_")
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias(own)).agg(
        F.min(F.col(label).cast("int")).alias(good))
    n = known.count()
    if n > sample_rows:
        keep = int(sample_rows / n * 1_000_000)
        known = known.where(F.pmod(F.xxhash64(F.lit(seed), F.col(own)), F.lit(1_000_000)) < keep)
    sample = docs.select(key, text if stats is None else stats).join(F.broadcast(known), F.col(key) == F.col(own))
    if stats is None:
        sample = with_statistics(sample.select(F.col(good).alias("good_"), F.col(text).alias("text_")), "stats_", "text_")
        good, stats = "good_", "stats_"
    rows = sample.select(good, *ratios(stats)).collect()
    if not rows:
        return []
    data = np.array([list(r) for r in rows], np.float64)
    bad = data[:, 0] == 0
    if bad.all() or not bad.any():
        return []
    return fit(data[:, 1:], bad, list(RATIOS), seed=seed, **options)


def verdict(rules: list[Rule], stats: str) -> Column:
    """True where no rule fires, as an ordered conditional expression."""
    by_name = dict(zip(RATIOS, ratios(stats)))
    out = None
    for rule in rules:
        test = F.lit(True)
        for c in rule:
            test &= (by_name[c.feature] > c.threshold) if c.above else (by_name[c.feature] <= c.threshold)
        out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed(stats: str) -> Column:
    n, r = F.col(f"`{stats}`.n_words"), F.col(f"`{stats}`.n_repeat_words")
    return (n < 50) | (100 * r > 50 * n)


def describe(rules: list[Rule]) -> list[str]:
    """The list as text, one rule a line."""
    return [" and ".join(f"{c.feature} {'>' if c.above else '<='} {c.threshold:.6g}" for c in rule) for rule in rules]
