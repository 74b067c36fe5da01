"""Personal data: base patterns, and further candidates chosen by boosted trees.

The base patterns find emails, IP addresses, cards and phones, leftmost and without overlap
for each kind, and drop matches that fail their check.  Wider generators propose more spans,
which may overlap: numbers in card groups, dotted numbers, phone shapes, masked emails and
long keys.  Boosted trees judge them by form and context; a threshold for each kind,
calibrated on held-out candidates for a target precision, selects.  A selected candidate is
added unless it overlaps a base span or a better candidate.

No table labels personal data, so the trees learn from weak labels: a candidate counts as
positive if it passes the strict check of its kind on its own (see ``_strict``).  What they
add in practice is what the base patterns lose by their greed, such as two cards or a phone
and an address that only a blank parts, and keys.

Only SQL functions on texts, whole ones, without a shuffle; the driver sees a bounded sample
of candidates' features.  Patterns are written so that none tries a place twice: runs are
possessive, and a run is entered at its start only.

Cases: a null text counts as empty and has no spans; positions are code points, the end is
exclusive; repeated rows are judged alike; without candidates of both classes nothing is
added to the base.  Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm import boosting
from eventloom.llm.common import free_names

KINDS = ("email", "ip", "card", "phone", "secret")

# A run starts where the last match ended or where no such character stands before it.
_LOCAL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++"
BASE = {
    "email": _LOCAL + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WIDE = {
    "email": _LOCAL + r"(?:@| ?[\[(]at[\])] ?)[A-Za-z0-9-]++(?:(?:\.| ?[\[(]dot[\])] ?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9.])[0-9]++(?:\.[0-9]++)++",
    "card": r"(?<![0-9])(?:[0-9]{4}(?:[ -][0-9]{4}){2,3}(?:[ -][0-9]{1,4})?|[0-9]{7,19}+)(?![0-9])",
    "phone": r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
             r"|(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{12,}+=*+",
}
_ANY = r"[0-9@]|[\[(]at[\])]"
_SPAN = "array<struct<start:bigint,end:bigint,value:string,before:string,after:string>>"
_CONTEXT = 24

FEATURES = ("kind", "size", "digits", "letters", "groups", "longest", "dots", "parts_ok", "luhn", "plus", "brackets",
            "hexes", "upper", "keyed", "named", "quoted", "version", "joined")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


_STEP = 256


def _blocks(a: Column) -> Column:
    """The numbers of an array's blocks of ``_STEP`` elements: folds go block by block, so that
    a long array is not copied for each of its elements."""
    return F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(a) - 1) / _STEP)).cast("int"))


def _block(a: Column, b: Column) -> Column:
    return F.slice(a, b * _STEP + 1, _STEP)


def _running(values: Column, combine: Callable[[Column, Column], Column] = lambda x, y: x + y) -> Column:
    """Running sums (or maxima) of an array of numbers from 0 on."""
    zero = F.lit(0).cast("bigint")

    def last(a: Column) -> Column:
        return F.coalesce(F.get(a, F.size(a) - 1), zero)

    def folded(a: Column) -> Column:
        return F.aggregate(a, F.array().cast("array<bigint>"), lambda acc, x: F.concat(acc, F.array(combine(last(acc), x))))

    def whole(parts: Column) -> Column:
        return _let(folded(F.transform(parts, last)), lambda ends: F.flatten(F.transform(
            parts, lambda part, i: F.transform(part, lambda v: combine(v, F.coalesce(F.get(ends, i - 1), zero))))))

    return _let(values, lambda a: _let(F.transform(_blocks(a), lambda b: folded(_block(a, b))), whole))


def _matches(text: Column, pattern: str) -> Column:
    """All matches of a pattern with their places and what stands around them."""
    def spans(found: Column) -> Column:
        return _let(F.split(text, F.lit(pattern), -1), lambda between: _let(
            _running(F.transform(found, lambda m, i: (F.length(F.get(between, i)) + F.length(m)).cast("bigint"))),
            lambda ends: F.transform(found, lambda m, i: F.struct(
                (F.get(ends, i) - F.length(m)).alias("start"), F.get(ends, i).alias("end"), m.alias("value"),
                F.right(F.get(between, i), F.lit(_CONTEXT)).alias("before"),
                F.left(F.get(between, i + 1), F.lit(_CONTEXT)).alias("after")))))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return _let(found, lambda f: F.when(F.size(f) > 0, spans(f)).otherwise(F.array().cast(_SPAN)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(digits))), F.lit(0), add)
    return F.when(F.length(digits).between(1, 40), total % 10 == 0).otherwise(F.lit(False))


def _parts_ok(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike(
        "^(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))


def _base_check(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return _parts_ok(value)
    size = F.length(_digits(value))
    if kind == "card":
        return size.between(14, 19) & _luhn(_digits(value))
    return size.between(10, 15)


def _strict(c: Column) -> Column:
    """The weak label of a candidate with its features."""
    f = c["f"]
    return (F.when(f["kind"] == 0, c["value"].rlike(r"^[^@]+@[^.]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"))
            .when(f["kind"] == 1, (f["dots"] == 3) & (f["parts_ok"] == 1) & (f["version"] == 0))
            .when(f["kind"] == 2, f["digits"].between(13, 19) & (f["luhn"] == 1))
            .when(f["kind"] == 3, (f["plus"] == 1) & f["digits"].between(10, 15))
            .otherwise(((f["keyed"] == 1) & (f["size"] >= 16)) | ((f["hexes"] == f["size"]) & (f["size"] >= 32))))


def _features(kind: int, c: Column) -> Column:
    v, before = c["value"], c["before"]

    def yes(x: Column) -> Column:
        return F.when(x, 1.0).otherwise(0.0)

    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace(v, pattern, "")).cast("double")

    groups = F.split(F.regexp_replace(F.regexp_replace(v, "[^0-9]+", " "), "^ | $", ""), " ")
    values = {
        "kind": F.lit(float(kind)), "size": F.length(v).cast("double"), "digits": left("[^0-9]"),
        "letters": left("[^A-Za-z]"), "groups": F.size(groups).cast("double"),
        "longest": F.array_max(F.transform(groups, F.length)).cast("double"), "dots": left(r"[^.]"),
        "parts_ok": yes(_parts_ok(v)), "luhn": yes(_luhn(_digits(v))), "plus": yes(v.startswith("+")),
        "brackets": left(r"[^()\[\]]"), "hexes": left("[^0-9A-Fa-f]"), "upper": left("[^A-Z]"),
        "keyed": yes(before.rlike(r"(?i)(?:token|key|secret|passw(?:or)?d|auth)[\"']? ?[=:] ?[\"']?$")),
        "named": yes(before.rlike(r"(?i)(?:phone|tel|call|fax|mail|card|ip|address)\W{0,3}$")),
        "quoted": yes(before.rlike("[\"']$")), "version": yes(before.rlike(r"(?i)(?:version|license|\bv|by|nc|sa)\W{0,2}$")),
        "joined": yes(before.rlike("[A-Za-z0-9]$") | c["after"].rlike("^[A-Za-z0-9]")),
    }
    return F.struct(*(values[n].alias(n) for n in FEATURES))


def _base(text: Column) -> Column:
    """Base spans as structs (start, k, end), sorted."""
    def kept(k: int, kind: str) -> Column:
        fine = F.filter(_matches(text, BASE[kind]), lambda c: _base_check(kind, c["value"]))
        return F.transform(fine, lambda c: F.struct(c["start"].alias("start"), F.lit(k).alias("k"), c["end"].alias("end")))

    return F.array_sort(F.concat(*(kept(k, kind) for k, kind in enumerate(BASE))))


def _candidates(text: Column) -> Column:
    def of(k: int, kind: str) -> Column:
        return F.transform(_matches(text, WIDE[kind]), lambda c: F.struct(
            c["start"].alias("start"), F.lit(k).alias("k"), c["end"].alias("end"), c["value"].alias("value"),
            _features(k, c).alias("f")))

    return F.concat(*(of(k, kind) for k, kind in enumerate(KINDS)))


@dataclass(frozen=True)
class Model:
    trees: boosting.Trees
    cuts: tuple[float, ...]  # for each kind; infinite ones select nothing


def learn(docs: DataFrame, *, text: str = "text", sample_docs: int = 20_000, most_candidates: int = 50_000,
          precision: float = 0.97, seed: int = 13) -> Model | None:
    """Fit on the candidates of about ``sample_docs`` documents, drawn by a hash of the text
    (fewer if the table is smaller), at most ``most_candidates``; a third is held out."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = docs.count()
    keep = 1_000_000 if n <= sample_docs else max(1, int(sample_docs / n * 1_000_000))
    c = F.col("c")
    rows = (docs.select(t.alias("t")).where(F.pmod(F.xxhash64(F.lit(seed), "t"), F.lit(1_000_000)) < keep)
            .where(F.col("t").rlike(_ANY)).select(F.explode(_candidates(F.col("t"))).alias("c"))
            .select(F.coalesce(_strict(c), F.lit(False)).cast("double").alias("y"), *(c["f"][f].alias(f) for f in FEATURES),
                    F.xxhash64(F.lit(seed), c["value"], c["start"]).alias("h"))
            .orderBy("h").limit(most_candidates).collect())
    if not rows:
        return None
    data = np.array([list(r)[:-1] for r in rows], np.float64)
    data = data[np.lexsort(data.T)]  # the order of rows must not matter
    data = data[np.random.default_rng(seed).permutation(len(data))]
    y, x = data[:, 0], data[:, 1:]
    if y.min() == y.max():
        return None
    held = np.arange(len(x)) % 3 == 0
    if len(x) < 30 or y[~held].min() == y[~held].max():
        held = np.zeros(len(x), bool)
    trees = boosting.fit(x[~held], y[~held], FEATURES)
    judged = held if held.any() else ~held
    margin = trees.margin(x[judged])
    cuts = []
    for k in range(len(KINDS)):
        own = x[judged][:, 0] == k
        cuts.append(boosting.threshold(margin[own], y[judged][own], precision) if own.any() else float("inf"))
    return Model(trees, tuple(cuts))


_OUT = "array<struct<start:bigint,k:int,end:bigint>>"
_STATE = "struct<out:array<struct<start:bigint,k:int,end:bigint>>,next:struct<start:bigint,k:int,end:bigint,m:double>,base_end:bigint>"

_STATES = _STATE.replace("out:array<struct<start:bigint,k:int,end:bigint>>", "outs:array<array<struct<start:bigint,k:int,end:bigint>>>")


def _added(base: Column, candidates: Column, model: Model) -> Column:
    """Selected candidates that overlap neither a base span nor a better candidate, by one
    pass over all spans in the order of their starts."""
    f = None

    def scored(c: Column) -> Column:
        margin = model.trees.expression(lambda name: c["f"][name])
        return F.struct(c["start"].alias("start"), c["k"].alias("k"), c["end"].alias("end"), margin.alias("m"))

    cuts = F.array(*(F.lit(x if np.isfinite(x) else 1e300) for x in model.cuts))
    chosen = F.filter(F.transform(candidates, scored), lambda c: c["m"] >= F.get(cuts, c["k"]))
    fixed = F.transform(base, lambda b: F.struct(b["start"].alias("start"), b["k"].alias("k"), b["end"].alias("end"),
                                                 F.lit(None).cast("double").alias("m")))

    def flushed(s: Column) -> Column:
        n = s["next"]
        own = F.array(F.struct(n["start"].alias("start"), n["k"].alias("k"), n["end"].alias("end")))
        return F.when(n.isNull(), s["out"]).otherwise(F.concat(s["out"], own))

    def state(out: Column, following: Column, base_end: Column) -> Column:
        return F.struct(out.alias("out"), following.alias("next"), base_end.alias("base_end")).cast(_STATE)

    none = F.lit(None).cast("struct<start:bigint,k:int,end:bigint,m:double>")

    def step(s: Column, c: Column) -> Column:
        n = s["next"]
        meets = n.isNotNull() & (c["start"] < n["end"])
        on_base = state(F.when(meets, s["out"]).otherwise(flushed(s)), none, F.greatest(s["base_end"], c["end"]))
        on_candidate = (F.when(c["start"] < s["base_end"], s)
                        .when(meets, state(s["out"], F.when(c["m"] > n["m"], c).otherwise(n), s["base_end"]))
                        .otherwise(state(flushed(s), c, s["base_end"])))
        return F.when(c["m"].isNull(), on_base).otherwise(on_candidate)

    def gathered(outs: Column, s: Column) -> Column:
        return F.struct(outs.alias("outs"), s["next"].alias("next"), s["base_end"].alias("base_end")).cast(_STATES)

    def over_blocks(spans: Column) -> Column:
        def block(s: Column, b: Column) -> Column:
            within = F.aggregate(_block(spans, b), state(F.array().cast(_OUT), s["next"], s["base_end"]), step)
            return _let(within, lambda t: gathered(F.concat(s["outs"], F.array(t["out"])), t))

        def finished(s: Column) -> Column:
            return F.flatten(F.concat(s["outs"], F.array(flushed(state(F.array().cast(_OUT), s["next"], s["base_end"])))))

        empty = gathered(F.array().cast(f"array<{_OUT}>"), state(F.array().cast(_OUT), none, F.lit(0).cast("bigint")))
        return F.aggregate(_blocks(spans), empty, block, finished)

    return _let(F.array_sort(F.concat(fixed, chosen)), over_blocks)


def with_spans(docs: DataFrame, model: Model | None, base: str, added: str, *, text: str = "text") -> DataFrame:
    """Add the base spans and the added ones, each an array of (start, k, end) by start, with
    k the number of the kind in ``KINDS``."""
    t = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast(_OUT)
    any_, = free_names(docs, "any_")
    out = docs.withColumn(any_, t.rlike(_ANY)).withColumn(
        base, F.when(F.col(any_), _base(t).cast(_OUT)).otherwise(none))
    extra = none if model is None else F.when(F.col(any_), _added(F.col(base), _candidates(t), model)).otherwise(none)
    return out.withColumn(added, extra).drop(any_)


def listed(spans: Column) -> Column:
    """``kind:start:end``, joined by commas, by start and kind."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["k"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become
    one, named after the first."""
    names = F.array(*map(F.lit, KINDS))

    def merged(a: Column, ends: Column) -> Column:
        """Stretches (start, k, end); ``ends`` are the highest ends up to each span."""
        opens = F.filter(F.sequence(F.lit(0), F.size(a) - 1),
                         lambda i: (i == 0) | (F.get(a, i)["start"] >= F.get(ends, i - 1)))
        return _let(opens, lambda firsts: F.transform(firsts, lambda f, j: F.struct(
            F.get(a, f)["start"].alias("start"), F.get(a, f)["k"].alias("k"),
            F.get(ends, F.coalesce(F.get(firsts, j + 1), F.size(a)) - 1).alias("end"))))

    def cut(parts: Column, pages: Column) -> Column:
        def before(s: Column, i: Column) -> Column:
            start = F.coalesce(F.get(parts, i - 1)["end"], F.lit(0))
            return F.concat(_stretch(pages, start, s["start"]), F.lit("["), F.upper(F.get(names, s["k"])), F.lit("]"))

        end = F.get(parts, F.size(parts) - 1)["end"]
        return F.concat(F.array_join(F.transform(parts, before), ""), _stretch(pages, end, F.length(text).cast("bigint")))

    def whole(a: Column) -> Column:
        ends = _running(F.transform(a, lambda s: s["end"]), F.greatest)
        return _let(ends, lambda e: _let(merged(a, e), lambda parts: _let(_pages(text), lambda pages: cut(parts, pages))))

    return F.when(F.size(spans) > 0, _let(F.array_sort(spans), whole)).otherwise(text)


_PAGE = 4096


def _pages(text: Column) -> Column:
    """A text in stretches of ``_PAGE`` code points, so that a place is found without a search
    from the beginning of the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PAGE}}}"), F.lit(0))


def _stretch(pages: Column, start: Column, end: Column) -> Column:
    """Code points from ``start`` up to ``end``."""
    def number(c: Column) -> Column:
        return F.floor(c / _PAGE).cast("int")

    def inside(c: Column) -> Column:
        return (c % _PAGE).cast("int")

    first, last = number(start), number(end)
    own, final = F.coalesce(F.get(pages, first), F.lit("")), F.coalesce(F.get(pages, last), F.lit(""))
    between = F.array_join(F.slice(pages, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    return (F.when(first == last, F.substring(own, inside(start) + 1, (end - start).cast("int")))
            .otherwise(F.concat(F.substring(own, inside(start) + 1, F.lit(_PAGE)), between,
                                F.substring(final, F.lit(1), inside(end)))))


def redact(docs: DataFrame, model: Model | None, *, text: str = "text", size: str | None = None) -> DataFrame:
    """Documents with all spans redacted; ``size`` names a column with the length of the text,
    which follows.  Texts without spans stay as they are, null ones too."""
    base, added, spans = free_names(docs, "base_", "added_", "spans_")
    out = with_spans(docs, model, base, added, text=text).withColumn(spans, F.concat(base, added))
    out = out.withColumn(text, redacted(F.col(text), F.col(spans)))
    if size is not None:
        kind = dict(docs.dtypes)[size]
        out = out.withColumn(size, F.when(F.size(spans) > 0, F.length(text).cast(kind)).otherwise(F.col(size)))
    return out.drop(base, added, spans)
