"""Long texts, many spans, repeated and clashing input, and the dealt step of an operator
against a plain version of it."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import bpe, embedding_lsh, interleave, ngram_join, packing, pii, preferences, quality_rules
from tests.llm.test_tokens import WORDS


def test_personal_data_in_a_text_of_many_spans(spark):
    """100,000 spans: found, merged and replaced in time linear in their number."""
    part = "é mail a.b@c.de or 10.0.0.1, pay 4111 1111 1111 1111 or call +1 (017) 555-7713; "
    docs = spark.createDataFrame([(1, part * 25_000), (2, part), (3, "")], "doc_id bigint, text string")
    found = pii.with_spans(docs, None, "b", "x").orderBy("doc_id").select("b").collect()
    assert [len(r.b) for r in found] == [100_000, 4, 0]
    once = [(s.start, s.k, s.end) for s in found[1].b]
    assert [(s.start, s.k, s.end) for s in found[0].b[-4:]] == [
        (a + len(part) * 24_999, k, b + len(part) * 24_999) for a, k, b in once]
    out = [r.text for r in pii.redact(docs, None).orderBy("doc_id").collect()]
    assert out == ["é mail [EMAIL] or [IP], pay [CARD] or call [PHONE]; " * 25_000, out[0][:len(out[1])], ""]


def test_redaction_joins_overlapping_spans(spark):
    r = random.Random(3)
    rows = []
    for i in range(120):
        text = "".join(r.choices("ab é漢😀", k=r.choice([5, 40, 5000, 9000])))
        spans = []
        for _ in range(r.randrange(6)):
            a = r.randrange(len(text))
            spans.append((a, r.randrange(5), min(len(text), a + r.randrange(1, 20))))
        rows.append((i, text, spans))
    df = spark.createDataFrame(rows, "i int, text string, s array<struct<start:bigint,k:int,end:bigint>>")
    got = {r.i: r.o for r in df.select("i", pii.redacted(F.col("text"), F.col("s")).alias("o")).collect()}
    for i, text, spans in rows:
        out, at, end = "", 0, -1
        for a, k, b in sorted(spans):
            if a >= end:
                out, end = out + text[at:a] + f"[{pii.KINDS[k].upper()}]", b
            at = end = max(end, b)
        assert got[i] == out + text[at:]


def test_a_long_key_with_a_late_digit_is_a_candidate(spark):
    key = "Abcd" * 30 + "7"
    docs = spark.createDataFrame([(f'token = "{key}"',)], "text string")
    row = docs.select(pii._candidates(F.col("text")).alias("c")).first()
    assert [c.value for c in row.c if pii.KINDS[c.k] == "secret"] == [key]


def test_preferences_of_repeated_and_null_pairs(spark):
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "more"), (2, 0, "user", "q"), (2, 1, "assistant", "b")]
    made = spark.createDataFrame(turns, "conv_id bigint, turn int, role string, text string")
    once = spark.createDataFrame([(5, 1, 2, "x")], "pair_id bigint, chosen_id bigint, rejected_id bigint, side string")
    many = once.unionByName(once).unionByName(spark.createDataFrame([(None, 1, 2, "y")], once.schema))
    want = sorted(map(tuple, preferences.segments(made, once).collect()), key=str)
    assert sorted(map(tuple, preferences.segments(made, many).collect()), key=str) == want
    assert collections.Counter(r[1] for r in want) == {"prompt": 1, "chosen": 2, "rejected": 1}


def test_preferences_of_a_long_conversation(spark):
    turns = spark.range(20_000).select((F.col("id") % 2 + 1).alias("conv_id"), F.floor(F.col("id") / 2).alias("turn"),
                                       F.lit("user").alias("role"), F.when(F.col("id") < 19_999, "same").otherwise("last").alias("text"))
    pairs = spark.createDataFrame([(1, 1, 2)], "pair_id bigint, chosen_id bigint, rejected_id bigint")
    got = {r.part: r["count"] for r in preferences.segments(turns, pairs).groupBy("part").count().collect()}
    assert got == {"prompt": 9_999, "chosen": 1, "rejected": 1}


def labelled():
    r = random.Random(1)
    rows = []
    for i in range(300):
        words = ["".join(r.choices("abcdefgh", k=5)) for _ in range(r.randrange(20, 120))]
        rows.append((i, " ".join(w + "###" for w in words) if i % 3 == 0 else " ".join(words), int(i % 3 != 0)))
    return rows


def test_rules_with_clashing_columns_and_contradicting_labels(spark):
    rows = labelled()
    docs = spark.createDataFrame([(i, t, "k", "g", "s", "t") for i, t, _ in rows] + [(0, rows[0][1], "k", "g", "s", "t")] * 3,
                                 "doc_id bigint, text string, key_ string, good_ string, stats_ string, text_ string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(0, 1), (0, 0), (0, 1)], "doc_id bigint, quality int")
    rules = quality_rules.learn(docs, labels)
    assert rules
    judged = quality_rules.with_statistics(docs, "z").select("doc_id", quality_rules.verdict(rules, "z").alias("kept")).collect()
    assert all(r.kept == (r.doc_id % 3 != 0) for r in judged)
    stats = quality_rules.with_statistics(docs, "z")
    assert quality_rules.learn(stats, labels, stats="z")
    long = spark.createDataFrame([("w " * 2_000_000,)], "text string")
    row = quality_rules.with_statistics(long, "z").select("z.*").first()
    assert (row.n_words, row.n_repeat_words, row.word_chars) == (2_000_000, 2_000_000, 2_000_000)


def test_a_rule_is_kept_by_rows_it_was_not_grown_on():
    """Labels that nothing explains: rules that fit the rows they were grown on are not kept."""
    rng = np.random.default_rng(5)
    x, bad = rng.uniform(size=(900, 3)), rng.uniform(size=900) < 0.3
    assert quality_rules.fit(x, bad, ["a", "b", "c"]) == []
    rules = quality_rules.fit(x, (x[:, 1] > 0.8) & (x[:, 2] < 0.5), ["a", "b", "c"])
    own = np.zeros(900, bool)
    for rule in rules:
        own |= quality_rules._holds(x, ["a", "b", "c"], rule)
    want = (x[:, 1] > 0.8) & (x[:, 2] < 0.5)
    assert rules and (own & ~want).sum() <= 0.03 * own.sum() and (own & want).sum() > 0.8 * want.sum()


def plain_sum_of_squares(sizes, capacity):
    bins = []
    for s in sizes:
        counts = collections.Counter(capacity - sum(b) for b in bins if sum(b) < capacity)

        def squares(change):
            after = counts.copy()
            for gap, n in change.items():
                after[gap] += n
            return sum(n * n for gap, n in after.items() if 0 < gap < capacity)

        best = None
        for gap in sorted(g for g in counts if counts[g] and g >= s):
            cost = squares({gap: -1, gap - s: 1} if gap != s else {gap: -1})
            if best is None or cost < best[0]:
                best = (cost, gap)
        fresh = squares({capacity - s: 1})
        if best is not None and best[0] <= fresh:
            next(b for b in reversed(bins) if capacity - sum(b) == best[1]).append(s)
        else:
            bins.append([s])
    return bins


def test_sum_of_squares_places_each_piece_where_the_squares_are_least():
    r = np.random.default_rng(2)
    for capacity in (16, 64):
        sizes = r.integers(1, capacity + 1, 150)
        got = packing._sum_of_squares(sizes, capacity)
        want = plain_sum_of_squares(sizes.tolist(), capacity)
        shape = lambda bins: collections.Counter(sum(b) for b in bins)
        assert shape(got) == shape(want)


def test_interleaving_is_a_sort_by_fractional_rank(spark):
    """Sources of different sizes, so that each has the offset one half: the sequence is that of
    (rank + 1/2) / n, and every prefix has the mixture to within one row a source."""
    sizes = {"a": 500, "b": 120, "c": 31, "d": 7}
    rows = [(i, s) for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame([(k * 10 + "abcd".index(s), s) for k, s in rows], "doc_id bigint, source string")
    out = interleave.interleave(df, shards=5, rows_per_bucket=40).collect()
    order = [r.source for r in sorted(out, key=lambda r: (r.shard, r.slot))]
    want = sorted(((k + 0.5) / n, s) for s, n in sizes.items() for k in range(n))
    ties = collections.Counter(f for f, _ in want)
    assert all(a == b for a, (f, b) in zip(order, want) if ties[f] == 1)
    for at in range(len(order)):
        seen = collections.Counter(order[:at])
        assert all(abs(seen[s] - at * n / len(order)) <= 1.5 for s, n in sizes.items())


@pytest.mark.parametrize("cosine", [0.90, 0.92])
def test_recall_at_the_registered_setting(spark, cosine):
    """Planted pairs just at and a little above the threshold among unrelated vectors."""
    rng = np.random.default_rng(int(cosine * 100))
    base = rng.standard_normal((1500, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    side = rng.standard_normal(base.shape)
    side -= (side * base).sum(1)[:, None] * base
    side /= np.linalg.norm(side, axis=1)[:, None]
    near = (cosine + 1e-9) * base + np.sqrt(1 - (cosine + 1e-9) ** 2) * side
    rows = list(enumerate(np.concatenate([base, near]).tolist()))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r.component_id for r in embedding_lsh.near_duplicates(df, cosine=0.9).collect()}
    assert all(got[i] in (i, i - 1500) for i in got)
    assert np.mean([got[i + 1500] == i for i in range(1500)]) >= 0.95


def test_many_equal_vectors_and_clashing_columns(spark):
    rows = spark.range(3000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"),
                                    F.lit("x").alias("data"), F.lit(1).alias("node"), F.lit("y").alias("bytes"))
    got = embedding_lsh.near_duplicates(rows).agg(F.min("n_links"), F.max("n_links"), F.max("component_id"), F.count("*")).first()
    assert tuple(got) == (2999, 2999, 0, 3000)


def test_blocks_of_large_sets(spark, monkeypatch):
    """Blocks are cut by bytes: near copies above the bound are verified two by two."""
    from eventloom.llm import links
    monkeypatch.setattr(links, "BLOCK_BYTES", 1000)
    r = random.Random(4)
    base = ["".join(r.choices("abcdef", k=6)) for _ in range(120)]
    rows = [(i, " ".join([*base[:i], "x", *base[i:]]), "b") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, bytes string")
    assert {(r.n_links, r.component_id) for r in ngram_join.join(docs).collect()} == {(8, 0)}


def test_coding_of_odd_tables(spark):
    schema = "doc_id bigint, text string, d string, n_tokens string"
    none = spark.createDataFrame([], schema)
    assert none.select(bpe.digests("text", WORDS).alias("e")).count() == 0
    rows = [(1, None, "x", "y"), (1, None, "x", "y"), (2, "", "x", "y"), (3, "ab " * 300_000, "x", "y")]
    got = spark.createDataFrame(rows, schema).select("doc_id", bpe.digests("text", WORDS).alias("e")).select("doc_id", "e.n_tokens")
    assert sorted(map(tuple, got.collect())) == [(1, 0), (1, 0), (2, 0), (3, 300_000)]
    docs = spark.createDataFrame(rows, schema)
    out = packing.pack(packing.pieces(docs, WORDS)).groupBy("doc_id").agg(F.sum("length").alias("n"), F.count("*").alias("p"))
    assert sorted(map(tuple, out.collect())) == [(1, 2, 2), (2, 1, 1), (3, 300_001, 147)]
