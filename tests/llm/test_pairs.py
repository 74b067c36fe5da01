"""N-gram join and embedding near-duplicates against brute force."""

import itertools
import random

import numpy as np
import pytest

from eventloom.llm import embedding_lsh, links, ngram_join
from eventloom.llm.common import components

DOCS = "doc_id bigint, text string, keys string, node string"


def reachable(nodes, pairs):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n
    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


def grams(text):
    words = (text or "").split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def expected(rows):
    sets = {i: grams(t) for i, t in rows if i is not None}
    pairs = [(a, b) for a, b in itertools.combinations(sorted(sets), 2)
             if sets[a] and len(sets[a] & sets[b]) * 5 >= 4 * len(sets[a] | sets[b])]
    component = reachable(sets, pairs)
    return {i: (sum(i in p for p in pairs), component[i], component[i] == i) for i in sets}


def near_copies(seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdef", k=6))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(r.choice((6, 40, 120)))]
        for _ in range(r.choice((1, 3, 9))):
            own = list(base)
            for _ in range(r.choice((0, 0, 1, 2, 4))):
                own[r.randrange(len(own))] = word()
            rows.append(" ".join(own))
    return list(enumerate(rows + rows[:5] + ["", None, "one two", "one two", "x", "long " * 30_000]))


@pytest.mark.parametrize("block", [256, 2])
def test_join_is_brute_force(spark, monkeypatch, block):
    rows = near_copies()
    find = links.find
    monkeypatch.setattr(links, "find", lambda *a: find(*a, block=block))
    docs = spark.createDataFrame([(i, t, "k", "n") for i, t in rows], DOCS)
    got = {r.doc_id: (r.n_links, r.component_id, r.kept) for r in ngram_join.join(docs).collect()}
    assert got == expected(rows)


def test_join_of_odd_tables(spark):
    assert ngram_join.join(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(None, "a b c d e f", None, None), (1, "a b c d e f", "", ""), (1, "a b c d e f", "", ""), (2, None, None, None)]
    got = sorted((r.doc_id or 0, r.n_links, r.component_id, r.kept)
                 for r in ngram_join.join(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [(0, 0, None, True), (1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]


def test_deduplicated_keeps_columns_and_one_of_each(spark):
    rows = [(i, t, "k", "n") for i, t in near_copies(2)]
    docs = spark.createDataFrame(rows, DOCS)
    left = ngram_join.deduplicated(docs)
    want = {i for i, (_, _, kept) in expected([(i, t) for i, t, _, _ in rows]).items() if kept}
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == want


def test_bands_reach_the_recall():
    for rows in (3, 5, 8):
        b = ngram_join.bands_for(0.8, 0.999, rows)
        assert 1 - (1 - 0.8 ** rows) ** b >= 0.999 > 1 - (1 - 0.8 ** rows) ** (b - 1)


def test_vectors_are_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((60, 16))
    near = base[:20] + 0.2 * rng.standard_normal((20, 16)) * np.linalg.norm(base[:20], axis=1)[:, None] / 4
    vectors = np.concatenate([base, near, base[:6], 3 * base[6:9]]).tolist()
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] * 16, [1.0] * 3]
    rows = list(enumerate(vectors + odd))
    x = np.array(vectors)
    x /= np.linalg.norm(x, axis=1)[:, None]
    hit = x @ x.T >= 0.9
    pairs = [(a, b) for a, b in zip(*np.nonzero(hit)) if a < b]
    component = reachable(range(len(rows)), pairs)
    df = spark.createDataFrame([(i, v, "d") for i, v in rows], "vec_id bigint, embedding array<double>, data string")
    got = {r.vec_id: r for r in embedding_lsh.near_duplicates(df, recall=0.999).collect()}
    for i in range(len(rows)):
        want = sum(i in p for p in pairs)
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (want, component[i], component[i] == i)


def test_vectors_of_odd_tables(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert embedding_lsh.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, [1.0, 2.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0])]
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept)
                 for r in embedding_lsh.near_duplicates(spark.createDataFrame(rows, schema)).collect())
    assert got == [(0, 0, None, True), (3, 1, 3, True), (3, 1, 3, True)]


def test_table_count_follows_the_recall():
    depth, tables = embedding_lsh.tables_for(100_000, 0.9, 0.97, 2.0)
    p = embedding_lsh.step_chance(np.sqrt(0.2), 2.0) ** depth
    assert 1 - (1 - p) ** tables >= 0.97
    rng = np.random.default_rng(0)  # the chance of a step, against a trial
    shift, gap = rng.uniform(0, 2, 200_000), rng.standard_normal(200_000) * 0.7
    assert abs(np.mean(np.floor(shift / 2) == np.floor((shift + gap) / 2)) - embedding_lsh.step_chance(0.7, 2.0)) < 0.01


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a bigint, b bigint"), "test").collect())
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}
