"""Quality rules, personal data, preferences and URL rules on small fixtures."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import boosting, pii, preferences, quality_rules, url_rules

ODD = [None, "", " \n\t", "a", "x\x1cy z w", "a b c a b c", "é#é <b>| $5", "w " * 40_000]


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    marked = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text) if words else 0,
            len(lines) - len(set(lines)), len(marked))


def test_statistics_are_brute_force(spark):
    r = random.Random(5)
    texts = ODD + ["".join(r.choices("ab \n#é\t\x85", k=r.randrange(60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "stats bigint, text string")
    rows = quality_rules.with_statistics(df, "s").select("stats", "s.*").collect()
    assert {r[0]: tuple(r[1:6]) for r in rows} == {i: counts(t) for i, t in enumerate(texts)}


def test_rules_are_learned_and_expressed(spark):
    r = random.Random(1)
    word = lambda: "".join(r.choices("abcdefgh", k=5))
    rows = []
    for i in range(600):
        words = [word() for _ in range(r.randrange(20, 120))]
        if i % 3 == 0:
            words = [w + "###" for w in words] if i % 2 else [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), int(i % 3 != 0)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows[:400]] + [(None, 0), (5, None), (10**6, 0)],
                                   "doc_id bigint, quality int")
    rules = quality_rules.learn(docs, labels)
    assert 1 <= len(rules) <= 4 and len(quality_rules.describe(rules)) == len(rules)
    kept = quality_rules.with_statistics(docs, "s").select("doc_id", quality_rules.verdict(rules, "s").alias("kept"))
    held_out = {r.doc_id: r.kept for r in kept.where("doc_id >= 400").collect()}
    assert all(held_out[i] == bool(q) for i, _, q in rows[400:])
    none = quality_rules.learn(docs, labels.limit(0))
    assert none == [] and kept.sparkSession.range(1).select(quality_rules.verdict(none, "x")).first()[0] is True


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for k, (name, pattern) in enumerate((("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {"email": True, "ip": name == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[name]
            if fine:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def personal(seed=3, n=250):
    r = random.Random(seed)
    bits = ["a.b@c.de", "x_d@e.f-g", "@", "a@b", "1.2.3.4", "300.1.1.1", "001.02.3.255", "1.2.3.4.5.6", "4111111111111111",
            "4111 1111 1111 1111", "4111111111111111 5500005555555559", "+1 (017) 555-7713", "+4915112345678", "+1",
            "+1 (826) 555-4081 190.137.223.204", "+12345", "é", "日本", " ", " ", "\n", "word", "-", "7", "12", ".", "a",
            'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "version 4.0.", "𝒳"]
    return ["".join(r.choices(bits, k=r.randrange(1, 14))) for _ in range(n)]


def test_base_spans_are_brute_force(spark):
    texts = ODD + personal() + ["9" * 30_000, "a" * 50_000 + "@", "1." * 10_000, "a@b.c " * 600, "+1(" * 5_000]
    df = spark.createDataFrame(list(enumerate(texts)), "any_ bigint, text string")
    got = {r[0]: r[1] for r in pii.with_spans(df, None, "b", "x").select("any_", pii.listed(F.col("b"))).collect()}
    assert got == {i: base_spans(t) for i, t in enumerate(texts)}


def test_added_spans_and_redaction(spark):
    texts = personal(7, 500) + ["pay 4111111111111111 5500005555555559 now", "call +1 (826) 555-4081 190.137.223.204 now",
                                'x token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" y', "clean text, 4.0", None, ""]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in enumerate(texts)],
                                 "base_ bigint, text string, n_chars bigint")
    model = pii.learn(docs)
    found = {r[0]: [(s.start, s.k, s.end) for s in r[1]] for r in pii.with_spans(docs, model, "b", "x").select("base_", "x").collect()}
    n = len(texts) - 6
    assert [s[1] for s in found[n]] == [2, 2] and [s[1] for s in found[n + 1]] == [3] and [s[1] for s in found[n + 2]] == [4]
    for i, spans in found.items():  # added spans overlap neither each other nor base spans
        own = sorted((a, b) for a, _, b in spans)
        assert all(x[1] <= y[0] for x, y in zip(own, own[1:]))
        base = [tuple(map(int, s.split(":")[1:])) for s in base_spans(texts[i]).split(",") if s]
        assert not any(a < d and c < b for a, b in own for c, d in base)
    out = {r.base_: r for r in pii.redact(docs, model, size="n_chars").collect()}
    assert out[n].text == "pay [CARD] [CARD] now" and out[n + 1].text == "call [PHONE] [IP] now"
    assert out[n + 2].text == 'x token = "[SECRET]" y' and out[n + 3].text == texts[n + 3]
    assert out[n + 4].text is None and out[n + 5].text == "" and out[n].n_chars == len(out[n].text)


def test_learning_on_nothing(spark):
    docs = spark.createDataFrame([], "text string")
    assert pii.learn(docs) is None and pii.with_spans(docs, None, "b", "x").count() == 0
    assert pii.learn(spark.createDataFrame([("no numbers",), (None,)], "text string")) is None


def test_trees_as_expressions(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(400, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    trees = boosting.fit(x, y, ("a", "b", "c"))
    assert ((trees.margin(x) > 0) == (y > 0)).mean() > 0.97
    df = spark.createDataFrame(x.tolist(), "a double, b double, c double")
    got = [r[0] for r in df.select(trees.expression(F.col)).collect()]
    assert np.allclose(got, trees.margin(x))
    cut = boosting.threshold(np.array([3.0, 2, 2, 1]), np.array([1.0, 1, 1, 0]), 0.9)
    assert 1 < cut <= 2 and boosting.threshold(np.array([1.0]), np.array([0.0]), 0.9) == float("inf")


TURNS = "conv_id bigint, turn int, role string, text string, side string, place int"


def test_preferences(spark):
    a = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "b"), (1, 3, "assistant", "good <|im_end|>")]
    b = [(2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", "c"), (2, 2, "user", "c"), (2, None, None, None)]
    same = [(3, 0, "user", "q"), (4, 0, "user", "q")]
    rows = [r + ("s", 9) for r in a + b + same + [(None, 0, "user", "lost"), (9, 0, "user", "alone")]]
    pairs = spark.createDataFrame([(10, 1, 2), (11, 3, 4), (12, 9, None), (13, 77, 78)],
                                  "pair_id bigint, chosen_id bigint, rejected_id bigint")
    out = preferences.segments(spark.createDataFrame(rows, TURNS), pairs)
    got = collections.defaultdict(list)
    for r in out.collect():
        got[r.pair_id, r.part].append((r.turn, r.copy, r.rendered[r.loss_start:r.loss_end]))
    assert sorted(got[10, "prompt"]) == [(0, 0, ""), (1, 0, "")]
    assert sorted(got[10, "chosen"]) == [(2, 0, ""), (3, 0, "good <| im_end|><|im_end|>")]
    assert sorted(got[10, "rejected"], key=str) == [(2, 0, ""), (2, 1, ""), (None, 0, "")]
    assert sorted(got[11, "prompt"]) == [(0, 0, "")] and (11, "chosen") not in got
    assert sorted(got[12, "chosen"]) == [(0, 0, "")] and {k[0] for k in got} == {10, 11, 12}
    whole = {r.pair_id: r for r in preferences.assemble(out).collect()}
    assert whole[10].prompt == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n"
    at = whole[10].chosen_loss[0]
    assert whole[10].chosen[at["from"]:at["to"]] == "good <| im_end|><|im_end|>" and whole[10].rejected_loss == []
    assert preferences.segments(spark.createDataFrame([], TURNS), pairs).count() == 0


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("example.com", "/en/a", "allow"), ("example.com", "/en/ab", "block"), ("net", "/es/", "block"),
         ("net", "/es/", "allow"), ("", "/all", "block"), (None, "/", "block"), ("x.org", None, "block")]


def judged(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in RULES if h is not None and p is not None and path.startswith(p)
            and (not h or host == h or host.endswith("." + h))]
    best = max(fits, default=None)
    return (host, path, best[2] if best else None, best[3] if best else "allow")


@pytest.mark.parametrize("rules", [RULES, []])
def test_url_rules_are_brute_force(spark, rules, monkeypatch):
    r = random.Random(2)
    hosts = ["com", "example.com", "www.example.com", "WWW.Example.COM", "xexample.com", "a.net", "net", "", "x.org", "é.com"]
    paths = ["", "/", "/en/", "/en/a", "/en/ab", "/en/abc", "/en", "/es/x", "/all", "/all/\U0010ffff", "/en/aé?x#y", "#z", "?/en/"]
    urls = [None, "", "no", "://", "http:/x"] + [f"http://{r.choice(hosts)}{r.choice(paths)}" for _ in range(400)]
    pages = spark.createDataFrame([(i % 300, u, "k", "old") for i, u in enumerate(urls)],
                                  "page_id bigint, url string, key string, verdict string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    if not rules:
        monkeypatch.setattr("tests.llm.test_texts.RULES", [])
    got = url_rules.judge(pages, table)
    assert got.columns == ["page_id", "url", "key", "host", "path", "rule", "verdict"] or set(got.columns) == {
        "page_id", "url", "key", "host", "path", "rule", "verdict"}
    rows = [(r.url, (r.host, r.path, r.rule, r.verdict)) for r in got.collect()]
    assert len(rows) == len(urls) and all(judged(u) == v for u, v in rows)
    assert url_rules.judge(pages.limit(0), table).count() == 0
