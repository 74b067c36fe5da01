"""Token files, BPE, packing and shards: round trips and exact comparisons."""

import collections
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventloom.llm import bpe, interleave, mph, packing, token_files, tokens

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id bigint, text string, k string, bucket string"


def texts(seed=1, n=300):
    r = random.Random(seed)
    letters = "abcdefghijklmnop'0123456789 .,!<>|  \n\tÄéßñΣσİ漢́\x1c\x85\xa0²"
    out = ["".join(r.choices(letters, k=r.randrange(80))) for _ in range(n)]
    return out + [None, "", " ", "  a  b ", "\n\n a", "a \n b", "<|endoftext|>x <|endoftext|> y", " <|endoftext|>", "x" * 3000,
                  "don't we'LL", "word " * 5000, "</w>", "a b  c", "<|startoftext|>Ab<|endoftext|>"]


@pytest.mark.parametrize("path, keeps, width", [(BYTES, True, 2), (WORDS, False, 4)])
@pytest.mark.parametrize("kept", [20_000, 10_000_000])
def test_chunks_give_the_library_s_ids(path, keeps, width, kept):
    library, own = Tokenizer.from_file(path), tokens.ChunkEncoder(path, keeps, width, kept)
    for part in tokens.slices(pa.array(texts() * 2 + ["Wörter, Zeichen!?\nund\nso.\n\nx"] * 3), 2_000):
        want = [e.ids for e in library.encode_batch([t or "" for t in part.to_pylist()], add_special_tokens=False)]
        assert [np.frombuffer(i, f"<u{width}").tolist() for i in own.encode(part)] == want


def test_backtracking_is_the_library(spark):
    library, own = Tokenizer.from_file(WORDS), bpe.word_bpe(WORDS)
    odd = texts(2, 1500)
    for t, raw in zip(odd, own.encode(odd), strict=True):
        ids = np.frombuffer(raw, "<u4")
        assert ids.tolist() == library.encode(t or "", add_special_tokens=False).ids
        assert own.decoder.decode(ids).decode() == library.decode(ids.tolist(), skip_special_tokens=False)
    df = spark.createDataFrame([("hello world",), (None,)], "text string")
    row = df.select(bpe.decoded(bpe.encoded("text", WORDS), WORDS).alias("d")).collect()
    assert [r.d for r in row] == [library.decode(library.encode("hello world", add_special_tokens=False).ids), ""]


def test_backtracking_with_overlapping_merges():
    merges = [("a", "a"), ("aa", "a"), ("b", "a"), ("aa", "aa"), ("a", "b"), ("ba", "b")]
    vocab = {t: i for i, t in enumerate(["a", "b", *dict.fromkeys(x + y for x, y in merges)])}

    def merged(text):
        out = list(text)
        while True:
            ranks = [(merges.index(p), i) for i, p in enumerate(zip(out, out[1:])) if p in merges]
            if not ranks:
                return [vocab[t] for t in out]
            _, i = min(ranks)
            out[i:i + 2] = [out[i] + out[i + 1]]

    own = bpe.Backtracker(vocab, merges)
    r = random.Random(0)
    for _ in range(2000):
        text = "".join(r.choices("ab", k=r.randrange(1, 14)))
        assert own.encode(text).tolist() == merged(text), text


def test_a_piece_of_megabytes():
    """Without a blank: it decodes to itself and begins as the library has it."""
    own = bpe.word_bpe(WORDS)
    half = "".join(random.Random(3).choices("etaoinshr", k=1_500_000))
    library = Tokenizer.from_file(WORDS)
    ids = np.frombuffer(own.encode([half])[0], "<u4")
    assert own.decoder.decode(ids).decode().replace(" ", "").replace("</w>", "") == half
    assert ids[:50_000].tolist() == library.encode(half[:200_000], add_special_tokens=False).ids[:50_000]


def test_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 2**63, 5000, np.uint64)
    own = mph.PerfectHash.from_bytes(mph.PerfectHash.build(keys).to_bytes())
    assert sorted(own.slots(keys)) == list(range(5000))
    assert len(mph.PerfectHash.build(keys[:0]).slots(keys[:3])) == 3
    with pytest.raises(ValueError):
        mph.PerfectHash.build(keys[[0, 0]])


def found(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS)
    folder = token_files.write(docs, BYTES, end_id=2, **options)
    return folder, token_files.entries(spark, folder)


def test_token_files_round_trip(spark):
    library = Tokenizer.from_file(BYTES)
    rows = [(i * 7 % 101, t) for i, t in enumerate(texts(3, 60))]
    folder, entries = found(spark, rows, shards=4)
    index, buckets = token_files.build_index(entries, keys_per_bucket=20)
    keys = entries.select("key", "copy").unionByName(spark.createDataFrame([(10**9, 0), (1, 99)], "key bigint, copy bigint"))
    looked = token_files.look_up(keys, index, buckets).collect()
    assert len(looked) == len(rows)
    shards = {int(r.path.rsplit("part-", 1)[1][:5]): token_files.Shard(bytes(r.content))
              for r in spark.read.format("binaryFile").load(folder).where("length(content) > 0").collect()}
    want = collections.defaultdict(list)
    for k, t in rows:
        want[k].append(library.encode(t or "", add_special_tokens=False).ids + [2])
    start = 0
    for r in sorted(looked, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
        want[r.key].remove(shards[r.shard].ids(r.shard_start, r.n_tokens).tolist())
    assert not any(want.values())
    order = [r.key for r in sorted(looked, key=lambda r: r.start)]
    assert order == sorted(order)


def test_ids_are_read_by_key(spark):
    """A text over several blocks, a key whose copies fill several shards, clashing columns."""
    library = Tokenizer.from_file(BYTES)
    long = " ".join(random.Random(2).choices(["alpha", "beta", "gamma,", "x1"], k=900_000))
    rows = [(1, long), (7, "a b c"), *[(5, "copy of five")] * 400, (9, None)]
    folder, entries = found(spark, rows, shards=6)
    entries = entries.cache()
    assert entries.where("key = 5").select("shard").distinct().count() > 1
    assert sorted(r.copy for r in entries.where("key = 5").collect()) == list(range(400))
    index, buckets = token_files.build_index(entries)
    keys = spark.createDataFrame([(1, 0), (5, 399), (5, 0), (9, 0), (4, 0)], "key bigint, copy bigint")
    got = {(r.key, r.copy): r.ids for r in token_files.fetch(spark, folder, token_files.look_up(keys, index, buckets)).collect()}
    want = {k: library.encode(t, add_special_tokens=False).ids + [2]
            for k, t in (((1, 0), long), ((5, 399), "copy of five"), ((5, 0), "copy of five"), ((9, 0), ""))}
    assert len(want[1, 0]) * 2 > token_files.BLOCK and got == want
    entries.unpersist()


def test_token_files_of_odd_rows(spark):
    _, entries = found(spark, [(None, None), (5, "same"), (5, "same"), (5, "other")])
    got = sorted((r.key, r.copy, r.n_tokens) for r in entries.collect())
    assert got == [(token_files.NULL_KEY, 0, 1), (5, 0, 2), (5, 1, 2), (5, 2, 2)]
    _, entries = found(spark, [])
    index, buckets = token_files.build_index(entries)
    assert entries.count() == 0 and token_files.look_up(entries, index, buckets).count() == 0


def test_file_place_and_blocks():
    ids = np.arange(3 * token_files.BLOCK // 2, dtype="<u2")
    raw = ids.tobytes()
    full = len(raw) // token_files.BLOCK * token_files.BLOCK
    body = b"".join(raw[i:i + token_files.BLOCK] + b"\n" for i in range(0, full, token_files.BLOCK)) + raw[full:]
    entry = np.array([(1, len(ids))], [("key", "<i8"), ("n", "<u8")]).tobytes()
    shard = token_files.Shard(body + entry + struct.pack(token_files.FOOT, len(raw), 1, 2, b"TOKENS1") + b"\n")
    assert (shard.ids(0, len(ids)) == ids).all()
    for start in (0, 5, token_files.BLOCK // 2, len(ids) - 1):
        at = token_files.file_place(start, 2)
        assert body[at:at + 2] == raw[2 * start:2 * start + 2]


def checked(histogram, capacity, most):
    plan = packing.plan(histogram, capacity, most)
    held = collections.Counter()
    for pattern, times in plan:
        assert sum(pattern) <= capacity
        for s in pattern:
            held[s] += times
    assert held == collections.Counter({s: n for s, n in histogram.items() if n})
    return sum(times for _, times in plan)


def test_plan_holds_all_and_wastes_little():
    r = random.Random(4)
    sizes = collections.Counter(min(256, int(r.expovariate(1 / 60)) + 1) for _ in range(20_000))
    least = -(-sum(s * n for s, n in sizes.items()) // 256)
    assert checked(dict(sizes), 256, 10**6) <= 1.005 * least
    assert checked(dict(sizes), 256, 2_000) <= 1.03 * least
    assert checked({256: 5, 200: 3}, 256, 10) == 8 and checked({}, 256, 10) == 0
    assert packing.places([])["length"].size == 0


def test_packing(spark):
    library = Tokenizer.from_file(WORDS)
    rows = list(enumerate(texts(5, 120))) + [(3, "same"), (3, "same"), (None, "x")]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS)
    out = packing.pack(packing.pieces(docs, WORDS, capacity=64), capacity=64, plan_items=50).collect()
    want = collections.Counter()
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        for i in range(0, len(ids), 64):
            own = np.array(ids[i:i + 64], "<u4").tobytes()
            want[(d, i // 64, i, len(own) // 4, zlib.crc32(own))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    bins = collections.defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(packing.pieces(docs.limit(0), WORDS)).count() == 0
    with_ids = packing.pieces(docs.where("doc_id = 0"), WORDS, capacity=64, with_ids=True).orderBy("piece").collect()
    assert sum((list(r.ids) for r in with_ids), []) == library.encode(rows[0][1], add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("n", [0, 3, 1000])
def test_shards_match_the_mixture(spark, n):
    r = random.Random(6)
    rows = [(i, r.choice(["hot"] * 6 + ["b", "c", None, f"rare{i}"]), "t", "h") for i in range(n)]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, bucket string, rank_ string")
    out = interleave.interleave(df, shards=8, rows_per_bucket=100)
    got = out.collect()
    assert out.columns == [*df.columns, "shard", "slot"]
    assert sorted((x.doc_id, x.source or "") for x in got) == sorted((x[0], x[1] or "") for x in rows)
    sizes = collections.Counter(x.shard for x in got)
    whole = [sizes[i] for i in range(8)]
    assert max(whole) - min(whole) <= 1
    for i in range(8):
        assert sorted(x.slot for x in got if x.shard == i) == list(range(sizes[i]))
    for source in ("hot", "b", "c", None):
        each = collections.Counter(x.shard for x in got if x.source == source)
        if n == 1000:
            assert max(each.values()) - min(each[i] for i in range(8)) <= 2
    again = {(x.doc_id, x.shard, x.slot) for x in interleave.interleave(df.repartition(3), shards=8, rows_per_bucket=100).collect()}
    assert again == {(x.doc_id, x.shard, x.slot) for x in got}


def test_shards_replace_their_columns(spark):
    df = spark.createDataFrame([(1, "a", 5)], "doc_id bigint, source string, shard int").withColumn("slot", F.lit("x"))
    assert [tuple(r) for r in interleave.interleave(df).collect()] == [(1, "a", 0, 0)]
