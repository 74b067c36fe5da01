"""The pipeline's stages on the smallest tables, each against brute force on its own input."""

import collections
import zlib
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from eventloom.llm import pii
from eventloom.llm.common import stored, table
from tests.llm.test_pairs import expected
from tests.llm.test_texts import base_spans

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    names, seen = [name for name, _ in corpus_pipeline.STAGES], [docs]
    assert names == ["quality_rules", "ngram_join", "pii", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(stored(stage(spark, seen[-1], SF_DIR), f"test-{name}"))
        assert seen[-1].columns == docs.columns
    rows = [{r.doc_id: r for r in df.collect()} for df in seen]

    good = dict(table(spark, SF_DIR, "labels").select("doc_id", "quality").collect())
    # Of 87 labels few are bad, so a rare kind of junk may stay here; clean documents must.
    dropped = [i for i in good if i not in rows[1]]
    assert dropped and all(good[i] == 0 for i in dropped)
    assert all(rows[1][i] == rows[0][i] for i in rows[1])
    want = {i for i, (_, _, kept) in expected([(i, r.text) for i, r in rows[1].items()]).items() if kept}
    assert set(rows[2]) == want and all(rows[2][i] == rows[1][i] for i in rows[2])
    assert set(rows[3]) == set(rows[2])
    for i, r in rows[3].items():
        assert base_spans(r.text) == ""
        if r.text == rows[2][i].text:
            assert r == rows[2][i]
        else:
            assert r.n_chars == len(r.text) and any(f"[{k.upper()}]" in r.text for k in pii.KINDS)

    out = corpus_pipeline.STAGES[-1][1](spark, seen[-1], SF_DIR).collect()
    library, pieces = Tokenizer.from_file(corpus_pipeline.TOKENIZER), collections.Counter()
    for i, r in rows[3].items():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        for at in range(0, len(ids), 2048):
            own = np.array(ids[at:at + 2048], "<u4").tobytes()
            pieces[(i, at // 2048, at, len(own) // 4, zlib.crc32(own))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == pieces
    ran = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(ran) == sorted(out) and corpus_pipeline.ORACLE_SQL is None
