"""The registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import (
    bpe, embedding_lsh, fill_middle, importance, interleave, ngram_join, packing, pii, preferences, quality_rules,
    secret_scan, token_files, url_rules,
)
from eventloom.llm.common import stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


@query("op1_ngram_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"), n=5, threshold=0.8)


@query("op3_embedding_lsh")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_lsh.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), cosine=0.9)


@query("op2_quality_rules")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = stored(quality_rules.with_statistics(docs, "stats").select("doc_id", "stats"), "quality-stats")
    rules = quality_rules.learn(stats, table(spark, sf_dir, "labels"), stats="stats")
    failed = quality_rules.base_failed("stats")
    return stats.select(
        "doc_id", *(F.col(f"stats.{c}").alias(c) for c in quality_rules.COUNTS[:5]),
        failed.alias("base_failed"), (~failed & quality_rules.verdict(rules, "stats")).alias("kept"))


@query("op7_interleave")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return interleave.interleave(docs, shards=40).select(
        "doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


@query("op4_token_files")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = token_files.write(docs, BYTE_BPE, end_id=2)
    found = stored(token_files.entries(spark, folder), "token-found")
    index, buckets = token_files.build_index(found)
    sums = found.select("shard", "shard_start", "ids_crc32")
    return token_files.look_up(found, index, buckets).join(sums, ["shard", "shard_start"]).select(
        F.nullif("key", F.lit(token_files.NULL_KEY)).alias("doc_id"), "start", "n_tokens", "ids_crc32", "shard",
        "shard_start")


@query("op6_backtracking_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", bpe.digests("text", WORD_BPE).alias("d")).select("doc_id", "d.*")


@query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(packing.pieces(docs, WORD_BPE, capacity=2048, end_id=0), capacity=2048)


@query("op5_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.with_spans(docs, pii.learn(docs), "base", "added")

    def count(k: int):
        return F.size(F.filter("base", lambda s: s["k"] == k)).cast("bigint")

    return found.select(
        "doc_id", *(count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.BASE)),
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.concat("base", "added")).alias("spans"))


PREFERENCE_SQL = """
WITH turns AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id, turn ORDER BY role NULLS FIRST, text NULLS FIRST) - 1 AS copy
  FROM conversations WHERE conv_id IS NOT NULL),
sided AS (SELECT CAST(floor(conv_id / 2) AS BIGINT) AS pair_id, conv_id % 2 AS side, * FROM turns),
spots AS (SELECT pair_id, turn, copy, count(*) = 2 AND count(DISTINCT (role, text)) = 1 AS same
          FROM sided GROUP BY ALL),
parting AS (SELECT pair_id, min(struct_pack(l := turn IS NULL, t := coalesce(turn, 0), c := copy)) AS p
            FROM spots WHERE NOT same GROUP BY 1),
placed AS (SELECT s.*, p IS NULL OR struct_pack(l := turn IS NULL, t := coalesce(turn, 0), c := copy) < p AS shared
           FROM sided s LEFT JOIN parting USING (pair_id)),
parts AS (SELECT *, '<|im_start|>' || replace(coalesce(role, ''), '<|im_', '<| im_') || chr(10) AS head,
                 replace(coalesce(text, ''), '<|im_', '<| im_') || '<|im_end|>' AS body,
                 NOT shared AND coalesce(role = 'assistant', false) AS counts
          FROM placed WHERE NOT shared OR side = 0)
SELECT pair_id, CASE WHEN shared THEN 'prompt' WHEN side = 0 THEN 'chosen' ELSE 'rejected' END AS part,
       turn, CAST(copy AS INTEGER) AS copy, role, head || body || chr(10) AS rendered,
       CAST(CASE WHEN counts THEN length(head) ELSE 0 END AS INTEGER) AS loss_start,
       CAST(CASE WHEN counts THEN length(head) + length(body) ELSE 0 END AS INTEGER) AS loss_end
FROM parts"""


@query("op9_preferences", PREFERENCE_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return preferences.segments(turns, preferences.neighbours(turns))


URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]

URL_SQL = """
WITH rules(rhost, rpath, rverdict) AS (VALUES {rules}),
cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
raw AS (SELECT page_id, rest, regexp_extract(rest, '^([^/?#]*)', 1) AS h FROM cut),
parts AS (SELECT page_id,
                 translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(substr(rest, length(h) + 1), '^([^?#]*)', 1) AS path FROM raw),
judged AS (SELECT p.*, (SELECT max(struct_pack(size := length(rhost || rpath), rule := rhost || rpath, v := rverdict))
                        FROM rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS best
           FROM parts p)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, best.rule AS rule,
       coalesce(best.v, 'allow') AS verdict
FROM judged""".format(rules=", ".join(str(r) for r in URL_RULES))


@query("op10_url_rules", URL_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


@query("op11_importance_resampling")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aim = table(spark, sf_dir, "benchmark").select("text")
    rows = importance.scored(docs, aim, most_words=1, buckets=10_000, seed=2024)
    return importance.draw(rows, percent=10, least_words=20).select(
        F.col("key").alias("doc_id"), "n_features", "weight", "score", "rank")


FILL_MIDDLE_SQL = """
WITH hashed AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
                FROM documents),
numbered AS (SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
                    CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
                    CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM hashed),
cut AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
               CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                         OR h3 % 100 >= 90 THEN 'plain'
                    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbered),
parts AS (SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix
          FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                        ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""


@query("op12_fill_middle", FILL_MIDDLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", fill_middle.digests("doc_id", "text").alias("d")).select("doc_id", "d.*")


@query("op13_secret_scan")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.with_spans(docs, "found")

    def of(*kinds: str):
        return F.filter("found", lambda s: s["kind"].isin(*kinds))

    base = secret_scan.KINDS[:3]
    return found.select(
        "doc_id", *(F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in base),
        F.sha2(secret_scan.listed(of(*base)), 256).alias("base_sha256"), secret_scan.listed("found").alias("spans"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
