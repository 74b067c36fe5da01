"""Proportional stratified interleaving of rows over shards.

Rows of each source are ranked by a seeded hash; a row's fractional rank is (rank + u) / n
with n the rows of its source and u in (0, 1) fixed by the source.  Sources of the same size
have evenly spaced u, so that many small ones are spread as well.  Rows sorted by it carry
the mixture of the sources at every point, and the sequence is cut into shards whose row
counts differ by one at most.

Ranks are made inside hash buckets with counts of the earlier ones added, so a source of any
size is spread over many tasks, and only ids, sizes and hashes are shuffled, no texts.
Cases: null sources are a stratum of their own; a null text is empty; rows that agree in key,
source and text may take each other's place; fewer rows than shards leave shards empty; an
empty table gives no rows.  Columns ``shard`` and ``slot`` are replaced, others pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import free_names, ranked, shuffle_partitions, stored

ROWS_PER_BUCKET = 50_000


def interleave(rows: DataFrame, *, key: str = "doc_id", source: str = "source", shards: int = 40,
               seed: int = 11, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 in each shard).

    Select what is to be carried first: all columns of ``rows`` are shuffled twice.
    """
    rows = rows.drop("shard", "slot")
    total = rows.count()
    buckets = max(shuffle_partitions(rows.sparkSession), -(-total // rows_per_bucket))
    stratum, h, bucket, rank, n, u, at, place, one = free_names(
        rows, "stratum_", "hash_", "bucket_", "rank_", "n_", "u_", "at_", "place_", "one_")
    keyed = (rows.withColumn(stratum, F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")))
             .withColumn(h, F.xxhash64(F.lit(seed), F.col(key), *(c for c in rows.columns if c != key)))
             .withColumn(bucket, F.pmod(h, F.lit(buckets))))
    in_source = ranked(keyed, stratum, [F.col(h), F.col(key)], bucket, rank)
    sizes = stored(keyed.groupBy(stratum).agg(F.count("*").alias(n)), "strata")
    hashed = F.xxhash64(F.lit(seed), F.col(stratum))
    strata = ranked(sizes.withColumn(bucket, F.pmod(hashed, F.lit(buckets))), n, [hashed, F.col(stratum)], bucket, rank)
    strata = strata.join(sizes.groupBy(n).count(), n).select(stratum, n, ((F.col(rank) + 0.5) / F.col("count")).alias(u))
    fraction = (in_source.drop(bucket).join(strata, stratum)
                .withColumn(at, (F.col(rank) + F.col(u)) / F.col(n))
                .withColumn(bucket, F.least(F.floor(F.col(at) * buckets), F.lit(buckets - 1)))
                .withColumn(one, F.lit(0)))
    placed = ranked(fraction, one, [F.col(at), F.col(stratum), F.col(h), F.col(key)], bucket, place)
    shard = F.expr(f"`{place}` * {shards} div {max(1, total)}")
    return (placed.withColumn("shard", shard.cast("int"))
            .withColumn("slot", F.expr(f"`{place}` - ((`shard` * {total}L + {shards - 1}) div {shards})"))
            .drop(stratum, h, bucket, rank, n, u, at, place, one))
