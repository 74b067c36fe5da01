"""URL rules by a sort-merge range join.

A rule (host, path, verdict) fits its host and all subdomains where the path of the url
starts with the rule's; the longest fitting rule wins (code points of host and path, then
of the host).  Hosts become reversed keys (``com.example.www``); under each key a rule is
the interval of all paths that start with its own.  A url looks up the keys of its host at
the depths that rules have, and a sweep in path order keeps the stack of active rules: the
running sum of starts and ends is the depth of the stack, and its top is the last rule that
started at this depth.

Only SQL functions.  A key with many urls is salted, its rules are copied to each salt.
Cases: a null url or one without ``://`` has an empty host and path; repeated urls are
judged once; of repeated rules the blocking one stays; rules with nulls are left out; an
empty rule table gives every url the default.  Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import free_names, shuffle_partitions, stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(pages: DataFrame, host: str, path: str, url: str = "url") -> DataFrame:
    """Add the host (after ``://``, A-Z lower-cased) and the path of each url."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return (pages.withColumn(host, F.translate(raw, _UPPER, _LOWER))
            .withColumn(path, F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^([^?#]*)", 1)))


def _reversed_key(labels, depth):
    return F.array_join(F.reverse(F.slice(labels, F.size(labels) - depth + 1, depth)), ".")


def judge(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (null if none fits) and ``verdict`` to pages.

    Columns of these names that pages already has are replaced.
    """
    spark = pages.sparkSession
    pages = pages.drop("host", "path", "rule", "verdict")
    rules = (rules.where("host is not null and path is not null and verdict is not null")
             .groupBy(F.translate("host", _UPPER, _LOWER).alias("host"), "path").agg(F.max("verdict").alias("verdict")))
    depth = F.when(F.col("host") == "", 0).otherwise(F.size(F.split("host", r"\.")))
    rules = rules.withColumn("key", F.array_join(F.reverse(F.split("host", r"\.")), ".")).withColumn("depth", depth)
    depths = sorted(r[0] for r in rules.select("depth").distinct().collect())  # as many as labels in a host
    parted = with_parts(pages, "host", "path", url)
    if not depths:
        return parted.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))

    labels = F.split("host", r"\.")
    wanted = F.filter(F.array(*map(F.lit, depths)), lambda d: d <= F.size(labels))
    looked_up = (parted.select("host", "path").distinct()
                 .select("host", "path", F.explode(wanted).alias("depth"))
                 .withColumn("key", F.when(F.col("depth") == 0, "").otherwise(_reversed_key(labels, F.col("depth")))))
    asked = stored(looked_up.join(rules.select("key").distinct(), "key", "left_semi").select("key", "host", "path"),
                   "url-keys")

    # A key gets as many salts as it has shares of the rows that one partition should have.
    share = shuffle_partitions(spark)
    sizes = asked.groupBy("key").count()
    total = asked.count()
    salts = sizes.select("key", F.ceil(F.col("count") * share / max(1, total)).cast("int").alias("salts"))
    salted = F.pmod(F.xxhash64("host", "path"), F.col("salts"))

    raw = F.col("path").cast("binary")
    urls = asked.join(salts, "key").select(
        "key", salted.alias("salt"), raw.alias("at"), F.lit(1).alias("kind"), F.lit(0).alias("step"),
        "host", "path", F.lit(None).cast("struct<size:int,host_size:int,rule:string,verdict:string>").alias("rule"))
    rule = F.struct(F.length(F.concat("host", "path")).alias("size"), F.length("host").alias("host_size"),
                    F.concat("host", "path").alias("rule"), "verdict")
    copies = rules.join(salts, "key").select("key", "path", rule.alias("rule"),
                                             F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    # No UTF-8 text has the byte 0xFF, so with it the end comes after all that starts alike.
    ends = F.explode(F.array(F.struct(raw.alias("at"), F.lit(0).alias("kind"), F.lit(1).alias("step")),
                             F.struct(F.concat(raw, F.unhex(F.lit("FF"))).alias("at"), F.lit(2).alias("kind"),
                                      F.lit(-1).alias("step"))))
    events = copies.select("key", F.col("salt").cast("bigint").alias("salt"), ends.alias("e"), "rule").select(
        "key", "salt", "e.at", "e.kind", "e.step", F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"), F.when(F.col("e.kind") == 0, F.col("rule")).alias("rule"))
    order = ["at", "kind"]
    sweep = Window.partitionBy("key", "salt").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    level = Window.partitionBy("key", "salt", "level").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    swept = (urls.unionByName(events).withColumn("level", F.sum("step").over(sweep))
             .withColumn("top", F.last("rule", ignorenulls=True).over(level))
             .where("kind = 1 and level > 0"))
    best = swept.groupBy("host", "path").agg(F.max("top").alias("best"))
    name, = free_names(parted, "best_rule")
    best = best.withColumnRenamed("best", name)
    return (parted.join(best, ["host", "path"], "left")
            .withColumn("rule", F.col(name)["rule"])
            .withColumn("verdict", F.coalesce(F.col(name)["verdict"], F.lit(default))).drop(name))
