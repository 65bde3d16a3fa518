"""Rendezvous (highest random weight) sharding of records by a stable key.

Every (key, shard) pair gets a uniform number u from one 64-bit hash; the
record goes to the shard with the smallest -ln(u) / weight. That choice only
compares the record with each shard, so adding a shard moves exactly the
records that the new shard wins, and a shard's share is proportional to its
weight. The law is ``key``: the key and the shard list alone decide.

All steps are built-in expressions. Slots (a gapless number inside each
shard) come from prefix sums: rows with the same key, size and checksum are
interchangeable and are first counted together with map-side aggregation, so
one key holding a third of all rows becomes one row; distinct keys are dealt
over hash buckets and ranked inside (shard, bucket); the offsets come from
about ``SLOT_GROUPS`` totals, a bound that holds at any input size, so they
are broadcast. The counted keys are written once and read by both branches.

Null keys are one key of their own (the empty one); null texts have size 1
and checksum 0; empty tables give empty results; repeated rows get slots of
their own; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallystar.session import cut_lineage
from tallystar.sources.testdata import read_table

SLOT_GROUPS = 1 << 15     # (shard, bucket) groups; at most one per shard more
SHARDS = 8


def shard_of(key: Column, weights: list[float]) -> Column:
    """The winning shard of each key under rendezvous hashing."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    text = F.coalesce(key.cast("string"), F.lit(""))
    best = None
    for shard, weight in enumerate(weights):
        # 52 bits, moved off zero: every value is an exact double below 1.
        u = (F.shiftrightunsigned(F.xxhash64(text, F.lit(shard)), 12) + F.lit(0.5)) / F.lit(float(1 << 52))
        pair = F.struct((-F.ln(u) / F.lit(float(weight))).alias("cost"), F.lit(shard).alias("shard"))
        best = [pair] if best is None else [*best, pair]
    return F.array_min(F.array(*best))["shard"]


def assign(records: DataFrame, key: str, text: str, weights: list[float]) -> DataFrame:
    """key, size, text_crc32, shard, slot and the shard under one more shard
    of the mean weight (grown_shard); one row per record."""
    more = [*weights, sum(weights) / len(weights)]
    buckets = max(1, SLOT_GROUPS // len(weights))
    rows = records.select(
        F.col(key).alias("key"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long").alias("crc"))
    alike = cut_lineage(
        rows.groupBy("key", "size", "crc").agg(F.count("*").alias("copies"))
        .withColumn("shard", shard_of(F.col("key"), weights))
        .withColumn("bucket", F.pmod(F.xxhash64("key", "size", "crc"), F.lit(buckets)).cast("int")))
    inside = W.partitionBy("shard", "bucket").orderBy("key", "size", "crc")
    ranked = alike.withColumn("before", F.sum("copies").over(inside.rowsBetween(W.unboundedPreceding, -1)))
    totals = alike.groupBy("shard", "bucket").agg(F.sum("copies").alias("n"))
    offsets = totals.select(
        "shard", "bucket",
        F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("bucket")
                                   .rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    first = F.col("offset") + F.coalesce(F.col("before"), F.lit(0))
    return (ranked.join(F.broadcast(offsets), ["shard", "bucket"])
            .select("key", "size", "crc", "shard",
                    F.explode(F.sequence(first, first + F.col("copies") - 1)).alias("slot"))
            .select("key", "size", F.col("crc").alias("text_crc32"), "shard", "slot",
                    shard_of(F.col("key"), more).alias("grown_shard")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assign(read_table(spark, sf_dir, "documents"), "doc_id", "text", [1.0] * SHARDS)
    return out.select(F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"),
                      F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
                      F.col("grown_shard").cast("int").alias("grown_shard"))
