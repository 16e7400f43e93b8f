"""Sharding by a two-pass external shuffle (operator 9). DataFrame functions only.

First pass: every record is scattered by a seeded hash into a bucket of its shard; the number
of buckets makes one bucket fit in memory. Second pass: the records of a bucket are gathered,
put in a fixed order, Fisher-Yates shuffled (``shuffle``) and written. Places in a shard are
gapless: bucket sizes, summed over the few buckets of a shard, give each bucket its offset.

``shuffle`` draws from the seed and the number of its task. Buckets are therefore dealt to tasks
by their number, ``TASK_BUCKETS`` to a task on average, and taken in the order of their numbers: the
places depend on the records, the seed and the bucket size, not on the session's partitions.

The law is ``key``: a record's shard is the one with the largest seeded hash of (shard, id)
(rendezvous hashing). It depends on the id and the number of shards alone, and one more shard
can only win records for itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefspark.llm.common import materialize, shuffle_cleanup, text_of
from prefspark.session import scratch_path

BUCKET_BYTES = 16 << 20
TASK_BUCKETS = 4
RESULT = ("size", "text_crc32", "shard", "slot", "grown_shard")


def rendezvous(key: Column, shards: int, seed: int = 0) -> Column:
    """The shard whose seeded hash of the key is largest; null keys hash like one value."""
    bids = [F.struct(F.xxhash64(F.lit(f"{seed}/{s}"), key).alias("bid"), F.lit(s).alias("shard")) for s in range(shards)]
    return (F.greatest(*bids) if shards > 1 else bids[0])["shard"]


def shard_records(docs: DataFrame, shards: int = 8, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` plus ``size, text_crc32, shard, slot, grown_shard``, in shuffled order.

    A null text has size 1 and the CRC-32 of no bytes. Null ids go to one shard, spread over
    its buckets by their text; rows that agree in id and text share a bucket. An input column
    named like one of the added ones is replaced.
    """
    raw = text_of(text_col).cast("binary")
    own = [F.col(f"`{c}`") for c in docs.columns if c not in RESULT] or [F.lit(1).alias("_none")]
    rows = docs.select(
        F.struct(*own).alias("row"),
        (F.octet_length(raw) + 1).cast("bigint").alias("size"),
        F.crc32(raw).alias("crc"),
        F.col(id_col).alias("id"),
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, math.ceil(total / shards / bucket_bytes))
    placed = rows.select(
        "row", "size", "crc", "id",
        rendezvous(F.col("id"), shards, seed).alias("shard"),
        rendezvous(F.col("id"), shards + 1, seed).alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit(f"{seed}/bucket"), "id", "crc", "size"), F.lit(buckets)).alias("bucket"),
    )
    placed = placed.withColumn("bucket", F.col("shard").cast("bigint") * buckets + F.col("bucket"))
    sizes = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(sizes.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "bucket_offsets")
    record = F.struct("id", "crc", "size", "shard", "grown_shard", "row")
    tasks = max(1, -(-shards * buckets // TASK_BUCKETS))
    dealt = placed.repartition(tasks, "bucket")
    held = dealt.groupBy("bucket").agg(F.array_sort(F.collect_list(record), lambda a, b: _order(a, b)).alias("held"))
    held = held.join(offsets, "bucket").sortWithinPartitions("bucket")
    mixed = held.select("offset", F.posexplode(F.shuffle("held", F.lit(seed))).alias("i", "r")).withColumn("shard", F.col("r.shard"))
    return mixed.select("r.row.*", F.col("r.size").alias("size"), F.col("r.crc").alias("text_crc32"), "shard", (F.col("offset") + F.col("i")).alias("slot"), F.col("r.grown_shard").alias("grown_shard"))


def _order(a: Column, b: Column) -> Column:
    x, y = (F.struct(r["id"], r["crc"], r["size"]) for r in (a, b))
    return F.when(x < y, -1).when(x > y, 1).otherwise(0)


def write_shards(records: DataFrame, path: str) -> DataFrame:
    """Write sharded records, one folder per shard, and read them back."""
    spark = records.sparkSession
    with shuffle_cleanup(spark):
        records.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return spark.read.schema(records.schema).parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = write_shards(shard_records(docs, 8), scratch_path(spark, "shards"))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("bigint").alias("slot"), F.col("grown_shard").cast("int").alias("grown_shard"))
