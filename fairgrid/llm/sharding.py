"""Contiguous shards of near-equal byte size, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

N_SHARDS = 8


def shard_by_bytes(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32`` of ``docs`` with ``shard`` and ``slot``.

    Rows are put in doc_id order over range partitions; the partitions' totals
    give each its global offset, and a running sum inside a partition gives
    each row its place in bytes. A row belongs to the shard in which its middle
    byte falls, so shards are contiguous in doc_id order and differ from the
    target by less than the largest row at either end. ``slot`` counts from 0
    without gaps inside a shard. Texts never move: only ids, sizes and checks do,
    and only the totals (a row per partition) are broadcast.

    Size is the UTF-8 bytes of the text plus 1; null text has none, so size 1
    and the check of the empty text. Null ids come first. Repeated rows are rows of their own; a place in
    the scan breaks ties, so a very frequent id is spread over partitions. An
    empty table gives an empty result. Other columns are left out.
    """
    spark = docs.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), F.monotonically_increasing_id().alias("__at"))
    rows = cut(rows.repartitionByRange(n_parts, F.col("doc_id").asc_nulls_first(), "__at").withColumn("__part", F.spark_partition_id()))

    totals = rows.groupBy("__part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = F.broadcast(totals.select("__part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.sum("bytes").over(everything).alias("total")))

    inside = Window.partitionBy("__part").orderBy(F.col("doc_id").asc_nulls_first(), "__at")
    placed = (
        rows.withColumn("__run", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("__nth", F.row_number().over(inside))
        .join(offsets, "__part")
        .withColumn("__row", F.col("n0") + F.col("__nth") - 1)
        .withColumn("shard", F.expr(f"cast(least({n_shards - 1}, ((2 * (bytes0 + __run) - size) * {n_shards}) div (2 * total)) as int)"))
    )
    first = F.broadcast(placed.groupBy(F.col("shard").alias("__shard")).agg(F.min("__row").alias("__first")))
    return placed.join(first, F.col("shard") == F.col("__shard")).select("doc_id", "size", "text_crc32", "shard", (F.col("__row") - F.col("__first")).alias("slot"))
