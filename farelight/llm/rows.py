"""Rows that stay where they are while decisions about them come back.

Rows are written once, as a table bucketed by block, which are rows that stand next to each
other in one partition. A decision names a row by block and place. All kept places of a
block form one bitmap of at most 4 KB, and the join by block moves these and no rows, so
that the plan is the same whatever the size of the rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from farelight.session import scratch_path

#: Binary logarithm of the rows of a block; a bitmap of Spark's has 32,768 bits.
BLOCK_BITS = 12
#: Bytes of text per bucket, about.
BUCKET_BYTES = 12 << 20
BLOCK, PLACE = "_block", "_place"


def write_rows(df: DataFrame, text: str) -> DataFrame:
    """The rows with ``_block`` and ``_place``, written without a shuffle."""
    spark = df.sparkSession
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    # Partition number above, row number in the partition below.
    number = F.monotonically_increasing_id()
    numbered = df.withColumn(BLOCK, number).select(
        "*", F.col(BLOCK).bitwiseAND((1 << BLOCK_BITS) - 1).cast("int").alias(PLACE)
    )
    numbered = numbered.withColumn(BLOCK, F.shiftright(BLOCK, BLOCK_BITS))
    name, path = f"farelight_{uuid.uuid4().hex}", scratch_path(spark, "rows")
    # With fewer buckets than a shuffle has partitions Spark would rather move the rows.
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = int(max(8, shuffled, size // BUCKET_BYTES + 1))
    writer = numbered.write.format("parquet").bucketBy(min(buckets, _most(spark)), BLOCK)
    writer.option("path", path).saveAsTable(name)
    return spark.table(name)


def _most(spark) -> int:
    """Spark's own limit on buckets; beyond it a bucket holds more blocks, which one task streams through."""
    return int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))


def keep_rows(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows named by ``chosen`` (``_block, _place``), without these two columns."""
    kept = chosen.groupBy(F.col(BLOCK).alias("_of")).agg(F.bitmap_construct_agg(F.col(PLACE).cast("long")).alias("_kept"))
    byte = F.conv(F.hex(F.expr(f"substring(_kept, {PLACE} div 8 + 1, 1)")), 16, 10).cast("int")
    # Built from the bitmaps, streamed over the rows, which need not be sorted for it.
    joined = rows.join(kept.hint("shuffle_hash"), F.col(BLOCK) == F.col("_of"))
    return joined.filter(F.getbit(byte, F.col(PLACE) % 8) == 1).drop(BLOCK, PLACE, "_of", "_kept")
