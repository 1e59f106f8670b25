"""Proportional stratified interleaving.

Rows are shuffled by a seeded hash of key and text and ranked within their stratum; the fractional rank spreads every stratum evenly over
[0, 1). All rows sorted by fractional rank and cut into equal runs give shards whose sizes differ by one row at most and
whose mixture is that of the whole.

No rank is computed by one task: the hash range (and later the range of fractional ranks) is cut into buckets of about
equal size, rows are numbered within their bucket, and running totals over the buckets give the offset. A stratum that
holds most rows is therefore spread over as many buckets as all rows need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.frames import stored, whole_text

#: Rows in a bucket, and the most buckets; beyond that many rows the buckets grow instead.
BUCKET_ROWS = 4096
MOST_BUCKETS = 65_536


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text plus one for its separator; a null text has none."""
    return (F.octet_length(whole_text(text)) + 1).cast("long")


def stratum_of(column: str) -> Column:
    """Null is a stratum of its own, apart from the empty string."""
    value = F.col(column).cast("string")
    return F.when(value.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), value))


def numbered(df: DataFrame, group: list[str], bucket: str, order: list, name: str) -> DataFrame:
    """``name``: place of each row in its ``group`` by bucket, then by ``order``; from 0."""
    within = Window.partitionBy(*group, bucket)
    sizes = df.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*group) if group else Window.partitionBy()
    before = before.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, bucket, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    placed = df.withColumn("_place", F.row_number().over(within.orderBy(*order)) - 1)
    joined = placed.join(starts, [*group, bucket])
    return joined.withColumn(name, (F.col("_start") + F.col("_place")).cast("long")).drop("_start", "_place", bucket)


def assign_shards(
    docs: DataFrame,
    shards: int = 8,
    key: str = "doc_id",
    stratum: str = "source",
    text: str = "text",
    seed: str = "shards-1",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per input row: key, stratum, size (UTF-8 bytes + 1), text_crc32, shard, slot (from 0, without gaps).

    Null keys and repeated rows keep their own places; rows that agree in key, stratum, size and checksum are
    interchangeable. A null text has size 1 and checksum 0. Fewer rows than shards leave some shards empty; an empty table
    gives an empty result. Other columns are not read: join the assignment on the key to move whole rows (``write_shards``).
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    body = whole_text(text)
    slim = docs.select(
        F.col(key).alias("_key"),
        stratum_of(stratum).alias("_stratum"),
        text_size(text).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")), F.crc32(body.cast("binary")).cast("string")).cast("binary")).alias("_hash"),
    )
    slim = stored(slim, "shard-keys")
    rows = slim.count()
    buckets = min(MOST_BUCKETS, max(1, -(-rows // bucket_rows)))
    ties = ["_hash", F.col("_key").asc_nulls_first(), "size", "text_crc32"]
    high = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long")
    ranked = numbered(
        slim.withColumn("_bucket", F.floor(high * buckets / 2**32).cast("long")), ["_stratum"], "_bucket", ties, "_rank"
    )
    totals = slim.groupBy("_stratum").agg(F.count(F.lit(1)).alias("_total"))
    spread = ranked.join(totals, "_stratum").withColumn(
        "_fraction", (2 * F.col("_rank") + 1).cast("double") / (2 * F.col("_total"))
    )
    spread = spread.withColumn("_bucket", F.floor(F.col("_fraction") * buckets).cast("long"))
    placed = numbered(spread, [], "_bucket", ["_fraction", "_stratum", *ties], "_position")
    # Shard i starts at position floor(i * rows / shards).
    index = f"({shards} * (_position + 1) - 1) div {max(rows, 1)}"
    return placed.select(
        F.col("_key").alias(key),
        F.when(F.col("_stratum") != "n", F.expr("substring(_stratum, 2)")).alias(stratum),
        "size",
        "text_crc32",
        F.expr(index).cast("int").alias("shard"),
        F.expr(f"_position - (({index}) * {rows}) div {shards}").cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, assignment: DataFrame, path: str, key: str = "doc_id") -> None:
    """Whole rows in one folder per shard, each file in slot order. ``key`` must be unique and not null."""
    chosen = assignment.select(key, F.col("shard").alias("shard"), F.col("slot").alias("slot"))
    rows = docs.drop("shard", "slot").join(chosen, key)
    rows.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
