"""One row per key, on tables and on streams."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NEWEST_FIRST = ("_ingested_at", "source_file")
RUN_STAMPS = ("_silver_processed_at", "rejected_at")


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest_by: Sequence[str] = NEWEST_FIRST,
    ignore: Collection[str] = RUN_STAMPS,
) -> DataFrame:
    """Keep the newest row of each key, by ``newest_by`` descending.

    Ties are decided by the remaining columns, so a recomputed task picks the
    same row; columns in ``ignore`` (stamps of the run) take no part. Spark
    plans the rank filter as a group limit on both sides of the shuffle: each
    map task sends at most one row per key, so a key that owns a third of all
    rows costs its reducer one row per map task.
    """
    first = [c for c in newest_by if c in df.columns]
    ties = [
        f.name
        for f in df.schema.fields
        if f.name not in {*keys, *first, *ignore} and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    # Rows of nothing but keys are alike; a window still needs an order.
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in [*first, *ties] or keys])
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def stream_dedup(
    df: DataFrame,
    key: str = "swipe_id",
    event_time: str = "swipe_timestamp",
    delay: str = "24 hours",
    exact: bool = False,
    spread: int | None = None,
) -> DataFrame:
    """Drop repeated keys from a stream.

    By default a key is remembered until the watermark has moved ``delay`` past its first event, so state stays bounded by one
    delay's worth of keys; rows behind the watermark are dropped (``late_rows`` finds them). ``exact=True`` sets no watermark:
    every key is remembered for good, nothing repeats, nothing is dropped, and the state grows with the stream.

    A streaming shuffle has no map-side combine, so a key repeated in a third of the rows would all reach one task. With
    ``spread > 1`` copies are first dropped within (key, input partition modulo spread), which lets at most ``spread`` copies of a
    key through to the final step. By default that is the number of state partitions (``spark.sql.shuffle.partitions`` when the
    query first starts): a hot key is then dealt to as many tasks as there are, and a key that does not repeat costs the same at
    any spread. The partition number is a property of the task, hence stable when a task is run again.
    """
    if spread is None:
        spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = df if exact else df.withWatermark(event_time, delay)
    if spread > 1:
        marked = marked.withColumn("_spread", F.pmod(F.spark_partition_id(), F.lit(spread)))
    drop = DataFrame.dropDuplicates if exact else DataFrame.dropDuplicatesWithinWatermark
    if spread > 1:
        marked = drop(marked, [key, "_spread"]).drop("_spread")
    return drop(marked, [key])


EVENT_DAY = "event_day"
#: Copies of a row lie within this of each other: what ``stream_dedup`` remembers a key for by default.
DELAY = "24 hours"


def with_event_day(df: DataFrame, event_time: str = "swipe_timestamp") -> DataFrame:
    """Adds the day tables of events are partitioned by."""
    return df.withColumn(EVENT_DAY, F.to_date(event_time))


def near_days(batch: DataFrame, event_time: str, reach: int = 1) -> list[date]:
    """The days on which copies of a micro-batch's rows can be: one entry per day of the batch and its neighbours."""
    days = [r[0] for r in batch.select(F.to_date(event_time)).distinct().collect() if r[0]]
    return sorted({d + timedelta(days=i) for d in days for i in range(-reach, reach + 1)})


def _unlike(rows: DataFrame, others: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Rows without a row of their key within ``delay`` among ``others``."""
    known = others.select(F.col(key).alias("_key"), F.col(event_time).alias("_time"))
    span = F.expr(f"INTERVAL {delay}")
    copy = (F.col(key) == F.col("_key")) & (F.col("_time") <= F.col(event_time) + span) & (F.col("_time") >= F.col(event_time) - span)
    return rows.join(known, copy, "left_anti")


def late_rows(
    batch: DataFrame,
    accepted: DataFrame,
    late: DataFrame | None = None,
    key: str = "swipe_id",
    event_time: str = "swipe_timestamp",
    delay: str = DELAY,
) -> DataFrame:
    """Rows of a micro-batch that ``stream_dedup`` dropped for being behind the watermark, once it has seen the same input.

    A row it dropped as a copy has a row of its key within ``delay`` among the ``accepted``; a late row has none, nor one among
    the rows ``late`` before. Both tables are partitioned by event day, and only the days next to those of the batch are read.
    Late rows of one key within ``delay`` of the one before are copies too.
    """
    days = F.col(EVENT_DAY).isin(near_days(batch, event_time))
    found = _unlike(batch, accepted.where(days), key, event_time, delay)
    if late is not None:
        found = _unlike(found, late.where(days), key, event_time, delay)
    single = latest_per_key(found, [key, event_time])
    before = F.lag(event_time).over(Window.partitionBy(key).orderBy(event_time))
    apart = before.isNull() | (F.col(event_time) > before + F.expr(f"INTERVAL {delay}"))
    return single.withColumn("_apart", apart).where("_apart").drop("_apart")
