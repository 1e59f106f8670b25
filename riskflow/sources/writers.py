"""Writers: checkpointed appends, balanced tables, clustered tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

ROWS_PER_FILE = 10_000_000
#: Rows of a clustered table that one task sorts.
ROWS_PER_RANGE = 1_000_000


def append_available_now(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    timeout: int | None = None,
) -> StreamingQuery:
    """Append all input that is available, exactly once, then stop.

    Waits for the end; an error of the stream is raised here. Input that
    arrives later is picked up by the next call with the same checkpoint.
    """
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.trigger(availableNow=True).start(path)
    if not query.awaitTermination(timeout) and timeout is not None:
        query.stop()
        raise TimeoutError(f"stream into {path} still runs after {timeout} s")
    return query


def for_each_batch(
    df: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str, timeout: int | None = None
) -> StreamingQuery:
    """Hand all input that is available to ``store``, batch by batch, then stop.

    A batch that is run again has the same number and input: what ``store`` keeps under the number, replacing what is there, it
    keeps once.
    """
    query = df.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if not query.awaitTermination(timeout) and timeout is not None:
        query.stop()
        raise TimeoutError(f"stream with checkpoint {checkpoint} still runs after {timeout} s")
    return query


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (), balance: bool = True
) -> None:
    """Store a table in files of even size.

    The rebalance hint lets adaptive execution merge small and split large
    output partitions, also where one partition value owns most rows. It moves
    every row once more; rows that come from even files, or from a shuffle that
    leaves no large partition, are written as they lie with ``balance=False``.
    """
    if balance:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df.hint("rebalance")
    df.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(*partition_by).parquet(path)


#: Rows sampled for the ranks of clustering keys, and bits of a rank.
SAMPLE_ROWS, RANK_BITS = 8192, 8


def _ranks(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The rank of each key among 2 ** RANK_BITS even ranges of its values, whatever their type; NULL is the lowest.

    The ranges come from a random sample of about SAMPLE_ROWS rows. A rank is found by halving, in RANK_BITS comparisons.
    """
    rows = df.count()
    sample = df.select(*keys).sample(min(1.0, SAMPLE_ROWS / max(1, rows)), 7).collect()
    ranks = []
    for key in keys:
        values = sorted(r[key] for r in sample if r[key] is not None)
        bounds = [values[i * len(values) >> RANK_BITS] for i in range(1, 1 << RANK_BITS)] if values else []
        if not bounds:
            ranks.append(F.lit(0))
            continue
        limits = F.array(*map(F.lit, bounds)).cast(T.ArrayType(df.schema[key].dataType))
        steps = F.array(*[F.lit(1 << b) for b in reversed(range(RANK_BITS))])
        ranks.append(
            F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(limits, at + step - 1) <= F.col(key), at + step).otherwise(at))  # noqa: B023
        )
    return ranks


def curve_place(df: DataFrame, keys: Sequence[str]) -> Column:
    """Place on a curve that fills the space of the keys: the bits of their ranks, taken in turn. Rows near each other on it are
    near in every key, so files cut along the curve can be skipped by any of them."""
    place = F.lit(0).cast("long")
    for i, rank in enumerate(_ranks(df, keys)):
        for bit in range(RANK_BITS):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long")
            place = place.bitwiseOR(F.shiftleft(one, bit * len(keys) + len(keys) - 1 - i))
    return place


def write_clustered(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    mode: str = "overwrite",
    partitions: int | None = None,
    curve: bool = False,
) -> None:
    """Store a table ordered by ``keys``, so that scans can skip files and row groups; with ``curve`` along a curve through all of
    them instead, so that the later keys let scans skip as well (at most 7 keys).

    ``partitions`` (by default those of a shuffle) is the least number of ranges: a task sorts one, so there are more of them where
    they would hold over ROWS_PER_RANGE rows each.
    ``df`` should be a stored table: its keys are read once more for the bounds of the ranges. The bounds include the input
    partition a row comes from: rows of one hot key can then be cut into several ranges instead of filling one task.
    """
    curve = curve and len(keys) > 1
    if curve and len(keys) * RANK_BITS > 62:
        raise ValueError("too many keys for one curve")
    placed = df.withColumn("_place", curve_place(df, keys)) if curve else df
    by = ["_place"] if curve else list(keys)
    origin = placed.withColumn("_origin", F.spark_partition_id())
    ranges = -(-df.count() // ROWS_PER_RANGE)
    if ranges > (partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))):
        partitions = ranges
    ranged = origin.repartitionByRange(partitions, *by, "_origin") if partitions else origin.repartitionByRange(*by, "_origin")
    ordered = ranged.drop("_origin").sortWithinPartitions(*by, *(keys if curve else ())).drop("_place")
    ordered.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
