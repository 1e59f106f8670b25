"""History of dimensions and facts from full snapshots.

A snapshot is the complete state of a source at one version (a number or a
time that grows). Keys are unique within a snapshot. A row of the history is
valid from ``__START_AT`` up to but excluding ``__END_AT``; the end is NULL
while the row is current.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "__START_AT", "__END_AT"

# Stamps that change on every run; comparing them would make every row new.
RUN_STAMPS = ("_silver_processed_at", "_ingested_at", "source_file", "adf_run_id")

# Versions are ordered in groups of up to this many bits of their number.
LEVEL_BITS = 22


def tracked_columns(df: DataFrame, keys: Sequence[str], ignore: Collection[str] = RUN_STAMPS) -> list[str]:
    return [c for c in df.columns if c not in {*keys, *ignore, START, END}]


def scd2_from_snapshots(
    snapshots: DataFrame,
    keys: Sequence[str],
    version: str,
    tracked: Sequence[str] | None = None,
    versions: Sequence[Any] | None = None,
) -> DataFrame:
    """Full history (type 2) from all snapshots stacked in one frame.

    A key keeps its row while consecutive snapshots carry equal tracked
    columns. A change closes the row and opens the next one; a snapshot
    without the key closes it; a later return opens a new row.

    One shuffle by key and one sort serve all window steps. A key has at most
    one row per snapshot, so no group outgrows the number of snapshots.
    ``versions`` may name all versions if the caller knows them; they must be named if they are neither numbers nor times.
    """
    compared = list(tracked) if tracked is not None else tracked_columns(snapshots, [*keys, version])
    followed = snapshots.join(_followers(snapshots, version, versions), version)

    by_version = Window.partitionBy(*keys).orderBy(version)
    state = F.struct(*compared) if compared else F.lit(True)
    next_version, next_state = F.lead(version).over(by_version), F.lead("_state").over(by_version)
    edges = (
        followed.withColumn("_state", state)
        .withColumns(
            {
                "_opens": ~(F.lag("_next").over(by_version).eqNullSafe(F.col(version)) & F.lag("_state").over(by_version).eqNullSafe(F.col("_state"))),
                "_closes": ~(next_version.isNotNull() & next_version.eqNullSafe(F.col("_next")) & next_state.eqNullSafe(F.col("_state"))),
            }
        )
        .where("_opens or _closes")
    )
    # Only the first and last row of every unchanged stretch are left.
    own_end = F.when(F.col("_closes"), F.col("_next")).otherwise(F.lead("_next").over(by_version))
    return (
        edges.withColumn(END, own_end)
        .where("_opens")
        .withColumnRenamed(version, START)
        .drop("_next", "_state", "_opens", "_closes")
        .select(*keys, *[c for c in snapshots.columns if c not in {*keys, version}], START, END)
    )


def _order_number(versions: DataFrame, version: str) -> Column:
    """A whole number that orders the versions."""
    kind = versions.schema[version].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(version).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(version).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(version).cast("timestamp"))
    raise TypeError(f"versions must be whole numbers, dates or times, or be listed; {version} is {kind.simpleString()}")


def _followers(snapshots: DataFrame, version: str, versions: Sequence[Any] | None) -> DataFrame:
    """(version, _next): for every version the one after it, NULL for the last.

    Versions named by the caller become a literal table. Otherwise they are ordered like digits: within groups that agree in all
    but the lowest bits of their number; the first versions of these groups within groups that agree in all but the next bits;
    and so on. No group has more than 2 ** LEVEL_BITS rows, and nothing goes through the driver.
    """
    if versions is not None:
        ordered = sorted(versions)
        kind = snapshots.schema[version].dataType.simpleString()
        rows = list(zip(ordered, [*ordered[1:], None]))
        return snapshots.sparkSession.createDataFrame(rows, f"`{version}` {kind}, _next {kind}")
    level = snapshots.select(version).distinct()
    level = level.select(F.col(version).alias("_first"), _order_number(level, version).alias("_key"))
    levels = []
    for _ in range(0, 64, LEVEL_BITS):
        above = F.shiftright("_key", LEVEL_BITS)
        within = Window.partitionBy("_above").orderBy("_key")
        # The highest level has one group of 2 ** LEVEL_BITS numbers at most, negative ones first.
        ordered = level.withColumn("_above", above if len(levels) < 64 // LEVEL_BITS else F.pmod(F.col("_key"), F.lit(1)))
        ordered = ordered.withColumn("_after", F.lead("_first").over(within))
        levels.append(ordered)
        level = ordered.groupBy("_above").agg(F.min("_first").alias("_first")).withColumnRenamed("_above", "_key")
    # From the top down: who is last in a group is followed by the first of the next group.
    found = levels[-1].select("_key", "_after")
    for ordered in reversed(levels[:-1]):
        upper = found.select(F.col("_key").alias("_above"), F.col("_after").alias("_over"))
        joined = ordered.join(upper, "_above")
        found = joined.select("_key", "_first", F.coalesce("_after", "_over").alias("_after"))
    return found.select(F.col("_first").alias(version), F.col("_after").alias("_next"))


def scd2_changes(
    current: DataFrame, snapshot: DataFrame, keys: Sequence[str], version: Column, tracked: Sequence[str] | None = None
) -> DataFrame:
    """Rows to store after one more snapshot: open rows (END NULL) and newly closed ones.

    ``current`` holds the open rows only; closed history never has to be read
    or rewritten. Both sides have unique keys, so the join moves each row once
    and no key can be hot.
    """
    payload = [c for c in snapshot.columns if c not in keys]
    compared = list(tracked) if tracked is not None else tracked_columns(snapshot, keys)
    columns = [*keys, *payload, START, END]

    old = current.select(*keys, F.struct(*columns).alias("_old"))
    new = snapshot.withColumns({START: version, END: F.lit(None).cast(current.schema[END].dataType)})
    new = new.select(*keys, F.struct(*[F.col(c).cast(current.schema[c].dataType).alias(c) for c in columns]).alias("_new"))

    def state(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}") for c in compared]) if compared else F.lit(True)

    is_new = F.col("_old").isNull()
    is_gone = F.col("_new").isNull()
    is_same = ~is_new & ~is_gone & state("_old").eqNullSafe(state("_new"))
    closed = F.col("_old").withField(END, version.cast(current.schema[END].dataType))
    kept = (
        F.when(is_new, F.array("_new"))
        .when(is_same, F.array("_old"))
        .when(is_gone, F.array(closed))
        .otherwise(F.array(closed, F.col("_new")))
    )
    return old.join(new, list(keys), "full").select(F.inline(kept))


def scd2_apply(
    history: DataFrame, snapshot: DataFrame, keys: Sequence[str], version: Column, tracked: Sequence[str] | None = None
) -> DataFrame:
    """The whole history after one more snapshot."""
    closed = history.where(F.col(END).isNotNull())
    return scd2_changes(history.where(F.col(END).isNull()), snapshot, keys, version, tracked).unionByName(closed)


def current_rows(history: DataFrame) -> DataFrame:
    """The open row of each key, without the validity columns."""
    return history.where(F.col(END).isNull()).drop(START, END)


def scd1_apply(
    current: DataFrame, snapshot: DataFrame, keys: Sequence[str], tracked: Sequence[str] | None = None
) -> DataFrame:
    """State (type 1) after a full snapshot: upsert, and drop keys it lacks.

    A row whose tracked columns did not change is kept as stored, with its
    stamps; so a rerun over unchanged input changes nothing.
    """
    compared = list(tracked) if tracked is not None else tracked_columns(snapshot, keys)
    columns = snapshot.columns
    old = current.select(*keys, F.struct(*columns).alias("_old"))
    new = snapshot.select(*keys, F.struct(*columns).alias("_new"))
    same = F.lit(True)
    for c in compared:
        same = same & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    unchanged = F.col("_old").isNotNull() & same
    row = F.when(unchanged, F.col("_old")).otherwise(F.col("_new"))
    return new.join(old, list(keys), "left").select(row.alias("_row")).select("_row.*")
