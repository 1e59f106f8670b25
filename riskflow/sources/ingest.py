"""Incremental ingest of CSV and JSON files by column name.

A file stream has one schema, but landing files of one feed need not agree: columns come in another order, or new ones appear.
So the stream is one of file names only; every micro-batch reads its files in groups of equal headers, each under its own names,
and brings them to one frame by name. The batch number names the folder it writes, so a batch that is run again replaces itself
and nothing is ingested twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.sources.readers import ANY_AGE, BATCH_STAMPS, RESCUED, text_schema, with_provenance, with_rescued

FILES = "path string, modificationTime timestamp, length long, content binary"
#: Files of one micro-batch: bounds the names the driver holds.
FILES_PER_BATCH = 10_000
BATCH = "ingest_batch"


def first_lines(spark: SparkSession, paths: Sequence[str], comment: str | None = None) -> DataFrame:
    """(header, paths): the files of a micro-batch grouped by their first line that is not blank (nor a comment).

    One job for all files, the lines are read in tasks: the first of a file is the one with the smallest line number of the part
    that begins the file, found with a partial minimum. Files without such a line are not listed.
    """
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    numbered = lines.withColumn("number", F.monotonically_increasing_id()).where((F.col("start") == 0) & (F.trim("value") != ""))
    if comment:
        numbered = numbered.where(~F.startswith(F.ltrim("value"), F.lit(comment)))
    first = numbered.groupBy("path").agg(F.min_by("value", "number").alias("header"))
    return first.groupBy("header").agg(F.collect_list("path").alias("paths"))


def _headers(spark: SparkSession, paths: Sequence[str], options: Mapping[str, str]) -> dict[tuple[str, ...], list[str]]:
    """Paths by their column names. The catalogue of first lines is made by tasks; Spark's own reader then reads the names off one
    file per different line, of which a feed has few."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in first_lines(spark, paths, options.get("comment")).collect():
        files = [unquote(p) for p in row.paths]
        groups.setdefault(tuple(spark.read.options(**options).csv(files[0]).columns), []).extend(files)
    return groups


def _by_name(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Declared columns first (NULL where a file lacks them), then new ones, then the rescued text."""
    own = {c.lower(): c for c in df.columns}
    first = [F.col(f"`{own[c.lower()]}`").alias(c) if c.lower() in own else F.lit(None).cast("string").alias(c) for c in columns]
    known = {c.lower() for c in [*columns, RESCUED]}
    more = [F.col(f"`{c}`") for c in df.columns if c.lower() not in known]
    rescued = F.col(RESCUED) if RESCUED in df.columns else F.lit(None).cast("string").alias(RESCUED)
    return df.select(*first, *more, rescued, F.col("_metadata.file_path").alias("_path"))


def read_csv_files(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], options: Mapping[str, str] = {}) -> DataFrame:
    """Files with headers, aligned by name; rows whose cells do not match the header are rescued whole.

    With ``header=false`` in ``options`` the files have no names, and cells take the declared columns in order.
    """
    options = {"header": "true", "columnNameOfCorruptRecord": RESCUED, **options}
    if options["header"].lower() != "true":
        groups = {tuple(columns): list(paths)}
    else:
        groups = _headers(spark, paths, options)
        options["enforceSchema"] = "false"
    parts = [
        _by_name(spark.read.options(**options).schema(text_schema([*header, RESCUED])).csv(group), columns)
        for header, group in groups.items()
    ]
    if not parts:
        return spark.createDataFrame([], text_schema([*columns, RESCUED, "_path"]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_json_files(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], options: Mapping[str, str] = {}) -> DataFrame:
    """Whole JSON documents and arrays, one row per object; values as text, nested ones as JSON text.

    Names are inferred from the files. A document that is no JSON is rescued whole, and the others of its batch are kept.
    """
    options = {"multiLine": "true", "primitivesAsString": "true", "columnNameOfCorruptRecord": RESCUED, **options}
    df = spark.read.options(**options).json(list(paths))
    if not [c for c in df.columns if c != RESCUED]:
        # No file names a column: what there is is broken throughout, or empty arrays.
        text = spark.read.option("wholetext", True).text(list(paths)).withColumnRenamed("value", RESCUED)
        return _by_name(text if df.columns else text.limit(0), columns)
    nested = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.StringType)]
    text = {c: F.to_json(F.col(f"`{c}`")) for c in nested}
    path = F.col("_metadata.file_path").alias("_path")
    own = {c.lower(): c for c in df.columns}
    value = lambda c: text.get(c, F.col(f"`{c}`"))
    first = [value(own[c.lower()]).alias(c) if c.lower() in own else F.lit(None).cast("string").alias(c) for c in columns]
    known = {c.lower() for c in [*columns, RESCUED]}
    more = [value(c).alias(c) for c in df.columns if c.lower() not in known]
    rescued = F.col(RESCUED) if RESCUED in df.columns else F.lit(None).cast("string").alias(RESCUED)
    return df.select(*first, *more, rescued, path)


def read_line_files(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], options: Mapping[str, str] = {}) -> DataFrame:
    """JSON lines: declared fields, and all others as rescued JSON text."""
    lines = spark.read.options(**options).text(list(paths)).select(F.col("value").alias("_record"), F.col("_metadata.file_path").alias("_path"))
    return with_rescued(lines, "_record", columns)


READERS = {"csv": read_csv_files, "json": read_json_files, "jsonl": read_line_files}


def ingest_files(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    columns: Sequence[str],
    run_id: str,
    file_name: str = "*",
    file_format: str = "csv",
    options: Mapping[str, str] | None = None,
    archive_dir: str | None = None,
    stamps: Sequence[str] = BATCH_STAMPS,
    timeout: int | None = None,
) -> None:
    """Append the rows of all new files of ``folder`` to the table ``out``, whatever their age, then stop.

    The table has the declared columns, any others the files have, rescued text and provenance, all by name, in one folder per
    micro-batch. ``checkpoint`` belongs to the table: it counts the batches. With ``archive_dir`` a file is moved there once a
    later batch has confirmed it.
    """
    kind = file_format.lower()
    if kind not in READERS:
        raise ValueError(f"unknown file format {file_format!r}")
    source = {"pathGlobFilter": file_name, "maxFilesPerTrigger": str(FILES_PER_BATCH), **ANY_AGE}
    if archive_dir:
        source |= {"cleanSource": "archive", "sourceArchiveDir": archive_dir}

    def store(files: DataFrame, number: int) -> None:
        paths = [r.path for r in files.select("path").collect()]
        if not paths:
            return
        rows = READERS[kind](files.sparkSession, paths, columns, options or {})
        stamped = with_provenance(rows, run_id, stamps, "_path").drop("_path")
        stamped.write.mode("overwrite").parquet(f"{out}/{BATCH}={number}")

    names = spark.readStream.format("binaryFile").schema(FILES).options(**source).load(folder).select("path")
    query = names.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if not query.awaitTermination(timeout) and timeout is not None:
        query.stop()
        raise TimeoutError(f"ingest into {out} still runs after {timeout} s")
