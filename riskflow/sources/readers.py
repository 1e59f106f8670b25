"""Incremental readers for raw files, with provenance and rescued fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.sources.schemas import CONTROL

RESCUED = "_rescued_data"
BATCH_STAMPS = ("_ingested_at", "source_file", "adf_run_id")
SWIPE_STAMPS = ("ingested_at", "file_name", "adf_run_id")
#: By default a file stream skips files that are a week older than the newest one seen: a backfill would be lost.
ANY_AGE = {"maxFileAge": "36500d"}


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def with_provenance(
    df: DataFrame, run_id: str, names: Sequence[str] = BATCH_STAMPS, file_path: str | Column = "_metadata.file_path"
) -> DataFrame:
    """Stamp ingest time, source file and run id, under the given names."""
    path = F.col(file_path) if isinstance(file_path, str) else file_path
    ingested, file, run = names
    return df.withColumns({ingested: F.current_timestamp(), file: path, run: F.lit(run_id)})


FIELDS = "map<string,string>"


def _declared(df: DataFrame, fields: str, record: str, columns: Sequence[str]) -> DataFrame:
    """Replace a parsed record by its declared columns and the rescued rest."""
    declared = F.array(*[F.lit(c) for c in columns])
    others = F.map_filter(F.col(fields), lambda name, value: ~F.array_contains(declared, name))
    rescued = F.when(F.col(fields).isNull(), F.col(record)).when(F.size(others) > 0, F.to_json(others))
    values = {c: F.try_element_at(fields, F.lit(c)) for c in columns}
    return df.withColumns({**values, RESCUED: rescued}).drop(fields, record)


def with_rescued(df: DataFrame, record: str, columns: Sequence[str]) -> DataFrame:
    """Declared fields of a JSON text column, plus all other fields as JSON text.

    The record is parsed once, to a map; a record that is not an object is
    rescued whole. Other columns of the frame stay.
    """
    return _declared(df.withColumn("_fields", F.from_json(record, FIELDS)), "_fields", record, columns)


def read_lines(
    spark: SparkSession,
    folder: str,
    columns: Sequence[str],
    run_id: str,
    file_name: str = "*",
    options: Mapping[str, str] | None = None,
    archive_dir: str | None = None,
    stamps: Sequence[str] = BATCH_STAMPS,
) -> DataFrame:
    """Stream of the new JSON-lines files of a folder as declared text columns with provenance, whatever their age.

    ``options`` override the defaults. With ``archive_dir`` a file is moved there once a later batch has confirmed it. CSV files
    and whole JSON documents, whose columns each file names itself, are read by ``ingest.ingest_files``.
    """
    defaults = {"pathGlobFilter": file_name, **ANY_AGE}
    if archive_dir:
        defaults |= {"cleanSource": "archive", "sourceArchiveDir": archive_dir}
    lines = spark.readStream.format("text").options(**{**defaults, **(options or {})}).load(folder)
    located = lines.select(F.col("value").alias("_record"), F.col("_metadata.file_path").alias("_path"))
    return with_provenance(with_rescued(located, "_record", columns), run_id, stamps, "_path").drop("_path")


def read_swipes(spark: SparkSession, folder: str, columns: Sequence[str], run_id: str, **options: str) -> DataFrame:
    """Stream of card swipes from JSON-lines files."""
    return read_lines(spark, folder, columns, run_id, "*.jsonl", options, stamps=SWIPE_STAMPS)


def control_table(spark: SparkSession, path: str) -> DataFrame:
    """Descriptors of all sources, from one JSON array."""
    return spark.read.schema(CONTROL).option("multiLine", True).json(path)


def active(control: DataFrame) -> DataFrame:
    return control.where("is_active")


def active_sources(control: DataFrame) -> list[Row]:
    """Active descriptors. A hand-kept list of feeds, so it fits the driver."""
    return active(control).collect()


def has_files(spark: SparkSession, folder: str, file_name: str = "*") -> bool:
    """Whether a landing folder holds any matching file. Lists names, reads none."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", file_name).load(folder)
        return not files.select("path").isEmpty()
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return False


def is_missing(error: AnalysisException) -> bool:
    """Whether a path is not there, as opposed to not being readable."""
    return error.getCondition() == "PATH_NOT_FOUND"


def bronze_schema(columns: Sequence[str], stamps: Sequence[str] = BATCH_STAMPS) -> T.StructType:
    """Columns of a bronze table: the declared ones, rescued fields, provenance."""
    ingested, file, run = stamps
    return text_schema([*columns, RESCUED]).add(ingested, T.TimestampType()).add(file, T.StringType()).add(run, T.StringType())


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored table. With a schema it has exactly those columns: what older files lack is NULL, at no extra listing."""
    return spark.read.schema(schema).parquet(path).select(*schema.names) if schema else spark.read.parquet(path)


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, max_files: int | None = None
) -> DataFrame:
    """Stream of the rows appended to a stored table."""
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema).options(**ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
