"""Documents to training sequences: toxic texts out, one of each near-duplicate group, no benchmark text, personal data masked,
packed into sequences.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame; each result is stored as Parquet and read again as
the next stage's documents. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import decontamination, neardup, packing, personal, toxicity
from riskflow.llm.frames import read, stored


HELD = "_doc"


def _held(docs: DataFrame) -> DataFrame:
    """(doc_id, text, one struct of all other columns): no column of the documents can clash with what a stage adds."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*(others or [F.lit(0).alias("_none")])).alias(HELD))


def _back(held: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, in their order."""
    return held.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"{HELD}.`{c}`").alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents the subsequence kernel machine does not call toxic. Keys of the held-out fifth are not learnt from."""
    model = toxicity.fit(docs.filter(~toxicity.held_out()), read(spark, folder, "labels"))
    return _back(toxicity.score(_held(docs), model).filter("predicted = 0"), docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8), that with the smallest key. Rows that agree in
    key and text count once; rows that share only the key are documents of their own. Rows without a key stay."""
    held, key = _held(docs), "doc_id"
    keyed = held.filter("doc_id is not null")
    if _repeats(docs):
        keyed, key = _numbered(keyed), "_row"
    groups = neardup.near_duplicates(keyed, key, shingle=5, percent=80)
    kept = keyed.join(groups.filter("kept").select(key).distinct(), key, "left_semi").select(*held.columns)
    return _back(kept.unionByName(held.filter("doc_id is null")), docs)


def _numbered(held: DataFrame) -> DataFrame:
    """Rows that agree in key and text once, the same one in every run, numbered by key in ``_row`` and stored."""
    once = held.groupBy("doc_id", "text").agg(F.min_by(HELD, F.to_json(HELD)).alias(HELD))
    ordered = once.orderBy("doc_id", F.xxhash64("text"))
    return stored(ordered.withColumn("_row", F.monotonically_increasing_id()), "pipeline-rows")


def _repeats(docs: DataFrame) -> bool:
    n, distinct = docs.agg(F.count("doc_id"), F.countDistinct("doc_id")).first()
    return n != distinct


def drop_leaked(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a verified overlap with a benchmark item."""
    judged = decontamination.decontaminate(_held(docs), read(spark, folder, "benchmark"))
    return _back(judged.filter("not contaminated"), docs)


def mask_personal(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    masked = _back(personal.redact(_held(docs)), docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Sequences of the permitted lengths with the documents in them: bin_id, capacity, used, doc_ids, content."""
    if docs.filter("doc_id is null").isEmpty() and not _repeats(docs):
        return packing.assemble(stored(packing.pack(docs), "packing"), docs)
    # Rows without a key of their own are numbered and stored at once, so that each keeps its own place.
    rows = stored(docs.select("doc_id", "text").withColumn("_row", F.monotonically_increasing_id()), "packing-rows")
    return packing.assemble(stored(packing.pack(rows, "_row"), "packing"), rows, "_row", name="doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_leaked),
    ("personal_data", mask_personal),
    ("packing", pack_sequences),
]

#: The kernel machine and the packing are no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, folder)
