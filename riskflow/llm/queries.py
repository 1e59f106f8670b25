"""Check queries of the operators over the given tables, with production parameters and over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import (
    alignment,
    collocations,
    decomposition,
    decontamination,
    neardup,
    packing,
    personal,
    quality,
    repeats,
    secrets,
    sharding,
    toxicity,
    warc,
)
from riskflow.llm.frames import read
from riskflow.session import work_folder


def op1_subsequence_svm(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    learnt = docs.filter(~toxicity.held_out())
    model = toxicity.fit(learnt, read(spark, folder, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op2_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"))


def op3_deep_shallow(spark: SparkSession, folder: str) -> DataFrame:
    done = repeats.remove_repeats(read(spark, folder, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    scanned = secrets.scan_versions(docs, work_folder(spark, "secret-ledger"))
    base = [r.kind for r in secrets.BASE_RULES]
    of = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")
    return scanned.select(
        F.col("path").alias("doc_id"),
        *[of(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(
            secrets.spans_text(F.filter("findings", lambda x: x["kind"].isin(base))).cast("binary"), 256
        ).alias("base_sha256"),
        secrets.spans_text(F.col("findings")).alias("spans"),
    )


def op5_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return decontamination.decontaminate(docs, read(spark, folder, "benchmark")).drop("text")


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, folder, "documents"), shingle=3, percent=85)


def op6_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.clean_lines(read(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_lines",
        "n_removed_lines",
    )


def op8_seekable_warc(spark: SparkSession, folder: str) -> DataFrame:
    index = warc.write_archives(read(spark, folder, "pages"), work_folder(spark, "warc"))
    return warc.read_archives(index).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact", "frame", "offset"
    )


def op9_interleaved_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.assign_shards(read(spark, folder, "documents"), shards=8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def op10_contextual_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = personal.find_personal(read(spark, folder, "documents").select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("personal", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("personal", lambda x: x["kind"].isin(list(personal.KINDS)))
    return found.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in personal.KINDS],
        F.sha2(personal.spans_text(base).cast("binary"), 256).alias("base_sha256"),
        personal.spans_text(F.col("personal")).alias("spans"),
    )


def tokenizer(name: str) -> str:
    """A file of the installed public tokenizers."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(read(spark, folder, "documents"))


def op12_power_of_two(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    pieces = decomposition.decompose(docs, tokenizer("word_bpe_49k.json"))
    slim = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return decomposition.with_sequences(slim)


def op13_aligned_tokens(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    files = alignment.Tokenizers(tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
    done = alignment.align_documents(docs, files)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return done.withColumn("groups_sha256", digest).drop("groups")


QUERIES = {
    "op1_subsequence_svm": op1_subsequence_svm,
    "op2_best_fit": op2_best_fit,
    "op3_deep_shallow": op3_deep_shallow,
    "op4_secrets": op4_secrets,
    "op5_spaced_seeds": op5_spaced_seeds,
    "op6_line_quality": op6_line_quality,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_seekable_warc": op8_seekable_warc,
    "op9_interleaved_shards": op9_interleaved_shards,
    "op10_contextual_pii": op10_contextual_pii,
    "op11_collocations": op11_collocations,
    "op12_power_of_two": op12_power_of_two,
    "op13_aligned_tokens": op13_aligned_tokens,
}
