"""The corpus pipeline: quality, near-duplicates, benchmark leaks, secrets, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicedigest.llm.decontaminate import contaminated
from slicedigest.llm.packing import pack_documents
from slicedigest.llm.quality import fit_quality, score_quality
from slicedigest.llm.secret_ledger import redact, scan_paths
from slicedigest.llm.shingle_copies import near_copies, text_key
from slicedigest.runtime import materialise, use_checkpoint_dir

KEEP_SCORE = 0.5
"""Documents whose quality score is lower go."""


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the compression classifier does not reject. A row is judged by its text, whatever its id."""
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _without(docs, score_quality(_by_text(docs), model).where(F.col("score") < KEEP_SCORE))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component of near copies: that of the smallest id, rows without an id last.

    Near copies have at least 0.8 of their five-word shingles in common (`near_copies`), not op10's four bits. Rows are told
    apart by id and text; of rows that repeat in both one stays.
    """
    same = near_copies(docs).groupBy("component", "doc_id", "text_key").agg(F.count("*").alias("n"))
    least = same.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("least"))
    kept = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_key") == F.col("least.text_key"))
    marks = same.join(least, "component").select(F.col("doc_id").alias("id"), F.col("text_key").alias("of"), kept.alias("kept"), "n")
    marks = materialise(marks.where("NOT kept OR n > 1").drop("n"))
    own = _wrapped(docs).withColumn("doc", F.col("row.doc_id").cast("bigint")).withColumn("key", text_key("row.text"))
    same_row = F.col("doc").eqNullSafe(F.col("id")) & (F.col("key") == F.col("of"))
    single = own.join(marks, same_row, "left_anti").select("row.*")
    repeated = marks.where("kept")
    if repeated.isEmpty():
        return single
    return single.unionByName(own.join(repeated, same_row).dropDuplicates(["of", "id"]).select("row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item, as such or re-parameterised. A row is judged by its text."""
    return _without(docs, contaminated(_by_text(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep every document, its secrets replaced by ``[secret]`` and its length counted anew. Null text stays null."""
    versions = docs.select("doc_id", F.col("text").alias("content"))
    found, _ = scan_paths(versions)
    marks = found.where("found IS NOT NULL").groupBy(F.col("doc_id").alias("id"), F.col("blob").alias("of")).agg(F.first("found").alias("found"))
    own = _wrapped(docs).select("row", F.col("row.text").alias("text"), F.unhex(F.sha2(F.encode(F.coalesce("row.text", F.lit("")), "UTF-8"), 256)).alias("blob"))
    marked = own.join(marks, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("blob") == F.col("of")), "left")
    text = redact("text", "found")
    length = F.when(F.col("found").isNull(), F.col("row.n_chars")).otherwise(F.length(text).cast("bigint"))
    cleaned = {"text": text, "n_chars": length}
    return marked.select(*[cleaned.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into windows of 2048 tokens; the rows are the pieces with their token ids."""
    return pack_documents(docs)


def _wrapped(docs: DataFrame) -> DataFrame:
    """Each row as one struct, so that no column of it can clash with those a stage needs."""
    return docs.select(F.struct("*").alias("row"))


def _by_text(docs: DataFrame) -> DataFrame:
    """Texts under their hash instead of an id, for operators whose answer depends on the text alone."""
    return docs.select(F.xxhash64("text").alias("doc_id"), "text")


def _without(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows whose text is not among those found under `_by_text`."""
    gone = found.select(F.col("doc_id").alias("gone")).distinct()
    return _wrapped(docs).join(gone, F.xxhash64("row.text") == F.col("gone"), "left_anti").select("row.*")


STAGES = [
    ("quality", quality),
    ("near_duplicate", near_duplicate),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet below the checkpoint folder and read again."""
    folder = f"{use_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}_{name}")
        docs = spark.read.parquet(f"{folder}/{i}_{name}")
    return docs
