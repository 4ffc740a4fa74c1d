"""Corpus preparation: quality rules, near-duplicate removal, benchmark
decontamination, secret redaction and packing, one stage after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that `run`
writes as Parquet in the shared checkpoint folder and reads again as the
next stage's documents. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.llm.common import counted_side, read, text_key
from quartermaster.llm.decontamination import find_contamination
from quartermaster.llm.near_dedup import one_of_each_group
from quartermaster.llm.packing import pack_documents
from quartermaster.llm.quality import quality_verdicts
from quartermaster.llm.queries import tokenizer_path
from quartermaster.llm.secret_scan import redact, scan_secrets
from quartermaster.session import ensure_checkpoint_dir


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of `docs` that aren't in `gone` (id, row_key)."""
    gone = counted_side(gone.distinct())
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["id"]) & (text_key("text") == gone["row_key"]), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules. Null and empty texts fail them;
    texts of any length are whole; rows of one id are judged by their own text;
    an empty table stays empty."""
    return without(docs, quality_verdicts(docs).filter("NOT kept").select(F.col("doc_id").alias("id"), "row_key"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, 0.8), the
    one with the smallest id; different texts of one id are documents of their
    own. Rows without an id stay, so do empty and null texts; texts of any
    length are whole; an empty table stays empty."""
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window. Null and empty texts have none and
    stay; texts of any length are whole; rows of one id are judged by their own
    text; an empty table stays empty, an empty benchmark removes nothing."""
    hit = find_contamination(docs, read(spark, sf_dir, "benchmark")).filter("n_hit > 0")
    return without(docs, hit.select(F.col("doc_id").alias("id"), "row_key"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets replaced by a mark; every document stays, null and
    empty texts as they are; texts of any length are whole."""
    clean = redact(docs, scan_secrets(docs))
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their place in sequences of 2048 tokens. Null
    and empty texts are one token; only longer documents are cut; an empty table
    gives no pieces."""
    return pack_documents(docs, tokenizer_path(), capacity=2048, end_id=0)


STAGES = [("quality rules", quality), ("MinHash near-dedup", near_dedup), ("benchmark decontamination", decontamination),
          ("secret scans", secrets), ("best-fit packing", packing)]
#: No SQL form: the near-duplicate groups and the packing; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
