"""The training-corpus pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
keep the columns of ``documents``. ``run`` writes each stage's rows as Parquet to the
shared folder and reads them back for the next, so a lost executor costs tasks of one
stage only, and a stage never works on rows that an earlier one has dropped.

A null or empty text does not outlive the first stage; an empty table gives an empty
result; repeated rows are near duplicates of each other, so one of them stays.
"""

from pyspark.sql import DataFrame, SparkSession

from vitals.llm import bpe, decontaminate, quality, secret_scan, simhash
from vitals.llm.common import table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the weakly supervised classifier rejects."""
    return quality.filtered(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group: the smallest doc_id."""
    return simhash.deduplicated(docs, words=3, max_distance=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that leak a benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets in the texts; every document stays."""
    return secret_scan.without_secrets(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts, and the text that the ids decode to."""
    found = bpe.encoded(docs, bpe.default_path(), keep=["doc_id", "lang", "source"])
    return found.select("doc_id", "lang", "source", "n_tokens", bpe.id_array(found["ids"]).alias("ids"), "decoded")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_masking", secret_masking),
    ("bpe_encoding", encoding),
]

ORACLE_SQL = None  # fingerprints, tilings and merges are not for SQL; tests hold run() against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
