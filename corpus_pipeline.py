"""A corpus pipeline over documents: quality, near-duplicates, benchmark leaks, secrets, then token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has kept, which it finds written as Parquet.
All but the last return the columns of documents.

In every stage a null text counts as empty, texts of any length are read whole, an empty table gives an empty one, columns
beyond those of documents stay as they are (but in the last), and repeated rows are judged alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm import decontaminate, pieces, quality_rank, secrets, shingles
from strandlake.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking rejects go: those that score below CUT; equal scores are decided alike. Without labels of both
    kinds nothing goes."""
    return quality_rank.keep_good(docs, quality_rank.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: sets of five-word runs with a similarity of 0.8 or more, found by SimHash tables, each
    link measured. Of ties by doc_id the one with the least hash of its text stays; of rows equal in both, one; rows without
    a doc_id stay."""
    return shingles.keep_first(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a test item in them go; items of few words, or without id or text, are no reason."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text, overlapping ones as one, and n_chars follows; every row stays."""
    return secrets.redact(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the ids of the text, of every row; none for an empty text."""
    found = pieces.encode_documents(docs, pieces.read_model(), keep=("lang", "source"))
    return found.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("mask_secrets", mask_secrets),
    ("token_ids", token_ids),
]

#: Fingerprints, rankings and token ids are beyond SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
