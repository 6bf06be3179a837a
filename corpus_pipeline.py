"""From raw documents to token ids: quality rules, SimHash near-dedup, secret scans, mixing, BPE.

Each stage is a function (spark, docs, sf_dir) -> DataFrame on all that its predecessor kept,
written as Parquet and read again.  All stages but the last return the columns of documents.

A null text counts as empty (and fails the quality rules), rows that repeat a document are near-duplicates
of each other (one stays), extra columns are carried along, an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelake.llm.common import long_rows, stage, table
from curvelake.llm.queries import tokenizer_file


def _length(docs: DataFrame) -> str | None:
    return "n_chars" if "n_chars" in docs.columns else None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, and lines that are frequent on their host; the rest stays as it is."""
    from curvelake.llm.quality import keep_good

    long_rows(spark)
    return keep_good(docs, length=_length(docs))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest doc_id."""
    from curvelake.llm.simhash import keep_one

    long_rows(spark)
    return keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; all documents stay."""
    from curvelake.llm.secrets import redact

    long_rows(spark)
    return redact(docs, length=_length(docs))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, or left out, so that sources meet their target weights."""
    from curvelake.llm.mixing import mixed_documents

    long_rows(spark)
    return mixed_documents(docs, length=_length(docs))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids, and whether the ids decode to the text again."""
    from curvelake.llm.bpe import decode, encode

    long_rows(spark)
    tokenizer = tokenizer_file("byte_bpe_50k.json")
    encoded = encode(docs, tokenizer, keep=["doc_id", "source", F.coalesce("text", F.lit("")).alias("text")])
    decoded = decode(encoded, tokenizer, column="decoded")
    return decoded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                          (F.col("decoded") == F.col("text")).alias("round_trip"))


STAGES = [("quality_rules", quality_rules), ("simhash_dedup", simhash_dedup), ("secret_scans", secret_scans),
          ("source_mixing", source_mixing), ("bpe_encoding", bpe_encoding)]

#: SQL can't express SimHash or BPE; tests/llm compares the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
