"""The corpus pipeline: STAGES in order, each written as Parquet and read again as the next one's documents.

Every stage but the last returns the columns of ``documents``; ``n_chars``, where there is one, follows the text. A
document that a stage leaves without a word is gone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from ledgerleaf.llm.common import delete, new_path, scratch
from ledgerleaf.llm.line_dedup import line_dedup
from ledgerleaf.llm.minhash_dedup import minhash_dedup
from ledgerleaf.llm.packing import pack
from ledgerleaf.llm.quality_rules import quality_rules
from ledgerleaf.llm.substring_dedup import substring_dedup

END_ID = 2
SHINGLE = 5  # words; four are the contract of the query op5 alone
LINE_WORDS = 13  # as many as a passage of the substring stage


def _as_documents(out: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    out = out.withColumn("text", F.col(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their failed lines. Null, empty and blank texts go; repeated rows are judged alike; an empty table stays empty."""
    return _as_documents(quality_rules(docs).where("kept"), docs, "clean_text")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs: two lines or more, or one line of ``LINE_WORDS`` words.

    The smallest (doc_id, text, line) keeps its copy, a null doc_id counts as the smallest; a document that loses all its
    lines goes; repeated rows count as one document and stay both; null texts stay.
    """
    return _as_documents(line_dedup(docs, min_words=LINE_WORDS).where("n_removed_lines = 0 OR n_removed_lines < n_lines"), docs, "clean_text")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: word shingles of ``SHINGLE`` words, Jaccard similarity of 0.8.

    The smallest doc_id of a group stays, with all its rows; rows with a null doc_id link with nothing and stay, as do
    documents without words.
    """
    return _as_documents(minhash_dedup(docs, width=SHINGLE).where("kept OR doc_id IS NULL"), docs, "text")


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 13 words that a document of smaller doc_id has; one that loses all its words goes. Rows of one doc_id never take each other's words; a null doc_id counts as the greatest; null texts stay."""
    return _as_documents(substring_dedup(docs).where("n_removed = 0 OR n_removed < n_words"), docs, "text")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids: a row a piece of a document. Null and empty texts are their end id alone; repeated rows are packed each; an empty table gives no rows."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID)


STAGES = [("quality rules", rules), ("line dedup", lines), ("minhash near-dedup", near), ("substring dedup", passages), ("packing", packed)]
#: Packing tokenises, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name.replace(" ", "-"))
        with scratch(spark):  # what the stage saved on its way goes once its documents are written
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before is not None:
            delete(spark, before)  # the last stage's documents stay: what is returned reads them
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
