"""From raw documents to tokens: five stages, each written as Parquet and read again.

Quality classifier, line dedup, near-dedup by SimHash (with MinHash for copies further off),
benchmark decontamination, BPE.
Each stage works on all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.bpe import encode
from hirelake.llm.common import staged, table
from hirelake.llm.decontaminate import decontaminate
from hirelake.llm.kn_quality import classify, trusted_ids
from hirelake.llm.line_dedup import line_dedup
from hirelake.llm.near_copies import near_copy_dedup


def _with_text(docs: DataFrame, made: DataFrame, text: str) -> DataFrame:
    """``made`` with the columns of ``docs``, the text being the column ``text``."""
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return made.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model doesn't reject."""
    return classify(docs, trusted_ids(spark, sf_dir)).where("kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; all documents stay."""
    return _with_text(docs, line_dedup(docs), "kept_text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that with the smallest id."""
    return near_copy_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; those that are mostly such go."""
    made = decontaminate(docs, table(spark, sf_dir, "benchmark")).where(~F.col("dropped"))
    return _with_text(docs, made, "clean_text")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, with a digest of the text that they decode to."""
    return encode(docs).select(
        F.col("doc").alias("doc_id"), "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: The language model and the fingerprints are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
