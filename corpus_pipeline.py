"""The corpus pipeline: each stage works on all that the one before it kept, read back from Parquet.

Stages, in order: language ID drops texts without a language; line dedup removes later occurrences of three-line windows, and
the documents that nothing is left of; the n-gram join keeps one document of each group; personal data is replaced;
the rest is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import crf_langid, line_windows, ngram_join, packing, surrogates
from logloom.llm.common import saved
from logloom.llm.queries import SURROGATE_KEY


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; ``lang`` is filled where it is null. ``und`` goes."""
    own = [c for c in docs.columns if c not in ("lang_pred", "score", "segments")]
    found = crf_langid.identify(docs.select(*own), keep=tuple(own)).where("lang_pred != 'und'")
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*own)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = line_windows.dedup_lines(docs)
    gone = (F.col("n_removed") > 0) & (F.trim(F.replace("text", F.lit("\n"))) == "")
    return _counted(rows.where(~gone).select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(surrogates.replace_entities(docs, SURROGATE_KEY).select(*docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pieces(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(pieces)


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("PII surrogates", personal_data),
    ("best-fit packing", pack),
]

#: The model's language decisions and keyed surrogates are no SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = saved(docs, "stage")
    return docs
