"""Documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; :func:`run` writes each stage's rows to the shared folder and reads them
again for the next. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from samewise.llm import langid, linededup, neardup, packing, queries, secrets
from samewise.llm.common import remove, stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language compression finds with a clear margin."""
    return langid.accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a later document repeats."""
    return linededup.without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    return neardup.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets blotted out."""
    return secrets.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 1024 ids."""
    return packing.packed(docs, queries.bpe_path())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", packing_stage),
]

#: Compression, MinHash and BPE have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, path = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if last:
            remove(spark, [last])
        last = path
    return docs
