"""From raw documents to packed sequences: quality rules, near-dedup, secrets, source mix, packing.

Each stage works on what its predecessor kept, as written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomline.llm.mixing import take_mix
from loomline.llm.packing import best_fit_packing
from loomline.llm.quality import keep_quality
from loomline.llm.secrets import mask_secrets
from loomline.llm.simhash import drop_near_copies
from loomline.llm.vocabularies import BYTE_BPE, BYTE_BPE_RANKS, PIECES
from loomline.session import fresh_dir, remove_dir, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_quality(docs.select(COLUMNS), PIECES)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return drop_near_copies(docs.select(COLUMNS))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; the secrets in their texts are masked."""
    return mask_secrets(docs.select(COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, or up to three times."""
    return take_mix(docs.select(COLUMNS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with the sequence and the place they are packed to."""
    return best_fit_packing(docs.select(COLUMNS), BYTE_BPE, BYTE_BPE_RANKS)


STAGES = [("quality rules", quality), ("near-dedup", near_dedup), ("secrets", secrets), ("source mix", mix), ("packing", packing)]

#: Fingerprints by XXH64, tokenisers and the packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn on ``documents``, each result written to the shared folder and read again.

    What a stage has read is removed when its own result is written, so that one copy of the documents is left, which the
    last stage reads.
    """
    docs, read = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        folder = fresh_dir(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if read:
            remove_dir(spark, read)
        read = folder
    return STAGES[-1][1](spark, docs, sf_dir)
