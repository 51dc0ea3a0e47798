"""From raw documents to packed training sequences.

Documents that the quality classifier rejects go, then exact copies, then near copies; what
is left is mixed to target weights in one epoch and packed. Every stage reads all that the
one before it kept. Null and empty texts are judged by the classifier like any other; at
the latest the mixing leaves them out, as they have no tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from signalstar.llm import chosen_path, content_sort, mixing, ordinal, packing
from signalstar.llm.common import read, stored
from signalstar.llm.queries import MIX_PERCENT, MIX_SEED, MIX_WEIGHTS, mix_levels


# What moves to Python at once, in bytes: it is held several times over on both sides.
BATCH_BYTES = "8m"


def _in_small_batches(spark: SparkSession) -> None:
    """Sets the session's bound on batches; results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trained on the ratings of these documents; poor ones go."""
    _in_small_batches(spark)
    return ordinal.kept_documents(docs, read(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return content_sort.kept_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _in_small_batches(spark)
    return chosen_path.kept_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.kept_documents(docs, mix_levels(), MIX_WEIGHTS, MIX_PERCENT, MIX_SEED)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _in_small_batches(spark)
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing to target weights", mix),
    ("packing", pack),
]

# Neither the classifier nor the encoder can be said in SQL; the tests compare each stage
# with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
