"""Corpus preparation: the stages that turn documents into packed sequences.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir),
works on all rows its predecessor kept and returns a DataFrame. All but the
last return the columns of documents.

Null texts count as empty, in every stage; rows with a null id are scored like any other, are
never taken for duplicates and are packed; rows that repeat an id and text stay or go together
(one of them stays in near-dedup). Texts are read whole. An empty table gives no rows. Further
columns, whatever their names, come through the first three stages unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import packing, quality, simhash, toxicity
from strata.llm.common import materialize, table
from strata.llm.queries import (MAX_BITS, SHINGLE, THRESHOLD, quality_model, toxicity_model)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects go."""
    model = toxicity_model(spark, docs, sf_dir)
    return docs.where(toxicity.toxicity_score(spark, model, F.col("text")) < THRESHOLD)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality_model(spark, docs, sf_dir)
    return docs.where(quality.quality_score(spark, model, F.col("text")) >= THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the smallest doc_id."""
    return simhash.keep_one_each(docs, "doc_id", "text", SHINGLE, MAX_BITS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Everything kept, packed into sequences; returns the placed pieces."""
    return packing.pack_documents(docs, "doc_id", "text", added_tokens=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_duplicates),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order on documents; each stage's rows are written and read again.

    A stage's rows are removed when the next one's are written.
    """
    docs, written = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = written = materialize(stage(spark, docs, sf_dir),
                                     f"stage-{name.replace(' ', '-')}", instead_of=written)
    return docs


#: The stages learn models and fit packings, which SQL cannot express.
ORACLE_SQL: str | None = None
