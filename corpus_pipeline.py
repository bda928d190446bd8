"""A text corpus made ready for training: documents are filtered, thinned, decontaminated, sanitised and packed, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of documents. What happens to nulls,
empty texts, repeated rows, empty tables and clashing columns is stated by the operators that the stages call.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyfold.llm import decontamination, jaccard, packing, pii, quality, simhash
from tallyfold.llm.common import saved, stage_scratch


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(f: Stage) -> Stage:
    """A stage removes the tables that the stage before left in the shared folder, since its own input is that one's written result."""

    @wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with stage_scratch(spark, docs):
            return f(spark, docs, sf_dir)

    return run


@stage
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose most likely grade is the top one, by a model fitted on labelled ones among them."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@stage
def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by SimHash fingerprints within two bits, found in the byte-position index, or by a
    Jaccard similarity of five-word shingle sets of 0.8 or more."""
    return simhash.keep_one(docs, jaccard.near_copies)


@stage
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@stage
def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and what discloses it taken out of their texts."""
    return pii.sanitised(docs)


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: a row per piece of a document, with its ids as 16-bit little-endian numbers."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: Regression, fingerprints and tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product of all stages, a row per piece of a document with its token ids. The last stage is not run before it is read."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = saved(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
