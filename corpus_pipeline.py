"""A training corpus from raw documents: each stage is one operator of
``strata.llm``, its result is written as Parquet and read back by the next.

A stage's result must be written before the next stage is called, as ``run``
does: the next one removes its intermediate tables.  All stages but the last
return the columns of documents.  The quality stage needs a trained model, so
the whole has no SQL (``ORACLE_SQL`` is None).
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import exact, jaccard, mixing, pieces, quality
from strata.llm.common import read, release, stored, tables_since, written

ORACLE_SQL = None

#: Intermediate tables of the last stage that ran.
_left: list = []


def _stage(f):
    """A stage's result is written before the next stage begins, so that one
    then removes the intermediate tables that its predecessor has left."""
    @functools.wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(_left)
        _left.clear()
        before = written()
        try:
            return f(spark, docs, sf_dir)
        finally:
            _left.extend(tables_since(before))
    return run


@_stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.5 or more; learnt from the labelled ones."""
    model = quality.trained(docs, read(spark, sf_dir, "labels"))
    score = f"__score_{uuid.uuid4().hex}"  # clashes with no column
    return quality.scored(docs, model, out=score).filter(F.col(score) >= 0.5).drop(score)


@_stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that differ at most in the case of A-Z, the largest id."""
    return exact.deduplicated(docs, keep="largest")


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (five-word shingles, Jaccard 0.8 or
    more), the smallest id."""
    return jaccard.deduplicated(docs, n=5, percent=80)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them (0, 1 or 2 times)."""
    return mixing.mixed_rows(docs)


@_stage
def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, token_ids array<int>, round_trip boolean and n_tokens long."""
    return pieces.encoded(docs, check="round_trip").withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [("quality classifier", quality_classifier), ("exact dedup", exact_dedup), ("n-gram Jaccard join", near_dedup),
          ("mixing sources", mix_sources), ("SentencePiece encoding", sentencepiece_ids)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
