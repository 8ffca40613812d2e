"""A corpus from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession

from tickframe.llm import common, jaccard_join, mixing, quality, secrets, sentencepiece_lattice


_left: list[DataFrame] = []


def stage(f):
    """A stage's result is written before the next stage begins, which then drops what the one before has stored on its way."""

    @functools.wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for t in _left:
            common.drop_written(t)
        _left.clear()
        common.release(spark)
        with common.scratch() as made:
            out = f(spark, docs, sf_dir)
        _left.extend(made)
        return out

    return run_stage


@stage
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that the base rules or the perplexity bands reject go."""
    return quality.keep_good(docs)


@stage
def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each component the document with the smallest id stays."""
    return jaccard_join.keep_one(docs, stored=False)  # docs is read from files


@stage
def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: secrets are replaced by a marker and n_chars follows; no document goes."""
    return secrets.redact_secrets(docs)


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents appear as often as the mix takes them, up to twice."""
    return mixing.mixture(docs)


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: doc_id, n_tokens, ids and round_trip of every document of the mix."""
    return sentencepiece_lattice.encode(docs, stored=False)  # docs is read from files


STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("secret scans", redact),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding", encode),
]

#: Language models, components and lattices are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{common.shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, step) in enumerate(STAGES[:-1]):
        step(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
        common.release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
