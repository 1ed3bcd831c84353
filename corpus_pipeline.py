"""The training-data pipeline over `documents`: stages in order, each written as Parquet and read by the next.

Quality and toxicity drop what their classifiers reject, near-duplicates leave one document per group, the mix repeats or
skips documents to meet the sources' weights, and the last stage encodes what is left. The classifiers are fitted on the
labelled documents among those their stage receives.

Near-duplicates are those of the SimHash operator with its contract's shingle length and bit distance.

Defined cases: a null text is empty in every stage; a null id is never a label's; of documents without an id that are
near-duplicates of each other alone, any one stays; repeated rows are one group of near-duplicates; documents with equal ids and
different texts are judged by their texts; an empty table gives no rows; other columns pass through all stages but the last, but
a column named like a stage's own (`_stage_score`, `_fp`) is left out before that stage and null behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import bpe, gam, mixing, simhash, toxicity
from tidegauge.llm.queries import vocabulary
from tidegauge.operators.scale import stage
from tidegauge.sources.readers import table

THRESHOLD = 0.7
SCORE = "_stage_score"
OWN = (SCORE, "_fp")  # columns that stages make for themselves


def like(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The kept rows with the columns of `docs`; those that a stage needed the name of are null."""
    empty = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema.fields if f.name in OWN}
    return kept.select([empty.get(c, F.col(c)) for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = gam.train(docs, table(spark, sf_dir, "labels"))
    return like(docs, gam.score(docs, model, SCORE).filter(f"{SCORE} >= {THRESHOLD}"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not found toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return like(docs, toxicity.score(docs, model, SCORE).filter(f"{SCORE} < {THRESHOLD}"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return like(docs, simhash.one_of_each(docs.drop(*OWN)))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their target weights; a document may come up to three times."""
    return mixing.mix(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each remaining document encoded: number and digest of its ids, and digest of the text decoded from them."""
    return bpe.encode_report(docs, vocabulary())


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mix", mix_stage),
    ("encode", encode_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over the whole table."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Boosted trees, restored words and hashed shingles are beyond SQL; the tests hold the rows against a brute-force version.
ORACLE_SQL = None
