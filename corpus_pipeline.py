"""A training-data pipeline over the table ``documents``.

Each stage calls one operator of ``starloom.llm``; its result is written as
Parquet and read again as the documents of the next.  Stages see and decide on
everything that their predecessor kept:

1. ``toxicity``: documents that the toxicity model rejects go.
2. ``line_dedup``: lines of recurring templates go; documents stay, also when
   nothing is left of their text.
3. ``near_dedup``: of a component of near copies (five-word shingles,
   similarity 0.8 or more) the document with the smallest id stays.
4. ``decontaminate``: documents with a passage of ``benchmark`` go.
5. ``mix``: how many words of each document the mix takes.

``n_chars`` follows the text.  An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.bbit_minhash import drop_near_duplicates
from starloom.llm.common import staged, table
from starloom.llm.decontam import decontaminate
from starloom.llm.line_templates import drop_recurring_lines
from starloom.llm.pivotal_mix import digest as mixed
from starloom.llm.toxicity import reject_toxic

#: Share of hit words from which on a document counts as contaminated: any.
MAX_COVERAGE = 0.0


def _as(docs: DataFrame, out: DataFrame) -> DataFrame:
    """The columns of ``docs``, with ``n_chars`` as the text now has them."""
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return reject_toxic(docs, table(spark, sf_dir, "labels")).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _as(docs, drop_recurring_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, words=5, percent=80).select(docs.columns)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _as(docs, decontaminate(docs, table(spark, sf_dir, "benchmark"), max_coverage=MAX_COVERAGE))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", contamination),
    ("mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: Learned scores, components and hashed draws are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None
