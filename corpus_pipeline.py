"""From raw documents to token digests of a mixed corpus.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept. All
but the last return the columns of ``documents``.

Every decision is about a row's own text: rows that share an id, or have none, do not speak
for each other. Null, empty and blank texts are rejected by the first stage; further columns
are carried along. Rows that repeat id and text are one document from the second stage on. An
empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabproof.llm.bpe import token_digests
from tabproof.llm.exact_dedup import drop_exact_duplicates
from tabproof.llm.mixing import take_mix
from tabproof.llm.near_dedup import drop_near_duplicates
from tabproof.llm.quality import keep_quality
from tabproof.llm.spool import spool

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier fitted on them does not reject."""
    return keep_quality(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return take_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row, round trip included."""
    return token_digests(docs, TOKENIZER)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mix),
    ("bpe", tokens),
]

#: The classifier, the near duplicates and the tokenizer cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = spool(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
