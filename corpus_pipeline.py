"""Training-corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

quality      importance resampling against the labelled good texts; documents it rejects go
near_dedup   near duplicates (five-word shingles, similarity 0.8 and more); the smallest id of a group stays
decontaminate  documents with a word inside a benchmark window go
mix          sources to target weights; a document comes as often as it is drawn
tokens       token ids in ascending document order, as rows of the written token table

Every stage works on all that the one before kept, and all but the last return the columns of
``documents``.

Defined results for odd input, by stage: quality rejects null texts and texts without a word; given to a later stage, such
a text has no near duplicate, no hit and no words to be drawn. Rows are followed by id and text, so null and repeated ids
are no key: one row of each near-duplicate group stays whatever its ids, and repeated rows are copies. Null sources are
one source, null labels and benchmark texts count for nothing. Columns that are named like an operator's own keep their
values. Empty tables give empty stages; without labels quality keeps every document with a word.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm import decontaminate, importance, mix_sources, near_dedup, token_output
from lakestrata.llm.tables import Scratch, documents, ship_code

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return importance.accepted(docs, documents(spark, sf_dir, "labels"), Scratch(spark, "pipeline-quality"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs, Scratch(spark, "pipeline-near"))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, documents(spark, sf_dir, "benchmark"), Scratch(spark, "pipeline-benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources.mixed_documents(docs, Scratch(spark, "pipeline-mix"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, start, n_tokens, tokens of the token table."""
    ship_code(spark)
    path = Scratch(spark, "pipeline-tokens").path("out")
    token_output.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), metadata=("lang", "source"))
    return token_output.read_tokens(spark, path, docs.schema["doc_id"].dataType.simpleString(), metadata="lang string, source string")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mix", mix),
    ("tokens", tokens),
]

#: the first two and the last two stages use hashed sketches, models, draws and a tokenizer
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scratch = Scratch(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"{i}-{name}")
        if i:
            scratch.drop(f"{i - 1}-{STAGES[i - 1][0]}")
    return docs.select(*(F.col(c) for c in docs.columns))
