"""Training-data pipeline: every stage works on all that the stage before it kept.

1. toxicity: documents that the model finds toxic go.
2. near_duplicates: of each component of near copies the document with the smallest id stays.
3. decontamination: documents that hold a window of the benchmark go.
4. secrets: secrets in the texts are replaced by <secret>; all documents stay.
5. tokens: the remaining texts as byte-pair tokens and their decoded text, as digests.

Nulls, empty texts and repeated rows are kept as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lanewright.llm import bpe, decontaminate, ngram_join, secrets, toxicity
from lanewright.llm.queries import table, token_digests
from lanewright.llm.shared import settled, stored


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return settled(spark, lambda: ngram_join.keep_one(docs))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask(docs)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_digests(bpe.decode(bpe.encode(docs)))


STAGES = [
    ("toxicity", clean_language),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("tokens", as_tokens),
]

#: A trained model and a tokenizer are beyond SQL; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
