"""The corpus pipeline: quality rules, near-dedup, decontamination, personal data, encoding.

STAGES are (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents, whatever they are.

In every stage a null text is empty, rows that repeat an id and a text are judged alike, and no documents give none;
what else a stage does with nulls and ties stands with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dwelltime.llm import bag_minhash, decontaminate, personal_data, quality_rules, sentencepiece
from dwelltime.llm.tables import keep_table, prepare, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned decision list rejects go.

    An empty text has too few words and goes. Without labels nothing is learned and the base rule decides alone.
    """
    rules = quality_rules.learn(docs, table(prepare(spark), sf_dir, "labels"))
    return quality_rules.filter_quality(docs, rules)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, that with the smallest doc_id.

    Ids go before nulls; of texts with equal ids that with the smallest hash stays, and of rows that repeat an id and a
    text one. Texts without a word are alike if they are equal.
    """
    prepare(spark)
    return bag_minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null items and items without a word are held by nothing; without items every document stays.
    """
    return decontaminate.clean(docs, table(prepare(spark), sf_dir, "benchmark"))


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind.

    A text without personal data stays as it is, null too. Where spans of two kinds overlap, the one that starts
    first is named, of those that start together the one that ends first, then the kind listed first.
    """
    prepare(spark)
    return personal_data.mask(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every text, with proof that they decode to it.

    An empty text has no pieces. Of paths with equal scores the one the operator's tie rule names is taken.
    """
    prepare(spark)
    return sentencepiece.encode_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal data", personal),
    ("encoding", encoding),
]

#: Learned rules, sketches and Viterbi paths have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each from what the one before has written."""
    docs = table(prepare(spark), sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = keep_table(docs, f"stage{number}")
    return docs
