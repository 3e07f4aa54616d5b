"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept and returns documents
with the columns of the ``documents`` table; the last one returns the pieces of the packed
sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbook.llm import lang_id, line_rules, mixing, near_dup, packing
from signalbook.llm.store import document_columns, stored

#: A document whose best language is less sure than this is rejected.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; null texts and texts without letters go.

    The score is a probability among the learned languages, near 1 for almost
    any text with letters, so the stage rejects no text for being in another one.
    """
    docs = document_columns(docs)
    langs, table = lang_id.fit(docs)
    told = lang_id.predict(docs, langs, table)
    sure = (F.col("lang_pred") != lang_id.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return document_columns(told.filter(sure))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their hosts' boilerplate lines.

    Null texts go, having no words; repeated rows stay or go together; documents
    without a source are one host.
    """
    return line_rules.cleaned(document_columns(docs))


def deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id.

    Of rows that repeat that id, one with the group's text stays.  Documents
    without an id, which cannot be the smallest, stay if their group has none.
    """
    return near_dup.deduplicated(document_columns(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents cut at the budget, or repeated.

    The mix draws by id and text, so repeated rows are drawn alike; a null
    source is one, a text without words takes no part in a budget.
    """
    docs = document_columns(docs).withColumn("size", mixing.word_count(F.col("text")))
    docs = docs.withColumn("tie", F.md5(F.col("text").cast("binary")))
    mixed = mixing.repeated(mixing.mix(docs, "size", ["tie"], weights=[3, 1, 2]), "size")
    return document_columns(mixed.withColumn("n_chars", F.length("text").cast("bigint")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its place in a sequence; a null
    text is empty and has one piece, repeated rows are packed each."""
    return packing.packed_documents(document_columns(docs), length=2048)


STAGES = [
    ("language_id", language),
    ("quality_rules", quality),
    ("near_dedup", deduplication),
    ("source_mix", mixture),
    ("packing", packed),
]

#: The language stage fits a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
