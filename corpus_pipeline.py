"""The training-data pipeline over ``documents``: toxicity, line dedup, near-duplicate documents, personal data, packing.

Stages take ``(spark, docs, sf_dir)``; each works on what its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import line_dedup, ngram_join, packing, pii, toxicity
from gridlake.llm.common import table, text_batches, written
from gridlake.llm.queries import pseudonym_key

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def counted(docs: DataFrame) -> DataFrame:
    """The columns of ``documents``, with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7; the model is learned from the labels of the documents that come in.

    Null and empty texts score like a text without hits and stay, rows without id are rated and not learned from, repeated rows score alike and
    stay as often as they came. Columns other than those of ``documents`` are dropped, here and in the other stages.
    """
    text_batches(spark)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = toxicity.learn(docs.where(fold != 1), table(spark, sf_dir, "labels").where(fold != 1))
    return toxicity.scored(docs, model, COLUMNS).where("score < 0.7").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand earlier; a document of which nothing but white space is left goes, if it had more before.

    Null and empty texts have no line to lose and stay; rows that share id and text are one document and stay both.
    """
    text_batches(spark)
    rows = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return counted(rows.where("n_removed = 0 or text rlike '[^ \\\\t-\\\\r]'"))


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by five-word shingles at 0.8; rows without id stay.

    Null texts and texts without words link with nothing and stay. Rows that share an id are one document and stay or go together.
    """
    text_batches(spark)
    found = ngram_join.near_documents(docs, words=5, percent=80)
    dropped = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def hide_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms of the same form; a row each, null texts stay null and empty ones empty."""
    return counted(pii.pseudonymise(docs.select(*COLUMNS), pseudonym_key(spark)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their place in the sequences.

    Null and empty texts give one piece of the end id alone; each row is a document of its own, also if ids repeat.
    """
    text_batches(spark)
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("ngram_join", drop_near), ("pii", hide_personal), ("packing", pack)]

#: Learned scores, keyed permutations and tokens have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn on ``documents``, each on the written result of the one before; an empty table gives an empty one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
