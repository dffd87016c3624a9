"""The corpus pipeline: quality, line dedup, n-gram join, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's
docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postalith.llm import lines, mixing, ngram_join, packing, quality
from postalith.llm.common import Scratch
from postalith.llm.queries import table, tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model, taught by all labels of these documents, does not reject.

    Null and empty texts have scores like any other and may stay. Repeated rows and rows with null ids are judged one
    by one, by their text alone. Very long texts are scored whole. Without labels nothing is rejected, and an empty
    table gives an empty one. Columns named score or predicted are the documents' own and stay.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    judged = quality.score(docs, model, names=("_quality", "_good"))
    return judged.where("_good = 1").select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with one occurrence of every fuzzy line; documents whose every line stands elsewhere go.

    Null and empty texts stay as they are. Rows that repeat id and text keep the same lines; a null id comes first in
    the order that decides whose line stays. n_chars, where there is such a column, is counted again. An empty table
    gives an empty one. A column named removed_lines is the documents' own and stays.
    """
    found = lines.dedup(docs, Scratch.stage(spark, "pipeline-lines"), removed="_removed")
    empty = F.coalesce(F.trim("text") == "", F.lit(True))
    found = found.where(~(empty & (F.col("_removed") > 0)))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return found.select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of n-gram near-duplicates.

    Documents without words, or null, are in no group and stay, as do rows with a null id, which are never judged.
    Rows that repeat the smallest id all stay. Very long texts are compared whole. An empty table gives an empty one;
    other columns, whatever their names, come along.
    """
    found = ngram_join.connect(docs, Scratch.stage(spark, "pipeline-ngrams", frees="pipeline-lines"))
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti").select(docs.columns)


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: up to twice, or not at all.

    A null source is a source; null texts have no words, and rows alike in id, source and text are units of their own.
    An empty table gives an empty one; other columns, whatever their names, come along.
    """
    return mixing.mix(docs, Scratch.stage(spark, "pipeline-mix", frees="pipeline-ngrams")).select(docs.columns)


def to_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 ids.

    A null or empty text is one id, a very long one as many pieces as it needs; a document that the mix repeats is
    packed as often. An empty table gives an empty one; other columns play no part.
    """
    return packing.pack(packing.pieces(docs, tokenizer_path()), Scratch.stage(spark, "pipeline-pack", frees="pipeline-mix"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("lines", drop_lines),
    ("ngrams", one_of_each),
    ("mixing", to_weights),
    ("packing", to_sequences),
]

#: Trained scores, connected groups, random lots and byte pairs are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = scratch.keep(docs, name)
    return docs
