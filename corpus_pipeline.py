"""A corpus pipeline of five stages over documents.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept. The first four return the columns of documents, whatever further columns
there are and whatever these are called; the last one returns a row for each
packed piece. Null and empty texts, null and repeated ids, and repeated rows go
through all stages, each as its docstring says; texts are taken whole; without
documents every stage gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, lines, packing, simhash, toxicity
from tessera.llm.common import table
from tessera.runtime import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for toxic go. Texts without words score as such and stay; without labels of both kinds all stay."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of two or more lines that occurred before (less doc_id, then place; null ids first) are cut out of their texts.

    All documents stay, some with an empty text; null texts stay null; of equal rows each is cut alike.
    """
    return lines.cleaned(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, at a similarity of 0.8 over five-word shingles, the document with the least id stays.

    Null ids come last, then the hash of the text decides; of equal rows one stays. Texts without
    words, null or empty, are one group.
    """
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go. Texts without words hold none; items without words or id are never held."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is tokenised and packed to sequences; a null or empty text is its closing id alone, equal lengths go by id."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", cut_repeated_lines),
    ("near dedup", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Tokens, fingerprints and the classifier can't be expressed in SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each reads what the one before it has written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
