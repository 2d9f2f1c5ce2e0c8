"""A training corpus from the documents table, in five stages.

1. ``language``: the language of every text is identified; texts without one (no letter) go.
2. ``near_duplicates``: of every group of near-duplicate documents the one with the smallest id stays.
3. ``decontaminate``: documents that quote a benchmark window go.
4. ``mix``: whole blocks of scarce sources are taken again until every source has its target share.
   Nothing is dropped; a document's epoch shows in its repeated rows.
5. ``tokens``: all documents become compressed token files in ascending id order; the rows are
   the files' index with checksums.

Each function takes (spark, docs, sf_dir). All but the last return the columns of documents, whatever they are called.

Odd input: a null, empty or letterless text has no language and goes in the first stage, so later ones see
none; rows without id are kept until the last stage and come first there; of rows that repeat an id, all
stay or all go; very long texts are read whole; an empty table passes through as one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import decontaminate, language_id, mixing, ngram_join, token_files
from tarmac.llm.common import ship, stored
from tarmac.llm.queries import MIX_POWER, TOKENIZER, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language could be told. ``lang`` stays as it was labelled.

    Where no language could be learned, none can be told; texts with a letter stay all the same.
    """
    ship(spark)
    model = language_id.train(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    known = language_id.identify(docs, model)
    return known.where(F.col("lang_pred") != language_id.UNKNOWN).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component.

    A row goes if a document with its id is in a component of a smaller one; rows without id stay.
    """
    ship(spark)
    found = ngram_join.near_duplicates(docs)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    # Both sides have names, as documents may have any column.
    same = F.col("every_document.doc_id") == F.col("gone_document.doc_id")
    return docs.alias("every_document").join(gone.alias("gone_document"), same, "left_anti")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word in a window of the benchmark."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("spans") == 0).select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes their block."""
    ship(spark)
    parts = stored(mixing.tempered_parts(mixing.source_counts(docs), MIX_POWER), "parts")
    return mixing.mix(docs, parts).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the token files."""
    ship(spark)
    return token_files.digest(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", without_benchmark),
    ("mix", mix),
    ("tokens", tokens),
]

#: Language models and tokenizers are not expressible in SQL; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
