"""A training-data pipeline over ``documents``: five stages, each stored before the next reads it.

Run by :func:`run`, or stage by stage from ``STAGES``. Every stage takes what the one
before kept and has the columns of ``documents``, but for the last, which returns packed pieces.
Models are fitted on the stage's own input. Rows with NULL in any column, repeated rows and
extra columns pass as the operators say; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmatch.llm import queries as q
from kinmatch.llm.common import table, written
from kinmatch.llm.decontam import decontaminate
from kinmatch.llm.langid import UNDETERMINED, learn_languages, with_language
from kinmatch.llm.packing import pack
from kinmatch.llm.simhash import keep_one
from kinmatch.llm.toxicity import with_toxicity

# Least mean probability of a document's language; below, no language is told.
LEAST_SCORE = 0.3


def _kept_apart(docs: DataFrame) -> DataFrame:
    """The text beside the whole row, so that no column of ``docs`` can clash with an added one."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].alias("text"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain does not call toxic; all, if it has learned nothing of that."""
    chain = q.toxicity_chain(docs, table(spark, sf_dir, "labels"))
    found = with_toxicity(_kept_apart(docs), chain, ["p_low_quality", "p_toxic"])
    return found.where(~q.is_toxic(chain)).select("row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network tells; those without letters or any clear language go."""
    network = learn_languages(docs)
    found = with_language(_kept_apart(docs), network)
    sure = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return (found.where(sure) if network.labels else found).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates, that with the smallest id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    return q.packed_digest(pack(docs, q.tokenizer_path("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", toxicity),
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

# Fitted models, XXH64 and tokenizers are beyond SQL; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0].lower()}")
    return docs
