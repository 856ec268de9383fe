"""The corpus pipeline: stages over `documents`, each reading what the one before kept.

All stages but the last return the columns of `documents`; the last returns the
rows of a packed id matrix. Every stage handles nulls, empty and repeated rows,
empty tables and further columns as its operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymark.llm.common import stored, table
from tallymark.llm.decontamination import remove_contaminated
from tallymark.llm.language import drop_unidentified
from tallymark.llm.minhash import drop_near_duplicates
from tallymark.llm.mixing import mix_documents
from tallymark.llm.tokens import pack_documents, packing_vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified (operator 3)."""
    return drop_unidentified(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by five-word shingles at 0.8 (operator 9)."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark passages (operator 10)."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (operator 5)."""
    return mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids (operator 6)."""
    return pack_documents(docs, *packing_vocabulary())


STAGES = [
    ("language", identify_language),
    ("near-duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("packing", pack),
]

#: Models and drawn copies can't be told in SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each stage keeps is stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
