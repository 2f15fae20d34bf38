"""Corpus pipeline: quality rules, near duplicates, repeated substrings, decontamination, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``. All but the last return
the columns of ``docs``, with fewer rows or, in the substring stage, shorter
texts; the last returns the packed pieces. A stage works on all that the one
before has kept.

Near duplicates are linked from a similarity of 0.8 on, and the packed pieces carry their
token ids. Defined cases: a null, empty or short text fails the quality rules, which take it out; a
later stage that meets one keeps it as it is, and packing gives it the end token alone. Repeated rows and
equal texts are near duplicates: the smallest id stays, of equal ids one row, and a row without an id
only where no near duplicate has one. Extra columns pass through, whatever their names. Empty
tables give empty results in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.llm.common import stored
from lakevault.llm.decontaminate import find_contamination
from lakevault.llm.near_dedup import keep_one_of_each
from lakevault.llm.pack import pack_documents
from lakevault.llm.quality_rules import apply_quality_rules
from lakevault.llm.substrings import remove_repeats


#: hundredths of the union of two documents' shingles that they share, at least, to be linked
NEAR = 80


def _unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name = "_" + name
    return name


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose domain does."""
    rules = _unused(docs, "rules")
    return apply_quality_rules(docs, result_col=rules).where(F.col(rules)["kept"]).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group of near duplicates."""
    return keep_one_of_each(docs, percent=NEAR)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without words in 20-word windows that start earlier in the corpus.

    ``n_chars``, where it is a column, follows the new text. An untouched text stays as it is.
    """
    dedup = _unused(docs, "dedup")
    cut = remove_repeats(docs, result_col=dedup)
    shorter = F.col(dedup)["n_removed"] > 0
    changed = {"text": F.when(shorter, F.col(dedup)["text"]).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        length = F.length(F.col(dedup)["text"]).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(shorter, length).otherwise(F.col("n_chars"))
    return cut.withColumns(changed).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = _unused(docs, "contamination")
    return find_contamination(docs, benchmark, result_col=found).where(F.col(found)["n_hit"] == 0).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept texts, tokenised and packed: pieces with their ids and places."""
    return pack_documents(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_substrings", repeated_substrings),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: packing runs a tokenizer, which SQL cannot express; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
