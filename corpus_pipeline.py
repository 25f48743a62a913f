"""A training-data pipeline over documents: toxic ones go, one of each group of near duplicates stays, leaked test items
go with their documents, personal data is masked, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs, other columns
included, whatever their names. Every stage takes an empty table (and gives one) and very long texts, which it reads whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidepanel.llm import decontam, neardup, packing, pii, toxicity
from tidepanel.llm.common import table, written


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score is below 0.5. Null and empty texts have the score of a text without features and stay, unless most
    labelled texts are toxic; repeated rows share one fate; rows without an id are scored like others."""
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five-word shingles, similarity 0.8): that of the smallest id, the smallest text where
    rows share that id; rows without an id come last. Null and blank texts are in no group and stay, but rows that share an id always count as one document."""
    return neardup.deduplicated(docs, k=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows into which no item of benchmark leaks. Null and empty texts stay; repeated rows share one fate; null or empty items match nothing."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; spans of personal data in their texts are replaced by their kinds in brackets. Null texts stay null, empty ones empty."""
    return pii.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the token ids with their sequence and place. A null text is an empty one; repeated rows and rows without an id are packed each."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("packing", packed),
]
#: SQL expresses neither the trained models nor the tokenizer; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; between two stages the rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
