"""From raw documents to packed token sequences, by five of the training-data operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents. All stages but the last return the
columns of documents:

1. language ID drops documents in no known language;
2. exact dedup keeps one document of each group of equal texts;
3. SimHash near-dedup keeps one document of each component of near fingerprints;
4. PII replaces personal data by its kind, and counts the characters anew;
5. packing cuts documents into tokens and places the pieces, with their ids, into sequences.

Empty tables pass through; nulls, ties and repeated rows are as the operators define them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from modelyard.llm import langid, pii, radix, simhash
from modelyard.llm.common import stored, tuned
from modelyard.llm.queries import placed_pieces, tokenizer_definition


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tuned(spark)
    return langid.identified(docs, langid.text_model(docs)).where("accepted").select("doc.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tuned(spark)
    return radix.without_duplicates(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tuned(spark)
    return simhash.one_of_each(docs, shingle=3, distance=3)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tuned(spark)
    found = pii.annotated(docs)
    clean = pii.redacted(F.col("doc.text"), "spans")
    new = {"text": clean, "n_chars": F.when(F.size("spans") > 0, F.char_length(clean)).otherwise(F.col("doc.n_chars"))}
    return found.select(*[
        new.get(c, F.col(f"doc.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns
    ])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tuned(spark)
    return placed_pieces(docs, tokenizer_definition(), with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_dedup),
    ("pii", private_data),
    ("best_fit_packing", packing),
]

#: Fingerprints, learnt models and tokenizers have no SQL form; the stages are tested
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
