"""Documents for training: screened for toxicity, de-duplicated, decontaminated, pseudonymized and packed.

Every stage takes the documents its predecessor kept and, but for the last, returns documents with the same
columns; the last one returns the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones among them, does not reject."""
    from muster.llm.batches import bound_batches
    from muster.llm.toxicity import THRESHOLD, fit_toxicity, score_toxicity

    bound_batches(spark)
    machine = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_toxicity(docs.withColumnsRenamed({c: f"_{c}" for c in docs.columns}), machine, text_col="_text", keep=True)
    return scored.filter(F.col("score") < THRESHOLD).select(*[F.col(f"_{c}").alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of documents linked by shingle similarity."""
    from muster.llm.shingles import one_of_each

    return one_of_each(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark passages."""
    from muster.llm.contamination import mark_contaminated

    # Columns of documents go along under names that the operator has none of.
    named = docs.withColumnsRenamed({c: f"doc_{c}" for c in docs.columns})
    marked = mark_contaminated(named, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="doc_doc_id", text_col="doc_text", keep=True)
    return marked.filter(~F.col("contaminated")).select(*[F.col(f"doc_{c}").alias(c) for c in docs.columns])


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data, and their lengths brought up to date."""
    from muster.llm.surrogates import replace_entities

    replaced = replace_entities(docs)
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return replaced.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    import public_tokenizers

    from muster.llm.packing import pack_documents

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("surrogates", surrogates),
    ("packing", packing),
]
# The first stage fits a classifier and the last one tokenizes; SQL can express neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each reading what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
