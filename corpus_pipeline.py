"""Training-corpus pipeline over ``documents``.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from granary.llm import mixing, packing, simhash, suffix_dedup, toxicity
from granary.llm.common import scratch, written


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned lexicon rejects go."""
    labels = toxicity.training_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.rejected_out(docs, toxicity.fit(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.deduplicated(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has leave the text; all rows stay."""
    return suffix_dedup.cleaned(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each source as often as its target weight takes them."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", passage_dedup),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Suffix arrays, learned lexicons and tokenizers have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch() as keep:
            docs = keep(written(stage(spark, docs, sf_dir), name))
    return STAGES[-1][1](spark, docs, sf_dir)
