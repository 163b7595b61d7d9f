"""From documents to training sequences: five stages, each over all that the one before kept.

``STAGES`` are run in order. A stage takes the session, the documents it is given and the
folder of the tables, and returns the rows that stay, with the columns of documents; the last
returns the pieces of packed sequences. Each result is written as Parquet to the folder that
all executors share and read again before the next stage.

What goes: documents in no learned language; documents of low quality; of each group of
SimHash near-duplicates all but the one with the smallest id (nulls last, then the first row);
documents that hold an item of the benchmark. A null or empty text goes at the first stage.
Each row is a document of its own: rows that share a ``doc_id``, or have none, stay or go by
their texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from typeferry.llm import decontam, language, packing, quality, simhash
from typeferry.llm.common import fresh_folder, read
from typeferry.llm.files import remove_folder


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a learned language that nothing unknown outweighs."""
    return language.identified(docs, language.learn(docs, F.col("lang").isNotNull()))


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the classifier and their sites speak for."""
    classifier = quality.learn(docs, read(spark, sf_dir, "labels"), F.lit(True))
    return quality.accepted(docs, classifier, host="source", path="lang")


def by_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return simhash.one_of_each(docs, shingle=3, radius=3)


def by_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no item of the benchmark."""
    return decontam.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed."""
    return packing.pack_documents(docs, end_id=1).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("language", by_language),
    ("quality", by_quality),
    ("simhash", by_simhash),
    ("decontamination", by_benchmark),
    ("packing", into_sequences),
]

# Trained models, components and the tokenizer are beyond SQL; tests/llm holds the stages
# against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; the folders of the stages before are removed as they are used."""
    docs, used = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = fresh_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if used:
            remove_folder(spark, used)
        used = folder
    return docs
