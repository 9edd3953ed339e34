"""A corpus from raw documents to packed sequences, stage by stage.

Every stage takes what its predecessor kept, decides about those rows, and its
result is written as Parquet and read again before the next stage. All but the
last keep whole rows of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from silverbrook.llm.common import stored, table
from silverbrook.llm.decontamination import drop_contaminated
from silverbrook.llm.exact_dedup import drop_repeats
from silverbrook.llm.language_id import documents_in_known_languages, learn
from silverbrook.llm.near_dedup import drop_near_repeats
from silverbrook.llm.packing import pack_documents
from silverbrook.llm.queries import tokenizer_file

#: Pooled probability below which no language is taken as known: less sure than
#: the documents of any one language are, more than an even choice among four
#: (with more learned languages it falls in proportion).
MIN_SCORE = 0.4
#: Units that a worker's encoder remembers, some 50 MB: by the last stage an
#: executor also holds what the stages before have left.
UNITS = 250_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in no language that the labelled ones teach, go.

    Where no labelled document teaches a language, all with letters stay.
    """
    return documents_in_known_languages(docs, learn(docs), MIN_SCORE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text stays, that with the smallest doc_id."""
    return drop_repeats(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the smallest doc_id."""
    return drop_near_repeats(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage within the edit budget go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their ids."""
    return pack_documents(docs, tokenizer_file(), with_ids=True, units=UNITS)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", benchmark),
    ("packing", packing),
]

#: A trained network, MinHash, edit distances and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
