"""Corpus pipeline over ``documents``: quality rules, line dedup, near duplicates, decontamination, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet in the shared checkpoint
folder and reads again as the next stage's ``docs``.  All stages but the last
return the columns of ``documents``.

Defined results: rejected, duplicate and contaminated rows go, every other row
stays with its remaining lines (``n_chars`` follows the text where lines went); columns
that ``documents`` has beyond the five of ``COLUMNS`` are left out by every stage; the
operators' docstrings say what nulls, empty texts, ties and repeated rows give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import cut_lineage, table
from llm.decontam import decontaminate
from llm.jaccard import keep_one
from llm.linededup import dedup_lines
from llm.packing import pack
from llm.quality import judge
from llm.queries import vocabulary_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the trees keep."""
    return judge(docs.select(*COLUMNS), table(spark, sf_dir, "labels")).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines found in ten documents or more."""
    out = dedup_lines(docs.select(*COLUMNS), min_docs=10, min_key_chars=1)
    return out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one(docs.select(*COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, packed into sequences."""
    pieces = pack(docs, vocabulary_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: The trees, the near-duplicate groups, the alignment and the tokens have no SQL form; tests/llm/test_corpus_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
