"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the
last return the columns of ``documents``. ``run`` writes each stage's rows as Parquet into the
shared checkpoint folder and reads them again. SQL does not express the learned first stage,
so the pipeline is tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adoptlens.llm import decontaminate, jaccard_join, packing, quality, suffix_dedup
from adoptlens.llm.queries import tokenizer_file
from adoptlens.llm.tables import read, stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality.train(docs, read(spark, sf_dir, "labels"), sample=3000)
    return quality.keep(docs, model, threshold=0.3)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: 5-word shingles, at least 80 in 100."""
    return jaccard_join.keep_one(docs, size=5, percent=80)


def repeated_text_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that a smaller document holds are cut out of the text."""
    return suffix_dedup.cut(docs, window=50)


def contamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"), n=13, share=20)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 2048 ids."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("suffix-array dedup", repeated_text_stage),
    ("benchmark decontamination", contamination_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the pieces of the last one."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
