"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.lines import line_stage
from tidemark.llm.minhash import near_stage
from tidemark.llm.mixing import mix_stage
from tidemark.llm.packing import pack_stage
from tidemark.llm.shared import documents, written
from tidemark.llm.weak import quality_stage

#: Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("minhash_near_dedup", near_stage),
    ("mix_sources", mix_stage),
    ("packing", pack_stage),
]

#: A trained classifier, similarity components and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: every piece of every document that stays, with its place."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
