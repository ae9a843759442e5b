"""Corpus pipeline: documents to token shards, one operator a stage.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept and returns a DataFrame; all but the last return the columns of
documents, whatever other columns there are. Decisions are by document id: a
row with a null id is judged by its text in the quality stage, and stays in
the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetbook.llm import mixing, neardup, quality, tiling, wavelet
from fleetbook.llm.common import read, without_ids
from fleetbook.llm.queries import BYTE_BPE, MIX_FRACTION, MIX_POWERS, MIX_SEED, tokenizer_path
from fleetbook.session import scratch_path, scratch_scope
from fleetbook.sources.tables import delete_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier keeps."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of least id."""
    found = neardup.near_duplicates(docs)
    return without_ids(docs, found.where(~F.col("kept")).select("doc_id"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    found = tiling.contaminated(docs, read(spark, sf_dir, "benchmark"))
    return without_ids(docs, found.select("doc_id"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sample that the raked weights draw."""
    return mixing.sampled(docs, MIX_POWERS, MIX_FRACTION, MIX_SEED)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Wavelet-matrix shards; a row per document, read back from the files."""
    path = scratch_path(spark, "pipeline-shards")
    wavelet.write_shards(docs, path, tokenizer_path(BYTE_BPE))
    return wavelet.read_documents(spark, path)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("token_shards", token_shards),
]

# SQL can't express the stages; tests/llm holds each operator against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents. What a stage writes on its way goes
    when its result is written, and that result when the next one is."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    shards = STAGES[-1][1](spark, docs, sf_dir)
    delete_path(spark, before)
    return shards
