"""The corpus pipeline: quality rules, toxicity, near duplicates, packing.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and works on every row it is given. All but the last return the
columns of ``documents``; the last returns the packed pieces. ``run`` writes
each stage as Parquet in the session's shared checkpoint folder and reads it
again as the next one's input, so a lost executor never replays earlier stages.
Null text counts as empty (and is rejected by the base rules); an empty table passes through as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layercake.llm import decision_list, packing, simhash, toxicity
from layercake.llm.common import ship, table
from layercake.llm.queries import BPE
from layercake.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned decision list reject."""
    return decision_list.keep_clean(docs, decision_list.fit(docs, table(spark, sf_dir, "labels")))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores under one half."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash (three-word shingles, at most 3 bits apart)."""
    ship(spark)
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    ship(spark)
    return packing.pack_documents(docs, BPE)


STAGES = [("quality_rules", quality_rules), ("toxicity", toxic), ("near_duplicates", near_duplicates), ("packing", pack)]

ORACLE_SQL = None  # learned models, reachability and tokenisation have no SQL form; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
