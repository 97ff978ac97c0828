"""A corpus pipeline: quality rules, near duplicates, decontamination, mixing, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palimpsest.llm import decontaminate, mixing, ngram_join, quality_rules, token_output
from palimpsest.llm.common import materialize, table

#: (name, function of (spark, docs, sf_dir)); each result is written as Parquet and reread as the next one's docs.
STAGES = [
    ("quality_rules", quality_rules.stage),
    ("ngram_join", ngram_join.stage),
    ("decontaminate", decontaminate.stage),
    ("mixing", mixing.stage),
    ("token_output", token_output.stage),
]

#: Mixing draws at random and token ids come from a tokenizer: SQL has neither (see tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
