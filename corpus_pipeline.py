"""Corpus pipeline: documents -> language -> quality -> near duplicates -> mixing -> pieces.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept, and returns a DataFrame; all but the
last keep the columns of documents. run() writes each stage's rows as Parquet in the shared folder and reads them again
for the next, so a lost executor never costs more than its own stage.

ORACLE_SQL is None: SQL cannot express the trained classifiers, the weighted samples and the tokenizer; the tests hold
each stage against a brute-force version instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltmart.llm import common, language_fusion, piece_spans, quality_ledger, soft_mix, weighted_minhash
from voltmart.session import scratch_path

STAGES = [
    ("language", language_fusion.stage),
    ("quality", quality_ledger.stage),
    ("near_duplicates", weighted_minhash.stage),
    ("mixing", soft_mix.stage),
    ("pieces", piece_spans.stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "corpus-pipeline")
    docs = common.documents(spark, sf_dir)
    for number, (name, stage) in enumerate(STAGES):
        out = f"{path}/{number}-{name}"
        stage(spark, docs, sf_dir).write.mode("errorifexists").parquet(out)
        docs = spark.read.parquet(out)
    return docs
