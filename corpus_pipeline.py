"""From raw documents to packed training sequences: five stages over the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rinkstat.llm import stages
from rinkstat.llm.common import stored, table

STAGES = [
    ("quality rules", stages.quality_rules),
    ("near-duplicates", stages.near_duplicates),
    ("secret scans", stages.secret_scans),
    ("mixing", stages.mixing_to_weights),
    ("packing", stages.best_fit_packing),
]

#: Learned rules and the tokenizer are beyond SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each result written and read again before the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
