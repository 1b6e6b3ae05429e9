"""The corpus pipeline: quality rules, line dedup, MinHash near-dedup, substring dedup, packing.

Each stage's result is written as Parquet and read again, so a stage starts from files and a lost executor costs no
more than its tasks; it's deleted once the next one is written. What dirty rows come to is said in the operators'
docstrings: null texts and texts of few words fail the quality rules, rows with a null doc_id stay or go as rows of
their own, repeated rows go together but for near-dedup, which keeps them (they are one document). Texts of any length
stay whole, extra columns stay up to packing, empty tables give an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from linkforge.llm import line_winnow, near_minhash, pack_binary, paragraph_minhash, quality_mcd
from linkforge.llm.common import delete, shared_dir

STAGES = [
    ("quality rules", quality_mcd.stage),
    ("line dedup", line_winnow.stage),
    ("minhash near-dedup", near_minhash.stage),
    ("substring dedup", paragraph_minhash.stage),
    ("packing", pack_binary.stage),
]
#: Robust covariance, minhashes and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            delete(spark, f"{folder}/{k - 1}")
    return docs
