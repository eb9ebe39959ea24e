"""From raw documents to encoded training text in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``.  All but the last
return the columns of ``docs``.  ``run`` applies the stages to the documents of a folder.
"""

from __future__ import annotations

import sys
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fiscoframe.llm import exact_dedup, mixing, near_dedup, pieces, quality  # noqa: E402
from fiscoframe.llm.common import table  # noqa: E402
from fiscoframe.llm.queries import tokenizer_path  # noqa: E402
from fiscoframe.session import remove_at_end, work_folder  # noqa: E402


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.drop_near(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and ids of every row of the mix."""
    return pieces.encoded(docs, tokenizer_path("piece_bpe_32k.model"), with_ids=True)


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("mixing", mix),
    ("encoding", encode),
]

#: Trained scores and the tokenizer have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of a folder; every stage's result is stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{work_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    remove_at_end(spark, folder)
    return docs
