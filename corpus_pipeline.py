"""From raw documents to encoded training text, one operator per stage.

Each stage gets what its predecessor kept, as a table in the shared folder, and its decisions
take effect: documents that it drops don't come back. A document without id can't be told from
others by name; it passes the duplicate stages alone.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_risk.llm import bpe, dedup, mixing, near_dedup, quality
from cohort_risk.session import scope, set_root, shared_dir

VOCABULARY = "byte_bpe_50k.json"
#: The folder of a stage's intermediate tables; the next stage deletes it when it starts.
SCOPE = "pipeline-stage"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that pass the base rules and stay near their language."""
    with scope(spark, SCOPE):
        return quality.assess(docs).filter("kept").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first of documents that differ at most in runs of white space."""
    with scope(spark, SCOPE):
        return dedup.keep_one(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first of each class of near-duplicates."""
    with scope(spark, SCOPE):
        return near_dedup.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents so that sources, languages and forms meet tempered weights."""
    with scope(spark, SCOPE):
        return mixing.weigh(docs, calibrated=True).filter("sampled").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether decoding gives the text back."""
    with scope(spark, SCOPE):
        found = bpe.encode(docs, public_tokenizers.path(VOCABULARY), keep=("doc_id", "lang", "source", "text"))
    return found.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", encode),
]

#: Near-duplicates and token ids can't be told in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``, each written before the next reads it.

    Only the newest stage's output and intermediate tables stay on disk.
    """
    set_root(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    before = None
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before is not None:
            jpath = spark._jvm.org.apache.hadoop.fs.Path(before)
            jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
        before = path
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
