"""The corpus pipeline: stages over ``documents``, each one operator of ``tidewater.llm``.

Quality rules drop documents, the n-gram Jaccard join keeps the smallest document of each group
of near copies, substring dedup takes repeated passages out of the texts, and packing cuts what
is left into training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.chunk_dedup import remove_repeats
from tidewater.llm.packing import pack
from tidewater.llm.parity_join import ngram_components
from tidewater.llm.quality_trees import quality_rules, train
from tidewater.llm.queries import BYTE_BPE, table
from tidewater.llm.storage import shared_folder

BROADCAST_ROWS = 500_000


def _free(name: str, docs: DataFrame) -> str:
    """``name``, or with underscores before it, that no column has."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept. A null or empty text fails; repeated rows and null
    ids are judged by their text like others; an empty table stays empty."""
    verdict = _free("_quality", docs)
    judged = quality_rules(docs, train(docs, table(spark, sf_dir, "labels")), result_col=verdict)
    return judged.where(F.col(verdict)["kept"]).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that reach a smaller one by links of similar shingles.

    Different texts under one id are different documents, in the order of the texts; of rows with
    one id and text the one with the least other columns (as JSON) stays. Rows with a null id all
    stay; null and empty texts are near nothing and stay, but copies under one id are one row; an
    empty table stays empty.
    """
    if not docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        folder = shared_folder(spark, "pipeline-rows")
        row = _free("_row", docs)
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        rows = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("i"), F.col("text").alias("t")).agg(F.min_by(whole, F.to_json(whole)).alias("r")) \
            .select("i", "t", "r").repartitionByRange("i", "t").sortWithinPartitions("i", "t").select("r.*", F.monotonically_increasing_id().alias(row))
        rows.unionByName(docs.where("doc_id is null"), allowMissingColumns=True).write.parquet(folder)
        rows = spark.read.schema(T.StructType([*docs.schema.fields, T.StructField(row, T.LongType())])).parquet(folder)
        return _without_copies(spark, rows, row).select(docs.columns)
    return _without_copies(spark, docs, "doc_id")


def _without_copies(spark: SparkSession, docs: DataFrame, id_col: str) -> DataFrame:
    found = ngram_components(docs, shared_folder(spark, "pipeline-shingles"), id_col=id_col)
    copy = _free("_copy", docs)
    copies = found.where("doc_id <> component_id").select(F.col("doc_id").alias(copy)).distinct().checkpoint()
    if copies.count() <= BROADCAST_ROWS:
        copies = F.broadcast(copies)  # at most BROADCAST_ROWS integers
    return docs.join(copies, docs[id_col] == copies[copy], "left_anti")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one holds; ``n_chars``, where there is such a
    column, follows the text. Null texts stay null; rows with a null id come after all others; an
    empty table stays empty."""
    cleaned = remove_repeats(docs, result_col=_free("_chunks", docs))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens. A null text packs as an empty one; repeated
    rows and null ids are packed each; an empty table gives no pieces."""
    return pack(docs, BYTE_BPE)


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_copies), ("substring dedup", repeated_passages), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each one's documents are written to the shared folder and read again. With an
    empty ``documents`` table, or none that a stage keeps, there are no pieces."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            folder = shared_folder(spark, f"pipeline-{number}")
            docs.write.parquet(folder)
            docs = spark.read.schema(docs.schema).parquet(folder)
    return docs
