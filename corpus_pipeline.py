"""The corpus pipeline: quality rules, near duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs; all but the last return the columns of
documents. Every stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosegrid.llm import chosen_path, common, mixing, packing, quality, secrets, tokens
from dosegrid.sources.shared import noted

#: Of the mixing stage: the largest rate, and what rates away from one weigh.
MOST, RIDGE = 4.0, 1e-3
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or that a learned rule rejects go."""
    featured = common.kept(quality.with_statistics(docs), "pipeline_quality")
    return quality.judged(featured, _labels(spark, sf_dir)).where("kept").select(*COLUMNS)


def similarity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the documents with the smallest id stay; documents without an id all stay."""
    classes = chosen_path.similarity_classes(docs)
    first = classes.where("doc_id = class_id").select("doc_id").distinct()
    return docs.join(first, "doc_id", "left_semi").unionByName(docs.where("doc_id is null")).select(*COLUMNS)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by its kind in brackets; n_chars follows."""
    cut = secrets.redact(docs.select(*COLUMNS))
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document stays if a number drawn from its id is under its rate; rates of one and more always stay. Rates keep near one where a target is hard to reach, so that a domain without documents does not cost the others theirs."""
    rates = mixing.mixed(docs, _labels(spark, sf_dir), most=MOST, ridge=RIDGE)[0].select("doc_id", "rate")
    drawn = F.crc32(F.concat_ws("|", F.lit("mixing"), F.col("doc_id").cast("string")).cast("binary")) / F.lit(float(1 << 32))
    chosen = rates.where(drawn < F.col("rate")).select("doc_id").distinct()
    return docs.join(chosen, docs["doc_id"].eqNullSafe(chosen["doc_id"]), "left_semi").select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, tokens.default_path())


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", similarity_stage),
    ("secret_scans", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
#: The learned rules, the mixing model and the tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    folder = noted(f"{common.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}")  # stays until it is cleared, for the result is read from it
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(path := f"{folder}/{k}-{name}")
        docs = spark.read.parquet(path)
    return docs
