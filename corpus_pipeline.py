"""From raw documents to token ids in five stages, each written to the shared folder before the next.

Rows are told apart by ``_row``: the document id and a hash of all columns. It depends on the content alone, so a
lost task finds the same rows again; rows that agree in every column are interchangeable.

Stages that drop rows store the ``_row`` that stay, and delete what they stored to find them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.llm import bpe, contamination, near, rules, suffix
from cohortweave.llm.blocks import stored_alone
from cohortweave.session import fresh_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _rows(docs: DataFrame) -> DataFrame:
    """The columns of documents and ``_row``, ordered like the document ids of 0 and more."""
    listed = ", ".join(f"`{c}`" for c in COLUMNS)
    return docs.selectExpr(*[f"`{c}`" for c in COLUMNS], f"concat(coalesce(format_string('%019d', doc_id), 'none'), ':', hex(xxhash64({listed}))) AS _row")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rule or a learned rule; labels belong to document ids."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = _rows(docs)
    # Labels by row; a label of several rows of one id counts for each.
    marked = rows.select("_row", F.col("doc_id").alias("_id")).join(labels.select(F.col("doc_id").alias("_id"), "quality"), "_id").select("_row", "quality")
    kept = stored_alone(spark, "good-rows", lambda: rules.judge(rows, marked, key="_row").filter("kept").select("_row").distinct())
    return rows.join(kept, "_row", "left_semi").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies keep the document of the least id; documents without words all stay."""
    rows = _rows(docs)

    def first_rows() -> DataFrame:
        classes = near.link_classes(rows, key="_row")
        return classes.filter("n_shingles = 0 OR _row = component_id").groupBy("_row").agg(F.max("n_shingles").alias("_n"))

    kept = stored_alone(spark, "first-rows", first_rows)
    joined = rows.join(kept, "_row")
    numbered = joined.selectExpr("*", "row_number() OVER (PARTITION BY _row ORDER BY _row) AS _copy")
    return numbered.filter("_copy = 1 OR _n = 0").select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that occur more than once out of the texts; every document stays."""
    rows = _rows(docs)
    cut = suffix.remove_repeats(rows, key="_row", decoded=True).selectExpr("_row", "kept AS _kept")
    rest = rows.drop("text", "n_chars").dropDuplicates(["_row"])
    return cut.join(rest, "_row").selectExpr("doc_id", "_kept AS text", "lang", "source", "cast(length(_kept) AS bigint) AS n_chars")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    rows = _rows(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    clean = stored_alone(spark, "clean-rows", lambda: contamination.decontaminate(rows, items, key="_row").filter("n_hit = 0").select("_row").distinct())
    return rows.join(clean, "_row", "left_semi").select(*COLUMNS)


def bpe_coding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the remaining documents, and the texts they decode to."""
    return bpe.encode_decode(docs).select("doc_id", "n_tokens", "ids", "decoded")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe_coding),
]

# Learned rules, component search and the tokenizer are beyond SQL; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
