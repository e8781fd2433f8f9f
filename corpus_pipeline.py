"""The corpus pipeline: five stages, each an operator of placerank.llm, over the documents table.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's docs. All but the last return the columns of documents.

Null doc_ids, texts and sources, repeated rows and an empty table are handled as the operators say. A document travels whole in one struct
column, so extra columns of any name pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from placerank.llm import exact, mixing, packing, quality, simhash
from placerank.llm.common import LOWER, UPPER, new_path
from placerank.llm.queries import table, tokenizer_file


def _whole(docs: DataFrame) -> DataFrame:
    """docs as one struct column `doc`, so that no column of docs can clash with a name used here; beside it the id as text, '' for null."""
    return docs.select(F.struct("*").alias("doc"), _id_text(F.col("doc_id")).alias("id"))


def _id_text(column: Column) -> Column:
    """Equal for equal ids and for nulls: an ordinary key, so that a join and an aggregation share one shuffle."""
    return F.coalesce(column.cast("long").cast("string"), F.lit(""))


def _digest(folded: bool) -> Column:
    """SHA-256 of the text of `doc`, null as empty; if asked for with A-Z lower-cased."""
    text = F.coalesce(F.col("doc.text").cast("string"), F.lit(""))
    return F.sha2((F.translate(text, UPPER, LOWER) if folded else text).cast("binary"), 256)


def _once(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The documents of rows (doc, id, digest), one per id and digest: that whose text and other columns hash lowest, so reruns agree."""
    rest = F.to_json(F.struct(*[F.col("doc")[c] for c in docs.columns if c != "text"]))
    tie = F.struct(F.xxhash64(F.col("doc.text")), F.xxhash64(rest))
    return rows.groupBy("id", "digest").agg(F.min_by("doc", tie).alias("doc")).select("doc.*")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the classifier does not reject, with no shuffle of texts."""
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept row of each group of equal texts, once.

    Rows are chosen by doc_id and digest: a kept doc_id that comes with another text too does not bring that text back.
    """
    kept = exact.exact_dedup(docs).filter("kept").select(_id_text(F.col("doc_id")).alias("id"), F.col("text_sha256").alias("digest"))
    return _once(_whole(docs).withColumn("digest", _digest(True)).join(kept, ["id", "digest"], "left_semi"), docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies, each doc_id and text once.

    Different texts under one doc_id, or without any, stay or go together.
    """
    near = simhash.near_duplicates(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = near.select(_id_text(F.col("doc_id")).alias("id")).distinct()
    return _once(_whole(docs).join(kept, "id", "left_semi").withColumn("digest", _digest(False)), docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix goes through it, each time at the position of that take; those it takes nothing of go.

    Rows that share a doc_id are repeated alike, by the most that the mix takes of one of them.
    """
    takes = mixing.mix(docs).select(_id_text(F.col("doc_id")).alias("id"), F.posexplode("positions").alias("round", "position"))
    takes = takes.filter("position IS NOT NULL").groupBy("id", "round").agg(F.min("position").alias("position"))
    order = ["position", "round", "id"]
    return _whole(docs).join(takes, "id").repartitionByRange(*order).sortWithinPartitions(*order).select("doc.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows with their sequences; a document that the mix repeats is packed as often."""
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("quality", quality_stage),
    ("exact", exact_stage),
    ("near", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: the classifier, the fingerprints and the tokenizer have no SQL; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs, base = table(spark, sf_dir, "documents"), new_path(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if number == len(STAGES) - 1:
            return made
        made.write.parquet(f"{base}/{number}-{name}")
        docs = spark.read.parquet(f"{base}/{number}-{name}")
    return docs
