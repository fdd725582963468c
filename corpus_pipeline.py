"""The training-data pipeline: five stages over ``documents``, each written and read before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolayer.llm.common import Scratch, table
from aerolayer.llm.decontaminate import decontaminate
from aerolayer.llm.linededup import deduplicate_lines
from aerolayer.llm.mixing import mix
from aerolayer.llm.simhash import drop_near_duplicates
from aerolayer.llm.toxicity import THRESHOLD, fit, score


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the network learns from the labels of the whole table.

    Null and empty texts score as a window without words, and every row of a repeated doc_id by its own text;
    without labels of both kinds every score is the base rate.  An empty table stays empty.
    """
    model = fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return score(docs, model).where(f"score < {THRESHOLD}").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs of over 50 words; n_chars follows the edited text.

    No document goes: one whose lines all go keeps an empty text.  Null ids and texts stay as they are, repeated
    rows are edited alike, and of equal runs the one in the smallest doc_id stays.
    """
    out = deduplicate_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id.

    Null texts count as empty, and texts without words are copies of one another; rows with a null doc_id stay,
    repeated rows count as one document and stay or go together.
    """
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item has leaked.

    Null ids and texts stay; repeated rows stay or go together; with an empty benchmark all stay.
    """
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes, one row for each.

    Null and empty texts have size 0 and take none; a null source is a source of its own, the last.
    """
    return mix(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: The network and the tiling have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, over the whole of ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
