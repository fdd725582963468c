"""The training-data queries of __spark_entry__.py, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, htmltext, licenses, linededup, media, mixing, pii, pseudolm, simhash, toxicity


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_decontamination": decontaminate.op2_decontamination,
    "op3_mixing": mixing.op3_mixing,
    "op4_lm_score": pseudolm.op4_lm_score,
    "op5_simhash": simhash.op5_simhash,
    "op6_line_dedup": linededup.op6_line_dedup,
    "op7_media": media.op7_media,
    "op8_html_text": htmltext.op8_html_text,
    "op9_licenses": licenses.op9_licenses,
    "op10_pii": pii.op10_pii,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {"op9_licenses": licenses.SQL}
