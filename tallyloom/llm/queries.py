"""Registered queries of this subpackage, each over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import hard_negatives, line_cleaning, line_dedup, minhash, spelling, winnowing
from tallyloom.llm.language_id import op1_language_id
from tallyloom.llm.license_scan import op3_license_scan
from tallyloom.llm.line_cleaning import op5_line_cleaning
from tallyloom.llm.minhash import op2_minhash
from tallyloom.llm.packing import op7_packing
from tallyloom.llm.quality_gam import op8_quality_gam
from tallyloom.llm.repeats import op10_repeats
from tallyloom.llm.token_count import op4_token_count
from tallyloom.llm.toxicity import op6_toxicity


def _over(operator, *tables: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(*(spark.read.parquet(f"{sf_dir}/{table}.parquet") for table in tables))

    return query


QUERIES = {
    "op1_language_id": _over(op1_language_id, "documents"),
    "op2_minhash": _over(op2_minhash, "documents"),
    "op3_license_scan": _over(op3_license_scan, "documents"),
    "op4_token_count": _over(op4_token_count, "documents"),
    "op5_line_cleaning": _over(op5_line_cleaning, "documents"),
    "op6_toxicity": _over(op6_toxicity, "documents", "labels"),
    "op7_packing": _over(op7_packing, "documents"),
    "op8_quality_gam": _over(op8_quality_gam, "documents", "labels"),
    "op9_winnowing": _over(winnowing.op9_winnowing, "documents", "benchmark"),
    "op10_repeats": _over(op10_repeats, "documents"),
    "op11_line_dedup": _over(line_dedup.op11_line_dedup, "documents"),
    "op12_hard_negatives": _over(hard_negatives.op12_hard_negatives, "embeddings"),
    "op13_spelling": _over(spelling.op13_spelling, "documents"),
}

ORACLE: dict[str, str] = {
    "op2_minhash": minhash.ORACLE_SQL,
    "op5_line_cleaning": line_cleaning.ORACLE_SQL,
    "op9_winnowing": winnowing.ORACLE_SQL,
    "op11_line_dedup": line_dedup.ORACLE_SQL,
    "op12_hard_negatives": hard_negatives.ORACLE_SQL,
    "op13_spelling": spelling.ORACLE_SQL,
}
