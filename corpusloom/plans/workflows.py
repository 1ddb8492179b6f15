"""Composed workflows and SQL functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import providers
from corpusloom.operators.clean import CleanOptions, clean
from corpusloom.operators.dialogue import flatten_pairs, model_lines
from corpusloom.operators.quality import apply_filter, retention, train_filter

#: Names under which the cleaners can be called from SQL.
SQL_FUNCTIONS: dict[str, Callable] = {f"clean_{k}": v for k, v in T.CLEANERS.items()} | {
    "strip_unicode": T.strip,
    "letter_count": T.letter_count,
    "human_size": T.human_size,
    "base_name": T.base_name,
    "file_stem": T.stem,
    "file_extension": T.extension,
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Make the scalar functions callable from SQL; their bodies are inlined, nothing leaves the JVM."""
    for name, build in SQL_FUNCTIONS.items():
        kind = "BIGINT" if name == "human_size" else "STRING"
        result = "BIGINT" if name == "letter_count" else "STRING"
        body = _sql_of(spark, build, kind)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x {kind}) RETURNS {result} RETURN {body}")
    return list(SQL_FUNCTIONS)


def _sql_of(spark: SparkSession, build: Callable, kind: str) -> str:
    """SQL text of a column over the parameter ``x``."""
    plan = spark.sql(f"SELECT CAST(NULL AS {kind}) AS x").select(build(F.col("x")).alias("y"))._jdf.queryExecution().analyzed()
    return plan.expressions().apply(0).child().sql()


def document_workflow(records: DataFrame, options: CleanOptions | None = None) -> DataFrame:
    """Filters, cleaning and rule-based classification of document records in one lazy plan."""
    cleaned = clean(records, options or CleanOptions.everything(answer_sheet_filter=True))
    path = F.col("md_path") if "md_path" in cleaned.columns else F.lit("")
    columns = providers.classify_document(path, F.col("text"))
    columns |= {"grade": providers.grade_from_path(path), "school_year": providers.school_year_from_path(path)}
    return cleaned.withColumns(columns)


def quality_workflow(labelled: DataFrame, candidates: DataFrame, id_columns: list[str], threshold: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Train on labelled pairs, keep good candidate pairs; the kept pairs and the retention."""
    model = train_filter(model_lines(labelled))
    lines = model_lines(flatten_pairs(candidates, id_columns))
    kept = apply_filter(model, lines, threshold)
    scored = apply_filter(model, lines, 0.0)
    return kept, retention(scored, F.col("score") >= threshold)
