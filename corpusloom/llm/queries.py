"""Queries of the training-data operators, by the names of their problems."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import encode, level, markup, mix, mojibake, noise, pairs, pii, sample, split
from corpusloom.runtime import read_table

#: Rows of the fixed-size sample.
SAMPLE_SIZE = 10_000


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noise.page_noise(read_table(spark, sf_dir, "md_info"))


def p1_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noise.repair_pages(read_table(spark, sf_dir, "md_info").select("id", "text").dropDuplicates(["id"]))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.markup_families(read_table(spark, sf_dir, "md_info"))


def p2_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.clean_records(read_table(spark, sf_dir, "md_info").select("id", "text").dropDuplicates(["id"]))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.defective_pairs(read_table(spark, sf_dir, "qa_pairs"))


def p4_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return level.reading_levels(read_table(spark, sf_dir, "md_info"), read_table(spark, sf_dir, "level_anchors")).distinct()


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_levels(spark, sf_dir).select("id", "band").distinct()


def p5_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.sample_rows(read_table(spark, sf_dir, "qa_pairs"), "qa_id", SAMPLE_SIZE, order_by="arrived_at")


def _personal_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = [read_table(spark, sf_dir, t).select(F.lit(t).alias("tbl"), "id", "text") for t in ("md_info", "all_transcripts")]
    return tables[0].unionByName(tables[1])


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_items(_personal_texts(spark, sf_dir)).select("tbl", "id", "kind", "pii_text").distinct()


def p6_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _personal_texts(spark, sf_dir).dropDuplicates(["tbl", "id"])
    return pii.redact(texts, pii.personal_items(texts)).select("tbl", "id", "redacted")


def p7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = split.read_settings(read_table(spark, sf_dir, "split_settings"))
    once = read_table(spark, sf_dir, "md_info").select("id", "text").dropDuplicates(["id"])
    return split.split_texts(once, settings)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = split.read_settings(read_table(spark, sf_dir, "split_settings"))
    made = split.split_texts(read_table(spark, sf_dir, "md_info"), settings)
    return made.where((F.col("n_pieces") > 1) & (F.col("piece_no") == 1)).select("setting_id", "id").distinct()


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode_corpus(read_table(spark, sf_dir, "documents"), "doc_id")


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mixture(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "mix_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.reached_shares(p9_mixture(spark, sf_dir), read_table(spark, sf_dir, "mix_targets"))


def p10_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.repair_texts(read_table(spark, sf_dir, "documents"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_repaired(spark, sf_dir).select("doc_id").distinct()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_repaired, p2_found, p2_clean, p3_found, p4_levels, p4_found, p5_sample, p6_found, p6_redacted, p7_pieces, p7_found, p8_ids, p9_mixture, p9_shares, p10_repaired, p10_found)}


def oracle_sql() -> dict[str, str]:
    return {
        "p7_found": """
            SELECT DISTINCT s.setting_id, m.id FROM md_info m JOIN split_settings s ON length(m.text) > s.max_chars
        """,
    }
