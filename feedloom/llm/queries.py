"""Queries of the llm subpackage and the SQL that checks them where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import boilerplate, languages, leakage, residue, subjects, tokens, truncation, variants
from feedloom.session import table


def _content_cases(spark: SparkSession, d: str) -> DataFrame:
    rows = residue.fields(table(spark, d, "summarized_articles")).filter("field_name = 'content'")
    return residue.find_residue(rows)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue_fields(table(spark, d, "summarized_articles"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    texts = truncation.value_texts(table(spark, d, "summarized_articles"), table(spark, d, "raw_x"), _content_cases(spark, d))
    return truncation.truncated(texts)


def p4_rates(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncation_rates(table(spark, d, "summarized_articles"), table(spark, d, "raw_x"), p4_found(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return variants.variant_pairs(table(spark, d, "funding_events"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return languages.mislabelled_segments(table(spark, d, "summarized_articles"), _content_cases(spark, d))


def p6_segments(spark: SparkSession, d: str) -> DataFrame:
    segments, named = languages.article_segments(table(spark, d, "summarized_articles"), _content_cases(spark, d))
    return segments.join(named, "pos", "left").withColumn("confidence", F.round("confidence", 4))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "summarized_articles").select("pos", "content")
    cases = _content_cases(spark, d).select("pos").distinct()
    return boilerplate.boilerplate_lines(pages).join(cases, "pos", "left_anti")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_texts(table(spark, d, "documents"))


def p8_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    back = tokens.decode_ids(tokens.encode_texts(docs)).withColumnRenamed("text", "decoded")
    return docs.join(back, "doc_id").select("doc_id", (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("same"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_removed(spark: SparkSession, d: str) -> DataFrame:
    return leakage.remove_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "removed").filter("removed > 0")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    found = subjects.document_subjects(table(spark, d, "documents"), table(spark, d, "doc_subject_labels"), table(spark, d, "subject_areas"))
    return found.select("doc_id", "subject")


def p10_composition(spark: SparkSession, d: str) -> DataFrame:
    found = subjects.document_subjects(table(spark, d, "documents"), table(spark, d, "doc_subject_labels"), table(spark, d, "subject_areas"))
    return subjects.composition(found).withColumn("mean_share", F.round("mean_share", 6))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p3_found, p4_found, p4_rates, p5_found, p6_found, p6_segments, p7_found, p8_ids, p8_roundtrip, p9_found, p9_removed, p10_found, p10_composition)}


def oracle_sql() -> dict[str, str]:
    grams = """
        SELECT {id}, array_to_string(w[i : i + 11], ' ') AS gram
        FROM (SELECT {id}, w, unnest(range(1, len(w) - 10)) AS i
              FROM (SELECT {id}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM {table} WHERE text IS NOT NULL) WHERE len(w) >= 12)"""
    return {
        "p8_roundtrip": "SELECT doc_id, true AS same FROM documents",
        "p9_found": f"""WITH d AS ({grams.format(id="doc_id", table="documents")}), e AS ({grams.format(id="item_id", table="eval_items")})
            SELECT DISTINCT doc_id, item_id FROM d JOIN e USING (gram)""",
    }
