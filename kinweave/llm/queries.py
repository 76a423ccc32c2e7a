"""Queries pN_... of problems 3, 6, 7 and 8. SQL expresses the first only; see tests/llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions.evalue import ordered_evalue
from kinweave.llm import leakage, mixing, topn, toxic
from kinweave.tables import clean_id, table


def _top_hits(spark: SparkSession, d: str) -> DataFrame:
    exp, mant = ordered_evalue(F.col("evalue_mant"), F.col("evalue_exp"))
    rows = table(spark, d, "similarities").select(
        clean_id(F.col("query_id")).alias("query_id"), clean_id(F.col("subject_taxon")).alias("subject_taxon"), clean_id(F.col("subject_id")).alias("subject_id"),
        F.when(F.col("evalue_mant").isNotNull() & F.col("evalue_exp").isNotNull(), exp).alias("score_exp"), mant.alias("score_mant"), "record_id",
    )
    return topn.top_n(rows, 3, ["query_id", "subject_taxon"], ["score_exp", "score_mant"], ["subject_id", "record_id"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _top_hits(spark, d).select("record_id")


def p3_hits(spark: SparkSession, d: str) -> DataFrame:
    return _top_hits(spark, d).select("query_id", "subject_taxon", "rank", "subject_id", "record_id", "score_mant")


def _leaks(spark: SparkSession, d: str, edits: int) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_passages"), edits, short=edits > 0)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d, 0).select("doc_id", "item_id")


def p6_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Also stretches up to two word edits away, and items below a window; with the part of the item that was met."""
    found = _leaks(spark, d, 2)
    return found.select("doc_id", "item_id", "equal_windows", "near_windows", (F.col("item_windows_met") / F.col("item_windows")).alias("covered"))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    chosen, *_ = mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))
    return chosen.select("doc_id", "source", "tokens", "repeats")


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(*mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets")))


def _scores(spark: SparkSession, d: str) -> DataFrame:
    return toxic.scores(table(spark, d, "documents"), table(spark, d, "content_labels"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d).where(F.col("score") >= toxic.REVIEW).select("doc_id")


def p8_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d)


def p8_rates(spark: SparkSession, d: str) -> DataFrame:
    return toxic.rates(_scores(spark, d))


QUERIES = {f.__name__: f for f in (p3_found, p3_hits, p6_found, p6_leaks, p7_mix, p7_shares, p8_found, p8_scores, p8_rates)}


def _bare(col: str) -> str:
    return f"nullif(trim({col}, E' \\t\\r'), '')"


_RANKED = f"""
WITH r AS (SELECT DISTINCT record_id, {_bare("query_id")} query_id, {_bare("subject_id")} subject_id, {_bare("subject_taxon")} subject_taxon,
  CASE WHEN evalue_mant = 0 THEN -2147483648 ELSE evalue_exp END e, evalue_mant m FROM similarities WHERE evalue_exp IS NOT NULL AND evalue_mant IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id, subject_taxon ORDER BY e, m, subject_id, record_id) "rank" FROM r
  WHERE query_id IS NOT NULL AND subject_id IS NOT NULL AND subject_taxon IS NOT NULL)
"""

SQL: dict[str, str] = {
    "p3_found": _RANKED + 'SELECT record_id FROM k WHERE "rank" <= 3',
    "p3_hits": _RANKED + 'SELECT query_id, subject_taxon, "rank"::INT "rank", subject_id, record_id, m score_mant FROM k WHERE "rank" <= 3',
}
