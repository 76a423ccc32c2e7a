"""Sequences: headers, quality, and reject rates per proteome.

Defined results: null headers and sequences count as empty; an empty sequence is poor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def header_fields(header: Column) -> Column:
    """Fields of a header: bars and runs of spaces separate."""
    return F.split(F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(header, F.lit("")), r"\|", " "), " +", " ")), " ")


def adjusted_id(header: Column, taxon: Column, field: int) -> Column:
    """``taxon|id`` with the id from a field counted from 1; null if there is none."""
    return F.concat(taxon, F.lit("|"), F.nullif(F.get(header_fields(header), F.lit(field - 1)), F.lit("")))


def letters(sequence: Column) -> Column:
    """The letters of a sequence."""
    return F.regexp_replace(F.coalesce(sequence, F.lit("")), r"[^\p{L}]", "")


def is_poor(sequence: Column, least: int = 10, most_others: float = 20.0) -> Column:
    """Shorter than ``least``, or more than ``most_others`` per cent of it are no letters."""
    size = F.length(F.coalesce(sequence, F.lit("")))
    return (size < least) | (100 * (size - F.length(letters(sequence))) > most_others * size)


def wrapped(sequence: Column, width: int = 60) -> Column:
    """Lines of ``width`` characters."""
    return F.regexp_replace(F.coalesce(sequence, F.lit("")), f"(?s)(.{{{width}}})(?=.)", "$1\n")


def reject_rates(rows: DataFrame, group: str, sequence: str, least: int = 10, most_others: float = 20.0) -> DataFrame:
    """(group, sequences, rejected, percent, suspicious), suspicious above ten per cent."""
    poor = F.count(F.when(is_poor(F.col(sequence), least, most_others), 1))
    all_rows = F.count(F.lit(1))
    return rows.groupBy(group).agg(all_rows.alias("sequences"), poor.alias("rejected"), (100 * poor / all_rows).alias("percent"), (100 * poor / all_rows > 10).alias("suspicious"))


def duplicate_ids(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur in more than one different row, with their number; copies of a row count once
    and rows without a key not at all."""
    return rows.distinct().dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def header_mismatches(rows: DataFrame, header: str, taxon: str) -> DataFrame:
    """Rows whose header does not begin with their taxon and a bar."""
    return rows.where(~F.substring_index(F.coalesce(header, F.lit("")), "|", 1).eqNullSafe(F.col(taxon)))
