"""Loading 12-column hit lines: typed rows for the valid ones, reasons for the others.

Lines are split into cells; the cells are exploded to (row, column, value), joined with a
table of rules, checked, and the failures aggregated per row; rows without a failure are
what an anti-join leaves.

Defined results: null lines, blank lines and comments are no records; copies of a line id
count once; any number of fields, empty lines and very long lines are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.session import checkpointed
from kinweave.tables import ID_PADDING

#: Stands for a tab inside quotes while a line is split; a noncharacter, so never in a text.
_INNER_TAB = "\uffff"

FIELDS = 12

#: The columns of a hit line, their rule, and the bounds of numbers.
RULES = [
    (0, "query_id", "id", None, None),
    (1, "subject_id", "id", None, None),
    (2, "percent_identity", "number", 0.0, 100.0),
    (3, "length", "digits", 0.0, None),
    (4, "mismatch", "digits", 0.0, None),
    (5, "gapopen", "digits", 0.0, None),
    (6, "q_start", "digits", 1.0, None),
    (7, "q_end", "digits", 1.0, None),
    (8, "s_start", "digits", 1.0, None),
    (9, "s_end", "digits", 1.0, None),
    (10, "evalue", "evalue", 0.0, None),
    (11, "bits", "number", 0.0, None),
]

_NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_EXPONENT = r"^[eE][+-]?[0-9]+$"


def records(lines: DataFrame, row: str, line: str) -> DataFrame:
    """(row, text) of the lines that are records, without their trailing CR and LF."""
    text = F.regexp_replace(F.col(line), r"[\r\n]+$", "")
    kept = lines.select(F.col(row).alias("row"), text.alias("text"))
    return kept.where(F.col("text").rlike(r"\S") & ~F.col("text").startswith("#")).distinct()


def split_fields(rows: DataFrame) -> DataFrame:
    """(row, cells, quoting) of (row, text); quoting: whether it is well formed.

    Pieces between quote characters alternate between outside and inside a quoted field. An
    empty outside piece between two inside ones is a doubled quote; every other outside piece
    must have a tab next to the quotes it touches, with nothing but spaces between. The first
    and the last piece are treated apart, so that nothing outside a piece is needed for it and
    the time grows with the length of a line, however Catalyst arranges the expressions."""
    pieces = F.split("text", '"', -1)
    inner = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 2, F.lit(0)))  # piece 0 of these is inside quotes
    first, last = F.get(pieces, F.lit(0)), F.element_at(pieces, -1)

    def wrong(piece: Column, i: Column) -> Column:
        return (i % 2 == 1) & (piece != "") & ~piece.rlike(r"(?s)^ *\t(.*\t)? *$")

    def plain(piece: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, F.translate(piece, "\t", _INNER_TAB)).when(piece == "", F.lit('"')).otherwise(piece)

    good = (F.size(pieces) % 2 == 1) & first.rlike(r"(^|\t) *$") & last.rlike(r"^ *(\t|$)") & ~F.exists(F.transform(inner, wrong), lambda w: w)
    joined = F.concat(first, F.array_join(F.transform(inner, plain), ""), last)
    quoted = F.instr("text", '"') > 0
    cells = F.split(F.when(quoted, joined).otherwise(F.col("text")), "\t", -1)
    cells = F.transform(cells, lambda c: F.translate(F.trim(c), _INNER_TAB, "\t"))
    return rows.select("row", cells.alias("cells"), F.when(quoted, good).otherwise(True).alias("quoting"))


def _fails(kind: Column, value: Column, low: Column, high: Column) -> Column:
    """The reason why a value breaks its rule, or null."""
    number = F.expr("try_cast(_value AS DOUBLE)")
    shape = (
        F.when(kind == "id", F.when(F.trim(value, F.lit(ID_PADDING)) == "", "empty id"))
        .when((kind == "digits") & ~value.rlike("^[0-9]+$"), "not digits")
        .when((kind == "number") & ~value.rlike(_NUMBER), "not a number")
        .when((kind == "evalue") & ~(value.rlike(_NUMBER) | value.rlike(_EXPONENT)), "not a number")
    )
    bounds = F.when(low.isNotNull() & (number < low), "too small").when(high.isNotNull() & (number > high), "too large")
    return F.coalesce(shape, bounds)


def parsed(lines: DataFrame, row: str = "line_id", line: str = "line") -> DataFrame:
    """(row, cells, quoting) of each record."""
    return split_fields(records(lines, row, line))


def errors(cells: DataFrame, spark: SparkSession) -> DataFrame:
    """(row, reasons): sorted distinct reasons of every broken record.

    The rule table has 12 rows, so it is broadcast; failures are aggregated where the cells
    of a row were exploded, before anything is shuffled."""
    rules = spark.createDataFrame(RULES, "_pos int, _name string, _kind string, _low double, _high double")
    structure = F.array_compact(
        F.array(
            F.when(~F.col("quoting"), "stray quote"),
            F.when(F.col("quoting") & (F.size("cells") < FIELDS), "too few fields"),
            F.when(F.col("quoting") & (F.size("cells") > FIELDS), "too many fields"),
        )
    )
    broken = cells.select("row", F.explode(structure).alias("reason"))
    whole = cells.where(F.col("quoting") & (F.size("cells") == FIELDS))
    single = whole.select("row", F.posexplode("cells").alias("_pos", "_value")).join(F.broadcast(rules), "_pos")
    reason = _fails(F.col("_kind"), F.col("_value"), F.col("_low"), F.col("_high"))
    wrong = single.select("row", F.concat("_name", F.lit(": "), reason).alias("reason")).where("reason IS NOT NULL")
    return broken.unionByName(wrong).groupBy("row").agg(F.array_sort(F.collect_set("reason")).alias("reasons"))


def clean(cells: DataFrame, spark: SparkSession) -> DataFrame:
    """Typed rows of the valid records. Counts beyond BIGINT are null in their column and stand in
    ``beyond`` as ``column=digits``; it is empty for all others."""
    cells = checkpointed(cells)  # judged and loaded, but split once
    valid = cells.join(errors(cells, spark).select("row"), "row", "left_anti")
    typed, beyond = [], []
    for pos, name, kind, _, _ in RULES:
        cell = F.get("cells", F.lit(pos))
        if kind == "evalue":
            cell = F.when(cell.rlike(_EXPONENT), F.concat(F.lit("1"), cell)).otherwise(cell)
        to = {"id": None, "digits": "bigint"}.get(kind, "double")
        typed.append((F.trim(cell, F.lit(ID_PADDING)) if to is None else cell.try_cast(to)).alias(name))
        if kind == "digits":
            beyond.append(F.when(cell.try_cast(to).isNull(), F.concat(F.lit(name + "="), cell)))
    return valid.select("row", *typed, F.concat_ws("; ", *beyond).alias("beyond"))
