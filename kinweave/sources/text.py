"""Readers of the text formats, as functions of lines, so that files and tables serve alike.

Every reader takes a DataFrame of lines or a path. Comments begin with ``#``. Defined
results: null and blank lines are skipped; an absent weight is 1; an unreadable weight is 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.session import numbered_rows


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file) of text files."""
    return spark.read.text(path).select("value", F.input_file_name().alias("file"))


def content(df: DataFrame, line: str = "value") -> DataFrame:
    """Lines with content."""
    return df.where(F.col(line).rlike(r"\S") & ~F.col(line).startswith("#"))


def _cells(line: Column) -> Column:
    """Tab-separated cells, or cells between white space where there is no tab."""
    bare = F.regexp_replace(line, r"[\r\n]+$", "")
    return F.when(F.instr(bare, "\t") > 0, F.split(bare, "\t", -1)).otherwise(F.split(F.trim(bare), r"\s+", -1))


def _weight(cell: Column) -> Column:
    value = cell.try_cast("double")
    usable = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    return F.when(usable, value).otherwise(1.0)


def fasta(spark: SparkSession, path: str, glob: str = "*.fasta") -> DataFrame:
    """(file, taxon, header, sequence): one row per record, split at ``>`` by the reader, so that
    files of any size are read in pieces. Only files that match ``glob`` and are not hidden are read."""
    rows = spark.read.option("lineSep", "\n>").option("pathGlobFilter", glob).text(path).select("value", F.input_file_name().alias("file"))
    record = F.regexp_replace("value", r"^>", "")
    header = F.trim(F.regexp_extract(record, r"^([^\r\n]*)", 1))
    body = F.regexp_replace(F.regexp_replace(record, r"^[^\r\n]*", ""), r"\s+", "")
    taxon = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.fasta$", "")
    return rows.where(F.col("value").rlike(r"\S")).select("file", taxon.alias("taxon"), header.alias("header"), body.alias("sequence"))


def gene_lengths(records: DataFrame, strict: bool = False) -> DataFrame:
    """(gene_id, taxon, length): the first word of the header and all characters of the sequence.

    With ``strict`` an id that occurs twice is an error."""
    rows = records.select(F.regexp_extract("header", r"^(\S+)", 1).alias("gene_id"), "taxon", F.length("sequence").alias("length"))
    if not strict:
        return rows
    once = rows.groupBy("gene_id").agg(F.min("taxon").alias("taxon"), F.min("length").alias("length"), F.count(F.lit(1)).alias("_k"))
    return once.where(F.assert_true(F.col("_k") == 1, F.lit("an id occurs twice")).isNull()).drop("_k")


def similarities(df: DataFrame, line: str = "value") -> DataFrame:
    """Eight tab-separated columns; lines of another width are an error."""
    c = F.split(F.regexp_replace(line, r"[\r\n]+$", ""), "\t", -1)
    names = ["query_id", "subject_id", "query_taxon", "subject_taxon", "evalue_mant", "evalue_exp", "percent_identity", "percent_match"]
    types = ["string"] * 4 + ["double", "int", "double", "double"]
    rows = content(df, line).where(F.assert_true(F.size(c) == 8, F.lit("a similarity line does not have 8 columns")).isNull())
    return rows.select(*[F.get(c, F.lit(i)).cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types, strict=True))])


def abc(df: DataFrame, line: str = "value") -> DataFrame:
    """(src, dst, weight) of label pairs with an optional weight."""
    c = _cells(F.col(line))
    cell = lambda i: F.get(c, F.lit(i))
    return content(df, line).where(F.size(c) >= 2).select(cell(0).alias("src"), cell(1).alias("dst"), _weight(cell(2)).alias("weight"))


def numbered_abc(df: DataFrame, line: str = "value") -> DataFrame:
    """The same for numeric nodes."""
    return abc(df, line).select(F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst"), "weight")


def lists(df: DataFrame, line: str = "value", skip: int = 0, valued: bool = False) -> DataFrame:
    """(src, dst, weight) of lines with a source and its targets. ``skip`` 1 leaves out the
    relation after the source; ``valued``: targets are ``label:weight``."""
    c = _cells(F.col(line))
    targets = F.slice(c, F.lit(2 + skip), F.greatest(F.size(c) - 1 - skip, F.lit(0)))
    rows = content(df, line).select(F.get(c, F.lit(0)).alias("src"), F.explode(targets).alias("t"))
    if not valued:
        return rows.select("src", F.col("t").alias("dst"), F.lit(1.0).alias("weight"))
    return rows.select("src", F.regexp_replace("t", r":[^:]*$", "").alias("dst"), _weight(F.nullif(F.regexp_extract("t", r":([^:]*)$", 1), F.lit(""))).alias("weight"))


def tab(df: DataFrame, line: str = "value") -> DataFrame:
    """(idx, label)."""
    c = _cells(F.col(line))
    return content(df, line).select(F.get(c, F.lit(0)).cast("bigint").alias("idx"), F.get(c, F.lit(1)).alias("label"))


def labelled(graph: DataFrame, labels: DataFrame, mode: str = "restrict") -> DataFrame:
    """Numeric nodes replaced by labels of (idx, label). Nodes without one: 'restrict' drops their
    arcs, 'extend' keeps them under their number, 'strict' is an error."""
    how = "inner" if mode == "restrict" else "left"
    out = graph
    for end in ("src", "dst"):
        own = labels.select(F.col("idx").alias(end), F.col("label").alias(f"_{end}"))
        out = out.join(own, end, how)
        if mode == "strict":
            out = out.where(F.assert_true(F.col(f"_{end}").isNotNull(), F.lit("a node has no label")).isNull())
    name = lambda end: F.coalesce(f"_{end}", F.col(end).cast("string")).alias(end)
    return out.select(name("src"), name("dst"), "weight")


def matrix(spark: SparkSession, path: str) -> DataFrame:
    """(src, dst, weight) of matrix files in text: vectors ``column row[:value] ... $``."""
    vectors = spark.read.option("lineSep", "$").text(path).select(F.regexp_replace("value", r"(?s)^.*begin\s", "").alias("v"))
    c = F.split(F.trim(F.regexp_replace("v", r"\s+", " ")), " ", -1)
    rows = vectors.where(F.col("v").rlike(r"^\s*\d")).select(F.split(F.get(c, F.lit(0)), ":")[0].cast("bigint").alias("src"), F.explode(F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0)))).alias("t"))
    pair = F.split("t", ":")
    return rows.select("src", pair[0].cast("bigint").alias("dst"), _weight(F.get(pair, F.lit(1))).alias("weight"))


def table_vectors(df: DataFrame, line: str = "value", skip: int = 0, number: str | None = None, skip_lines: int = 0) -> DataFrame:
    """(label, vector) of tab-separated tables with a label first; unreadable numbers are null.

    ``skip``: columns between label and numbers to leave out; ``skip_lines``: rows whose ``number``
    column (their place, from 0) is below it are headings."""
    c = F.split(F.regexp_replace(line, r"[\r\n]+$", ""), "\t", -1)
    rows = content(df, line) if number is None else content(df.where(F.col(number) >= skip_lines), line)
    cells = F.slice(c, F.lit(2 + skip), F.greatest(F.size(c) - 1 - skip, F.lit(0)))
    return rows.select(F.get(c, F.lit(0)).alias("label"), F.transform(cells, lambda x: x.try_cast("double")).alias("vector"))


def reciprocal_pairs(df: DataFrame, line: str = "value") -> DataFrame:
    """(seq_a, seq_b) of lines with two ids, in either order and more than once; the smaller id first."""
    c = _cells(F.col(line))
    ends = F.get(c, F.lit(0)), F.get(c, F.lit(1))
    return content(df, line).where(F.size(c) >= 2).select(F.least(*ends).alias("seq_a"), F.greatest(*ends).alias("seq_b")).distinct()


def numbered_sources(df: DataFrame, order: str, line: str = "value") -> DataFrame:
    """(src, dst, weight) of lines that hold targets only: the source is the line's place in ``order``
    among the lines with content, from 0. Lines are numbered over all partitions."""
    rows = numbered_rows(content(df, line).select(F.col(order).alias("_o"), F.col(line).alias("_l")), ["_o"], "src")
    return rows.select("src", F.explode(_cells(F.col("_l"))).alias("dst"), F.lit(1.0).alias("weight"))


def merged_tabs(first: DataFrame, second: DataFrame, how: str = "merge") -> DataFrame:
    """(idx, label) of two tabs: all entries ('merge', the first tab's label holds), those of both
    ('meet') or of the first only ('left')."""
    once = lambda df: df.dropna().groupBy("idx").agg(F.min("label").alias("label"))
    a, b = once(first), once(second)
    if how == "merge":
        return a.unionByName(b.join(a, "idx", "left_anti"))
    return a.join(b, "idx", {"meet": "left_semi", "left": "left_anti"}[how])


#: Fixed value: the largest weight of an e-value, which zero has.
MOST_WEIGHT = 200.0


def hit_weights(hits: DataFrame, score: str = "evalue", above: float = 0.0) -> DataFrame:
    """(src, dst, weight) of typed hits: minus the decimal logarithm of the e-value, at most 200; the
    'bits'; or the bits per aligned residue ('density'). Weights not above ``above`` are no arcs."""
    e = F.col("evalue")
    weight = {
        "evalue": F.when(e == 0, MOST_WEIGHT).when(e > 0, F.least(F.lit(MOST_WEIGHT), -F.log10(e))),
        "bits": F.col("bits"),
        "density": F.col("bits") / F.nullif(F.col("length"), F.lit(0)),
    }[score]
    rows = hits.select(F.col("query_id").alias("src"), F.col("subject_id").alias("dst"), weight.cast("double").alias("weight"))
    return rows.where(F.col("weight") > above)
