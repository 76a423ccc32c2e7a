"""Writers of the text formats. Output is one folder of part files; order only where asked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.functions.evalue import score_text
from kinweave.functions.fasta import wrapped


def edge_lines(edges: DataFrame) -> DataFrame:
    """(value): ``a TAB b TAB score`` with at most three decimals, sorted by a and b."""
    return edges.orderBy("seq_a", "seq_b", "edge_type").select(F.concat_ws("\t", "seq_a", "seq_b", score_text(F.col("normalized_score"))).alias("value"))


def ordered_edges(edges: DataFrame) -> DataFrame:
    """Edges in the order of their files: by both taxa and ids; in-paralogs have one taxon twice."""
    return edges.orderBy("taxon_a", "taxon_b", "seq_a", "seq_b")


def pair_lines(pairs: DataFrame) -> DataFrame:
    """(value): ``a TAB b``, sorted."""
    return pairs.orderBy("seq_a", "seq_b").select(F.concat_ws("\t", "seq_a", "seq_b").alias("value"))


def tab_lines(labels: DataFrame) -> DataFrame:
    """(value): ``idx TAB label``, sorted by number."""
    return labels.orderBy("idx").select(F.concat_ws("\t", F.col("idx").cast("string"), "label").alias("value"))


def cluster_lines(clusters: DataFrame) -> DataFrame:
    """(value): the nodes of a cluster on one line, the largest cluster first."""
    rows = clusters.groupBy("cluster_id").agg(F.array_sort(F.collect_list("node")).alias("m"))
    return rows.orderBy(F.desc(F.size("m")), "cluster_id").select(F.array_join(F.transform("m", lambda n: n.cast("string")), "\t").alias("value"))


def graph_lines(g: DataFrame) -> DataFrame:
    """(value): ``src TAB dst TAB weight``."""
    return g.select(F.concat_ws("\t", F.col("src").cast("string"), F.col("dst").cast("string"), F.col("weight").cast("string")).alias("value"))


def matrix_lines(g: DataFrame) -> DataFrame:
    """(value): the vectors of a matrix file, ``column row:value ... $``, sorted by column."""
    cell = F.struct("dst", F.concat_ws(":", F.col("dst").cast("string"), F.col("weight").cast("string")).alias("t"))
    rows = g.groupBy("src").agg(F.transform(F.array_sort(F.collect_list(cell)), lambda x: x["t"]).alias("m"))
    return rows.orderBy("src").select(F.concat_ws(" ", F.col("src").cast("string"), F.array_join("m", " "), F.lit("$")).alias("value"))


def dumped(g: DataFrame, part: str = "all", loops: bool = True) -> DataFrame:
    """Arcs as a dump shows them: all, or one of the two directions of a pair ('upper', 'lower'),
    with or without loops."""
    kept = {"all": F.lit(True), "upper": F.col("src") <= F.col("dst"), "lower": F.col("src") >= F.col("dst")}[part]
    return g.where(kept if loops else kept & (F.col("src") != F.col("dst")))


def neighbour_lines(g: DataFrame) -> DataFrame:
    """(value): a node and its neighbours on one line, as the format wants it."""
    return g.groupBy("src").agg(F.array_sort(F.collect_list("dst")).alias("m")).select(F.concat_ws("\t", F.col("src").cast("string"), F.array_join("m", "\t")).alias("value"))


def fasta_lines(rows: DataFrame, header: str = "header", sequence: str = "sequence") -> DataFrame:
    """(value): a record with its sequence wrapped at 60."""
    return rows.select(F.concat(F.lit(">"), header, F.lit("\n"), wrapped(F.col(sequence))).alias("value"))


def write(df: DataFrame, path: str) -> None:
    """Lines to text files."""
    df.select("value").write.mode("overwrite").text(path)


def summary(**frames: DataFrame) -> DataFrame:
    """(name, records) per DataFrame."""
    out = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("name"), "records")
        out = one if out is None else out.unionByName(one)
    return out
