import pytest
from pyspark.sql import functions as F

from kinweave.functions import fasta
from kinweave.sources import sinks, text


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_fasta_round_trip(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "abc.fasta").write_text(">abc|1 x\nMK\nLV\n\n>abc|2\n" + "A" * 130 + "\n")
    rows = text.fasta(spark, str(tmp_path / "in")).orderBy("header")
    assert [(r.taxon, r.header, len(r.sequence)) for r in rows.collect()] == [("abc", "abc|1 x", 4), ("abc", "abc|2", 130)]
    assert {(r.gene_id, r.length) for r in text.gene_lengths(rows).collect()} == {("abc|1", 4), ("abc|2", 130)}
    sinks.write(sinks.fasta_lines(rows), str(tmp_path / "out"))
    (tmp_path / "in" / "notes.txt").write_text(">no|1\nMK\n")
    assert text.fasta(spark, str(tmp_path / "in")).count() == 2
    assert text.gene_lengths(rows, strict=True).count() == 2
    with pytest.raises(Exception, match="occurs twice"):
        text.gene_lengths(rows.unionByName(rows), strict=True).collect()
    again = text.fasta(spark, str(tmp_path / "out"), "*").orderBy("header")
    assert [(r.header, r.sequence) for r in again.collect()] == [(r.header, r.sequence) for r in rows.collect()]


def test_label_pairs(spark):
    got = text.abc(lines(spark, "a\tb\t2.5", "a b", "# c d", "", None, "x\ty\tnan", "one two 3\r\n"))
    assert {tuple(r) for r in got.collect()} == {("a", "b", 2.5), ("a", "b", 1.0), ("x", "y", 1.0), ("one", "two", 3.0)}


def test_lists(spark):
    assert {tuple(r) for r in text.lists(lines(spark, "a b c", "d")).collect()} == {("a", "b", 1.0), ("a", "c", 1.0)}
    assert {tuple(r) for r in text.lists(lines(spark, "a rel b:2 c"), skip=1, valued=True).collect()} == {("a", "b", 2.0), ("a", "c", 1.0)}


def test_matrix_file(spark, tmp_path):
    (tmp_path / "m").write_text("(header\ntype matrix\ndimensions 3x3\n)\n(matrix\nbegin\n0 1:2.5 2 $\n1 0:1 $\n2 $\n)\n")
    assert {tuple(r) for r in text.matrix(spark, str(tmp_path / "m")).collect()} == {(0, 1, 2.5), (0, 2, 1.0), (1, 0, 1.0)}


def test_labels(spark):
    g = spark.createDataFrame([(0, 1, 1.0), (1, 9, 2.0)], "src bigint, dst bigint, weight double")
    names = text.tab(lines(spark, "0\tzero", "1\tone"))
    assert {tuple(r) for r in text.labelled(g, names).collect()} == {("zero", "one", 1.0)}
    assert {tuple(r) for r in text.labelled(g, names, "extend").collect()} == {("zero", "one", 1.0), ("one", "9", 2.0)}


def test_similarity_lines(spark):
    row = text.similarities(lines(spark, "q\ts\tQ\tS\t1.5\t-20\t98.1\t77")).first()
    assert (row.query_id, row.evalue_mant, row.evalue_exp, row.percent_match) == ("q", 1.5, -20, 77.0)


def test_sequence_rules(spark):
    df = spark.createDataFrame([("lcl|AB1  x|y", "MK*L-V1234"), (None, None), ("a", "MKLV" * 40)], "h string, s string")
    rows = df.select(fasta.adjusted_id(F.col("h"), F.lit("tx"), 2).alias("i"), fasta.letters(F.col("s")).alias("l"), fasta.is_poor(F.col("s")).alias("p"), fasta.wrapped(F.col("s")).alias("w")).collect()
    assert [r.i for r in rows] == ["tx|AB1", None, None] and [r.l for r in rows][:2] == ["MKLV", ""] and [r.p for r in rows] == [True, True, False]
    assert [len(x) for x in rows[2].w.split("\n")] == [60, 60, 40]


def test_hit_weights(spark):
    hits = spark.createDataFrame([("q", "s", 10, 0.0, 50.0), ("q", "t", 0, 1e-7, 20.0), ("q", "u", 5, 10.0, None), ("q", "v", None, None, 1.0)], "query_id string, subject_id string, length bigint, evalue double, bits double")
    of = lambda *a: {(r.dst, round(r.weight, 6)) for r in text.hit_weights(hits, *a).collect()}
    assert of() == {("s", 200.0), ("t", 7.0)} and of("bits", 20.0) == {("s", 50.0)} and of("density") == {("s", 5.0)}


def test_sources_numbered_by_line(spark):
    rows = spark.createDataFrame([(3, "a b"), (9, "# c"), (10, ""), (12, "b\tc"), (40, None)], "n bigint, value string").repartition(3)
    assert {(r.src, r.dst) for r in text.numbered_sources(rows, "n").collect()} == {(0, "a"), (0, "b"), (1, "b"), (1, "c")}


def test_pairs_and_tabs(spark):
    assert {tuple(r) for r in text.reciprocal_pairs(lines(spark, "b\ta", "a\tb", "x y", "", None)).collect()} == {("a", "b"), ("x", "y")}
    a, b = text.tab(lines(spark, "0\tzero", "1\tone")), text.tab(lines(spark, "1\teins", "2\tzwei"))
    assert {tuple(r) for r in text.merged_tabs(a, b).collect()} == {(0, "zero"), (1, "one"), (2, "zwei")}
    assert {tuple(r) for r in text.merged_tabs(a, b, "meet").collect()} == {(1, "one")} and {tuple(r) for r in text.merged_tabs(a, b, "left").collect()} == {(0, "zero")}
    assert [r.value for r in sinks.tab_lines(a).collect()] == ["0\tzero", "1\tone"]


def test_tables_of_numbers(spark):
    df = spark.createDataFrame([(0, "head\tx\ty"), (1, "a\tnote\t1.5\t-2"), (2, "b\tnote\tNA\t3"), (3, None)], "n int, value string")
    got = {r.label: r.vector for r in text.table_vectors(df, skip=1, number="n", skip_lines=1).collect()}
    assert got == {"a": [1.5, -2.0], "b": [None, 3.0]}


def test_order_of_written_lines(spark):
    edges = spark.createDataFrame([("b", "x", "T2", "T1", 1.0), ("c", "d", "T1", "T1", 1.0), ("a", "y", "T2", "T1", 1.0)], "seq_a string, seq_b string, taxon_a string, taxon_b string, normalized_score double")
    assert [r.seq_a for r in sinks.ordered_edges(edges).collect()] == ["c", "a", "b"]
    assert [r.value for r in sinks.pair_lines(edges).collect()] == ["a\ty", "b\tx", "c\td"]
    clusters = spark.createDataFrame([(1, 5), (2, 7), (2, 6)], "cluster_id int, node bigint")
    assert [r.value for r in sinks.cluster_lines(clusters).collect()] == ["6\t7", "5"]
    g = spark.createDataFrame([(1, 0, 2.5), (0, 2, 1.0), (0, 1, 3.0)], "src bigint, dst bigint, weight double")
    assert [r.value for r in sinks.matrix_lines(g).collect()] == ["0 1:3.0 2:1.0 $", "1 0:2.5 $"]
