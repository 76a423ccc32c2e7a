"""Hits, graphs and clusterings derived from the tables, for Spark and in SQL alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.operators.graph import nodes
from kinweave.sources.text import MOST_WEIGHT
from kinweave.tables import clean_id, table

#: Parts per gene, taxa, and every how many hits an e-value is zero.
PARTS_PER_GENE, TAXA, ZERO_EVERY = 4, 4, 41


def _gene(part: Column) -> tuple[Column, Column, Column]:
    """(id, taxon, length) of the gene that a part belongs to."""
    k = F.floor(part / PARTS_PER_GENE)
    taxon = F.concat(F.lit("T"), (k % TAXA).cast("string"))
    return F.concat(taxon, F.lit("|P"), k.cast("string")), taxon, (80 + (k * 37) % 60).cast("int")


def order_hits(spark: SparkSession, d: str) -> DataFrame:
    """A hit for every two lines of one order, between the genes of their parts."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    a, b = lines.alias("a"), lines.alias("b")
    both = a.join(b, (F.col("a.l_orderkey") == F.col("b.l_orderkey")) & (F.col("a.l_linenumber") != F.col("b.l_linenumber")))
    (q, qt, ql), (s, st, sl) = _gene(F.col("a.l_partkey")), _gene(F.col("b.l_partkey"))
    line = F.col("a.l_orderkey") * 64 + F.col("a.l_linenumber") * 8 + F.col("b.l_linenumber")
    zero = (F.col("a.l_orderkey") + F.col("a.l_linenumber") + F.col("b.l_linenumber")) % ZERO_EVERY == 0
    cents = F.round(F.col("a.l_extendedprice") * 100).cast("bigint")
    start = (1 + F.col("b.l_quantity")).cast("bigint")
    end = (F.col("a.l_quantity") + F.col("b.l_quantity")).cast("bigint")
    odd = line % 2 == 1
    low, high = F.when(odd, end).otherwise(start), F.when(odd, start).otherwise(end)
    return both.select(
        line.alias("line_id"), q.alias("query_id"), s.alias("subject_id"), qt.alias("query_taxon"), st.alias("subject_taxon"), ql.alias("query_length"), sl.alias("subject_length"),
        F.when(zero, 0.0).otherwise(1 + (cents % 800) / 100).alias("evalue_mant"), F.when(zero, 0).otherwise(-(F.col("a.l_quantity") + F.col("b.l_quantity")).cast("int")).alias("evalue_exp"),
        F.round(100 * (1 - F.col("a.l_discount")), 1).alias("percent_identity"), F.col("a.l_quantity").cast("bigint").alias("length"),
        low.alias("q_start"), high.alias("q_end"), low.alias("s_start"), high.alias("s_end"),
    )


HITS_SQL = f"""
ln AS (SELECT l_orderkey o, l_linenumber n, l_partkey // {PARTS_PER_GENE} k, l_quantity qty, l_extendedprice price, l_discount disc FROM lineitem),
hits AS (SELECT a.o*64 + a.n*8 + b.n line_id, 'T' || (a.k % {TAXA}) || '|P' || a.k q, 'T' || (b.k % {TAXA}) || '|P' || b.k s, 'T' || (a.k % {TAXA}) qt, 'T' || (b.k % {TAXA}) st,
  80 + (a.k*37) % 60 ql, 80 + (b.k*37) % 60 sl, CASE WHEN (a.o + a.n + b.n) % {ZERO_EVERY} = 0 THEN 0.0 ELSE 1 + (round(a.price*100)::BIGINT % 800)/100.0 END::DOUBLE m,
  CASE WHEN (a.o + a.n + b.n) % {ZERO_EVERY} = 0 THEN 0 ELSE -(a.qty+b.qty)::INT END e, round(100*(1-a.disc), 1) pident, a.qty::BIGINT len, (1+b.qty)::BIGINT x, (a.qty+b.qty)::BIGINT y
  FROM ln a JOIN ln b ON a.o = b.o AND a.n <> b.n),
iv AS (SELECT *, max(y) OVER (PARTITION BY q, s ORDER BY x, y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) p FROM (SELECT DISTINCT q, s, x, y FROM hits)),
cov AS (SELECT q, s, sum(greatest(0, y - greatest(x - 1, coalesce(p, 0)))) c FROM iv GROUP BY q, s),
col AS (SELECT q, s, any_value(qt) qt, any_value(st) st, min(struct_pack(l := line_id, e := e, m := m)).m m, min(struct_pack(l := line_id, e := e, m := m)).e e0, floor(sum(pident*len)/sum(len)*10 + 0.5)/10 pi, any_value(least(ql, sl)) sh FROM hits GROUP BY q, s),
lo AS (SELECT min(e0) FILTER (WHERE m <> 0) lo FROM col),
sim AS (SELECT q, s, qt, st, m, (CASE WHEN m = 0 THEN lo - 1 ELSE e0 END)::INT e, pi, floor(1000*c/sh::DOUBLE + 0.5)/10 pm FROM col JOIN cov USING (q, s), lo)
"""


def similarity_graph(spark: SparkSession, d: str) -> DataFrame:
    """Directed graph (src, dst, weight) of all records of similarities: from query to subject, with minus
    the decimal logarithm of the e-value, at most 200, which zero has; of several records the best.
    Records without an id or e-value, or with an e-value of 1 and more, are no arcs."""
    mant, exp = F.col("evalue_mant"), F.col("evalue_exp")
    value = F.when(mant == 0, MOST_WEIGHT).otherwise(F.least(F.lit(MOST_WEIGHT), -(F.log10(mant) + exp)))
    rows = table(spark, d, "similarities").where("evalue_mant IS NOT NULL AND evalue_exp IS NOT NULL")
    arcs = rows.select(clean_id(F.col("query_id")).alias("src"), clean_id(F.col("subject_id")).alias("dst"), value.alias("weight"))
    return arcs.where("src IS NOT NULL AND dst IS NOT NULL AND weight > 0").groupBy("src", "dst").agg(F.max("weight").alias("weight"))


def _bare(col: str) -> str:
    return f"nullif(trim({col}, E' \\t\\r'), '')"


GRAPH_SQL = f"""
g AS (SELECT src, dst, max(w) w FROM (SELECT {_bare("query_id")} src, {_bare("subject_id")} dst,
  CASE WHEN evalue_mant = 0 THEN 200.0::DOUBLE ELSE least(200.0::DOUBLE, -(log10(evalue_mant) + evalue_exp)) END w
  FROM similarities WHERE evalue_mant IS NOT NULL AND evalue_exp IS NOT NULL)
  WHERE src IS NOT NULL AND dst IS NOT NULL AND w > 0 GROUP BY src, dst)
"""


def gene_clusters(spark: SparkSession, d: str, by: str) -> DataFrame:
    """(cluster_id, node): all genes by 'taxon' or by 'band', hundreds of residues."""
    genes = table(spark, d, "genes").select(clean_id(F.col("gene_id")).alias("node"), clean_id(F.col("taxon")).alias("t"), "length").where("node IS NOT NULL")
    named = {"taxon": F.coalesce(F.min("t"), F.lit("none")), "band": F.coalesce(F.floor(F.max("length") / 100), F.lit(-1)).cast("string")}[by]
    return genes.groupBy("node").agg(named.alias("cluster_id")).select("cluster_id", "node")


GENES_SQL = f"""
c AS (SELECT node, coalesce(min(t), 'none') taxon, coalesce(max(length) // 100, -1)::VARCHAR band
  FROM (SELECT {_bare("gene_id")} node, {_bare("taxon")} t, length FROM genes) WHERE node IS NOT NULL GROUP BY node)
"""


def gene_number(node: Column) -> Column:
    """The number in the id of a gene, after its taxon; null if it has none."""
    return F.regexp_extract(node, r"\|[^0-9]*([0-9]+)", 1).try_cast("bigint")


def searched(g: DataFrame) -> DataFrame:
    """(node): the nodes of a graph of genes that searches start from, those with a number divisible by 50."""
    return nodes(g).where(gene_number(F.col("node")) % 50 == 0)


SEARCHED_SQL = r"""
q AS (SELECT DISTINCT node FROM (SELECT src node FROM g UNION ALL SELECT dst FROM g) WHERE try_cast(regexp_extract(node, '\|[^0-9]*([0-9]+)', 1) AS BIGINT) % 50 = 0)
"""


def part_clusters(spark: SparkSession, d: str, column: str) -> DataFrame:
    """(cluster_id, node): parts grouped by one of their columns."""
    return table(spark, d, "part").select(F.col(column).cast("string").alias("cluster_id"), F.col("p_partkey").alias("node"))
