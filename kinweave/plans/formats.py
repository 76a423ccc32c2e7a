"""Queries of vectors, sequences, text formats and streams; and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions import fasta
from kinweave.operators import clusters as cl
from kinweave.operators import graph as gr
from kinweave.operators import hsp, parsing, vectors
from kinweave.plans import relations
from kinweave.plans.adapters import part_clusters
from kinweave.plans.graphs import rounded
from kinweave.plans.problems import _bare
from kinweave.session import shared_dir
from kinweave.sources import sinks, text
from kinweave.streaming import hits as streams
from kinweave.tables import clean_id, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _add(name: str, query: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        SQL[name] = sql


# Vectors.
def _vectors(measure: str, rank: bool = False, **more: object) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, d: str) -> DataFrame:
        rows = table(spark, d, "embeddings").select("vec_id", "embedding")
        rows = vectors.rank_transform(rows, "vec_id", "embedding") if rank else rows
        return rounded(vectors.against(rows, rows.where("vec_id % 50 = 0"), "vec_id", "embedding", measure, **more))

    return query


def _gapped(measure: str) -> Callable[[SparkSession, str], DataFrame]:
    """Vectors whose negative numbers count as missing."""

    def query(spark: SparkSession, d: str) -> DataFrame:
        rows = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda v: F.when(v >= 0, v)).alias("embedding"))
        return rounded(vectors.against(rows, rows.where("vec_id % 50 = 0"), "vec_id", "embedding", measure, gaps=True))

    return query


_V = """WITH v AS (SELECT vec_id id, embedding::DOUBLE[] e FROM embeddings), p AS (SELECT a.id q, b.id r, a.e x, b.e y FROM v a JOIN v b ON a.id % 50 = 0 AND a.id <> b.id)
SELECT q query, r row, round({}, 6) score FROM p"""
_SUM = "list_sum(list_transform(list_zip(x, y), lambda z: {}))"
_PEARSON = """(len(x) * list_inner_product(x, y) - list_sum(x) * list_sum(y))
/ sqrt((len(x) * list_inner_product(x, x) - list_sum(x) * list_sum(x)) * (len(x) * list_inner_product(y, y) - list_sum(y) * list_sum(y)))"""
_COS = "greatest(-1, least(1, list_cosine_similarity(x, y)))"
for _measure, _sql in {
    "dot": "list_inner_product(x, y)",
    "cosine": _COS,
    "sine": f"sqrt(1 - power({_COS}, 2))",
    "half_sine": f"sqrt(0.5 - 0.5 * {_COS})",
    "half_cosine": f"sqrt(0.5 + 0.5 * {_COS})",
    "angle": f"acos({_COS})",
    "acute": f"acos(abs({_COS}))",
    "cosine_skew": "sqrt(greatest(0, list_inner_product(x, y))) / sqrt(list_inner_product(x, x))",
    "pearson": _PEARSON,
    "euclid": "list_distance(x, y)",
    "taxi": _SUM.format("abs(z[1] - z[2])"),
    "chebyshev": "list_max(list_transform(list_zip(x, y), lambda z: abs(z[1] - z[2])))",
}.items():
    _add(f"vector_{_measure}", _vectors(_measure), _V.format(_sql))
_add("vector_minkowski", _vectors("minkowski", power=3.0), _V.format(f"power({_SUM.format('power(abs(z[1] - z[2]), 3)')}, 1.0 / 3)"))
_add(
    "vector_spearman",
    _vectors("pearson", True),
    """WITH c AS (SELECT vec_id id, unnest(embedding)::DOUBLE v, generate_subscripts(embedding, 1) p FROM embeddings),
k AS (SELECT id, p, rank() OVER (PARTITION BY id ORDER BY v) + (count(*) OVER (PARTITION BY id, v) - 1) / 2.0 k FROM c), v AS (SELECT id, list(k ORDER BY p)::DOUBLE[] e FROM k GROUP BY id), """
    + _V.format(_PEARSON).split("embeddings), ", 1)[1],
)
_SHARED = (
    _V.split("\n")[0]
    + """, z AS (SELECT q, r, list_filter(list_zip(x, y), lambda z: z[1] >= 0 AND z[2] >= 0) z FROM p), w AS (SELECT q, r, list_transform(z, lambda v: v[1]) x, list_transform(z, lambda v: v[2]) y FROM z WHERE len(z) > 0)
SELECT q query, r row, round({}, 6) score FROM w WHERE {}"""
)
_add("vector_cosine_gaps", _gapped("cosine"), _SHARED.format("list_cosine_similarity(x, y)", "true"))
_add("vector_pearson_gaps", _gapped("pearson"), _SHARED.format(_PEARSON, "len(x) > 1"))
_add(
    "set_scores",
    lambda s, d: rounded(
        vectors.set_scores(
            table(s, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("item")),
            table(s, d, "orders").where("o_orderkey % 50 = 0").select(F.col("o_orderkey").alias("id")),
        )
    ),
    """WITH s AS (SELECT DISTINCT l_orderkey id, l_partkey item FROM lineitem), n AS (SELECT id, count(*) n FROM s GROUP BY id),
m AS (SELECT a.id q, b.id r, count(*) m FROM s a JOIN s b ON a.item = b.item AND a.id <> b.id WHERE a.id IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 50 = 0) GROUP BY 1, 2)
SELECT q query, r row, m meet, round(m / (x.n + y.n - m), 6) tanimoto, round(m / sqrt(x.n * y.n), 6) cosine, round(m / x.n, 6) cover, x.n + y.n - 2*m hamming FROM m JOIN n x ON x.id = q JOIN n y ON y.id = r""",
)


# Sequences.
def _sequences(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.coalesce("lang", F.lit("xx")).alias("taxon"), F.concat_ws("|", "source", "speaker").alias("header"), F.col("text").alias("sequence"))


def _registrations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "genes").select(clean_id(F.col("gene_id")).alias("gene_id"), clean_id(F.col("taxon")).alias("taxon"), "length", "loaded_at", "withdrawn_at")


_F = "WITH f AS (SELECT doc_id, coalesce(lang, 'xx') taxon, concat_ws('|', source, speaker) header, coalesce(text, '') sequence FROM documents) "
_LETTERS = r"regexp_replace(sequence, '[^\p{L}]', '', 'g')"
_POOR = f"(length(sequence) < 100 OR 100 * (length(sequence) - length({_LETTERS})) > 20 * length(sequence))"
_REG = f"WITH r AS (SELECT DISTINCT {_bare('gene_id')} gene_id, {_bare('taxon')} taxon, length, loaded_at, withdrawn_at FROM genes) "
_add(
    "fasta_adjust",
    lambda s, d: _sequences(s, d).select("doc_id", fasta.adjusted_id(F.col("header"), F.col("taxon"), 2).alias("id")),
    _F + ", h AS (SELECT doc_id, taxon, string_split(trim(regexp_replace(replace(header, '|', ' '), ' +', ' ', 'g'), ' '), ' ') h FROM f) SELECT doc_id, taxon || '|' || nullif(h[2], '') id FROM h",
)
_add("fasta_sanitize", lambda s, d: _sequences(s, d).select("doc_id", fasta.letters(F.col("sequence")).alias("letters")), _F + f"SELECT doc_id, {_LETTERS} letters FROM f")
_add("fasta_poor", lambda s, d: _sequences(s, d).where(fasta.is_poor(F.col("sequence"), 100, 20)).select("doc_id"), _F + f"SELECT doc_id FROM f WHERE {_POOR}")
_add(
    "reject_rates",
    lambda s, d: rounded(fasta.reject_rates(_sequences(s, d), "taxon", "sequence", 100, 20)),
    _F + f"""SELECT taxon, count(*) sequences, count(*) FILTER (WHERE {_POOR}) rejected, round(100.0 * count(*) FILTER (WHERE {_POOR}) / count(*), 6) percent,
100.0 * count(*) FILTER (WHERE {_POOR}) / count(*) > 10 suspicious FROM f GROUP BY taxon""",
)
_add(
    "fasta_wrap",
    lambda s, d: _sequences(s, d).select("doc_id", fasta.wrapped(fasta.letters(F.col("sequence"))).alias("wrapped")),
    _F + f""", l AS (SELECT doc_id, {_LETTERS} l FROM f)
SELECT doc_id, array_to_string(list_transform(range(0, greatest(1, (length(l) + 59) // 60)), lambda i: substr(l, i * 60 + 1, 60)), chr(10)) wrapped FROM l""",
)
_add("duplicate_ids", lambda s, d: fasta.duplicate_ids(_registrations(s, d), "gene_id"), _REG + "SELECT gene_id, count(*) copies FROM r WHERE gene_id IS NOT NULL GROUP BY gene_id HAVING count(*) > 1")
_add(
    "header_mismatches",
    lambda s, d: fasta.header_mismatches(_registrations(s, d).distinct(), "gene_id", "taxon").select("gene_id", "taxon"),
    _REG + "SELECT gene_id, taxon FROM r WHERE split_part(coalesce(gene_id, ''), '|', 1) IS DISTINCT FROM taxon",
)


# Text formats.
def _abc_lines(spark: SparkSession, d: str) -> DataFrame:
    weight = F.when(F.col("l_linenumber") < 5, F.col("l_quantity").cast("int").cast("string"))
    return table(spark, d, "lineitem").select("l_linenumber", F.concat_ws("\t", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"), weight).alias("value"))


def _sold(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_quantity").alias("weight"), "l_linenumber")


#: Lines of an order that bear the same number stand in the order of their quantity.
_LINE = ("l_linenumber", "weight")


def _matrix_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = shared_dir(spark, "matrix")
    sinks.write(sinks.matrix_lines(gr.load(_sold(spark, d), "max", mirror=False)), path)
    return text.matrix(spark, path)


def _tabs(spark: SparkSession, d: str) -> list[DataFrame]:
    """Two tabs, read from their lines: brands of the smaller parts, types of all."""
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("idx"), "p_brand", "p_type", "p_size")
    own = lambda df, label: text.tab(sinks.tab_lines(df.select("idx", F.col(label).alias("label"))))
    return [own(parts.where("p_size <= 25"), "p_brand"), own(parts.where("p_size > 10"), "p_type")]


_A = "WITH a AS (SELECT l_orderkey src, l_partkey dst, CASE WHEN l_linenumber < 5 THEN l_quantity ELSE 1.0 END w, l_linenumber n FROM lineitem) "
_add("abc_parse", lambda s, d: text.numbered_abc(_abc_lines(s, d)), _A + "SELECT src, dst, w weight FROM a")
for _how, _agg in {"max": "max(w)", "min": "min(w)", "add": "sum(w)", "mul": "product(w)"}.items():
    _add(f"edge_merge_{_how}", lambda s, d, h=_how: gr.load(text.numbered_abc(_abc_lines(s, d)), h, mirror=False), _A + f"SELECT src, dst, {_agg} weight FROM a GROUP BY src, dst")
_add("edge_merge_first", lambda s, d: gr.merge_ordered(_sold(s, d), _LINE), "SELECT l_orderkey src, l_partkey dst, arg_min(l_quantity, struct_pack(n := l_linenumber, q := l_quantity)) weight FROM lineitem GROUP BY 1, 2")
_add("edge_merge_last", lambda s, d: gr.merge_ordered(_sold(s, d), _LINE, True), "SELECT l_orderkey src, l_partkey dst, arg_max(l_quantity, struct_pack(n := l_linenumber, q := l_quantity)) weight FROM lineitem GROUP BY 1, 2")
_add("list_lines", lambda s, d: text.lists(sinks.neighbour_lines(_sold(s, d).select("src", "dst").distinct())), "SELECT DISTINCT l_orderkey::VARCHAR src, l_partkey::VARCHAR dst, 1.0::DOUBLE weight FROM lineitem")
_add(
    "numbered_list_lines",
    lambda s, d: text.numbered_sources(_sold(s, d).groupBy("src").agg(F.concat_ws(" ", F.array_sort(F.collect_set(F.col("dst").cast("string")))).alias("value")), "src"),
    "SELECT DISTINCT dense_rank() OVER (ORDER BY l_orderkey) - 1 src, l_partkey::VARCHAR dst, 1.0::DOUBLE weight FROM lineitem",
)
_add("matrix_lines", _matrix_round_trip, "SELECT l_orderkey src, l_partkey dst, max(l_quantity) weight FROM lineitem GROUP BY 1, 2")
_add("dump_upper", lambda s, d: sinks.dumped(gr.load(_sold(s, d), "add"), "upper", False), "SELECT least(l_orderkey, l_partkey) src, greatest(l_orderkey, l_partkey) dst, sum(l_quantity) weight FROM lineitem WHERE l_orderkey <> l_partkey GROUP BY 1, 2")
for _how, _join in {"merge": "FULL JOIN b USING (idx)", "meet": "SEMI JOIN b USING (idx)", "left": "ANTI JOIN b USING (idx)"}.items():
    _label = "coalesce(a.label, b.label)" if _how == "merge" else "a.label"
    _add(f"tab_{_how}", lambda s, d, h=_how: text.merged_tabs(*_tabs(s, d), h), f"WITH a AS (SELECT p_partkey idx, p_brand label FROM part WHERE p_size <= 25), b AS (SELECT p_partkey idx, p_type label FROM part WHERE p_size > 10) SELECT idx, {_label} label FROM a {_join}")
for _mode, _end in {"restrict": "JOIN", "extend": "LEFT JOIN"}.items():
    _add(
        f"labelled_{_mode}",
        lambda s, d, m=_mode: text.labelled(table(s, d, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"), F.col("l_quantity").alias("weight")), _tabs(s, d)[0], m),
        f"""WITH a AS (SELECT p_partkey idx, p_brand label FROM part WHERE p_size <= 25)
SELECT coalesce(x.label, l_partkey::VARCHAR) src, coalesce(y.label, l_suppkey::VARCHAR) dst, l_quantity weight FROM lineitem {_end} a x ON x.idx = l_partkey {_end} a y ON y.idx = l_suppkey""",
    )
_add(
    "table_lines",
    lambda s, d: text.table_vectors(
        table(s, d, "customer").select(F.concat_ws("\t", F.col("c_custkey").cast("string"), "c_mktsegment", F.col("c_acctbal").cast("string"), F.col("c_nationkey").cast("string")).alias("value")), skip=1
    ).select("label", F.col("vector")[0].alias("first"), F.col("vector")[1].alias("second"), F.size("vector").alias("n")),
    'SELECT c_custkey::VARCHAR label, c_acctbal AS "first", c_nationkey::DOUBLE AS "second", 2 AS n FROM customer',
)
_add(
    "pair_lines",
    lambda s, d: text.reciprocal_pairs(sinks.pair_lines(relations.reciprocal_strict(s, d).select(F.col("seq_b").alias("seq_a"), F.col("seq_a").alias("seq_b")))),
    relations.SQL["reciprocal_strict"],
)
_add(
    "edge_lines",
    lambda s, d: sinks.edge_lines(relations.relation_edges(s, d)),
    "WITH e AS (" + relations.SQL["edge_union"] + r") SELECT seq_a || chr(9) || seq_b || chr(9) || regexp_replace(format('{:.3f}', score), '\.?0+$', '') AS value FROM e",
)
_add(
    "table_summary",
    lambda s, d: sinks.summary(similarities=table(s, d, "similarities"), genes=table(s, d, "genes"), taxa=table(s, d, "taxa")),
    "SELECT 'similarities' AS name, count(*) records FROM similarities UNION ALL SELECT 'genes', count(*) FROM genes UNION ALL SELECT 'taxa', count(*) FROM taxa",
)
_add(
    "nested_order",
    lambda s, d: cl.nested_order([part_clusters(s, d, "p_brand"), part_clusters(s, d, "p_type")]),
    """WITH a AS (SELECT p_partkey node, p_brand x, p_type y, count(*) OVER (PARTITION BY p_brand) nx, count(*) OVER (PARTITION BY p_type) ny FROM part)
SELECT node, row_number() OVER (ORDER BY nx DESC, x, ny DESC, y, node) - 1 place FROM a""",
)


# Hit reports.
def _hits(spark: SparkSession, d: str) -> DataFrame:
    return parsing.clean(parsing.parsed(table(spark, d, "blast_lines")), spark)


def _runs(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "blast_lines").select(F.col("line_id").alias("row"), "file_name").distinct()
    return hsp.runs(_hits(spark, d).select("row", "query_id", "subject_id").join(files, "row"), "row").select(F.col("row").alias("line_id"), "file_name", "run")


for _score, _above, _sql in (("evalue", 5.0, "CASE WHEN ev = 0 THEN 200 ELSE least(200, -log10(ev)) END"), ("bits", 100.0, "bits"), ("density", 0.5, "bits / nullif(len, 0)")):
    _add(
        f"report_{_score}",
        lambda s, d, k=_score, a=_above: rounded(text.hit_weights(_hits(s, d), k, a)),
        relations._HITS + f"SELECT q src, s dst, round({_sql}, 6)::DOUBLE weight FROM h3 WHERE {_sql} > {_above}",
    )
_add(
    "hit_runs",
    _runs,
    relations._HITS
    + """, f AS (SELECT DISTINCT line_id, file_name FROM blast_lines), o AS (SELECT line_id, file_name, q, s, lag(q) OVER w lq, lag(s) OVER w ls FROM h3 JOIN f USING (line_id) WHERE file_name IS NOT NULL WINDOW w AS (PARTITION BY file_name ORDER BY line_id))
SELECT line_id, file_name, sum(CASE WHEN lq IS NOT DISTINCT FROM q AND ls IS NOT DISTINCT FROM s THEN 0 ELSE 1 END) OVER (PARTITION BY file_name ORDER BY line_id)::BIGINT run FROM o""",
)

# Streams.
_add(
    "stream_pairs",
    lambda s, d: streams.drain(streams.pair_totals(streams.once(streams.source(s, d, "subject_accumulators"), "acc_id"))),
    """SELECT query_id, subject_id, count(*) hits, sum(total_length)::BIGINT aligned, min(evalue_exp) best_exp
FROM (SELECT DISTINCT acc_id, query_id, subject_id, total_length, evalue_exp FROM subject_accumulators) GROUP BY 1, 2""",
)
_add(
    "stream_windows",
    lambda s, d: streams.drain(streams.windowed_counts(streams.source(s, d, "events"), "ts", "event_type"), "complete").withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd")),
    "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') window_start, event_type, count(*) n FROM events GROUP BY 1, 2",
)
