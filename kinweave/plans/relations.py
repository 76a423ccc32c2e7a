"""Queries of the hit and pair stages, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.config import Cutoff, PairConfig
from kinweave.functions.evalue import edge_score, repair_zero_exponents, split_evalue
from kinweave.operators import hsp, pairs, parsing
from kinweave.plans import order_records
from kinweave.plans.adapters import HITS_SQL, order_hits
from kinweave.plans.problems import _CELLS, _bare
from kinweave.session import checkpointed
from kinweave.tables import clean_id, table

CFG = PairConfig(30.0, Cutoff(1.0, -20))
_OK = "(pm >= 30 AND (m = 0 OR e < -20 OR (e = -20 AND m <= 1.0)))"


def _sim(spark: SparkSession, d: str) -> DataFrame:
    """Similarity records of the order hits, written once as every stage reads them."""
    return checkpointed(repair_zero_exponents(hsp.collapse(order_hits(spark, d))))


def _needed(spark: SparkSession, d: str, every: bool = True) -> DataFrame:
    """The records of ``_sim`` that relations depend on; co-orthologs and strict pairs need ``every`` one that passes."""
    kept = order_records.records(spark, d, CFG, every)
    return _sim(spark, d) if kept is None else kept


def _taxon_of(col):
    return F.substring_index(col, "|", 1)


def hsp_collapse(spark: SparkSession, d: str) -> DataFrame:
    return repair_zero_exponents(hsp.collapse(order_hits(spark, d)))


def blast_similarities(spark: SparkSession, d: str) -> DataFrame:
    hits = parsing.clean(parsing.parsed(table(spark, d, "blast_lines")), spark).withColumnRenamed("row", "line_id")
    genes = hsp.unique_genes(table(spark, d, "genes"), clean_id(F.col("gene_id")), clean_id(F.col("taxon")))
    return hsp.to_similarities(hits, genes)


def accumulated_similarities(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "subject_accumulators").withColumns({c: clean_id(F.col(c)) for c in ("query_id", "subject_id")})
    return hsp.finish_accumulators(parts, _taxon_of)


def evalue_split(spark: SparkSession, d: str) -> DataFrame:
    hits = parsing.clean(parsing.parsed(table(spark, d, "blast_lines")), spark)
    mant, exp = split_evalue(F.col("evalue"))
    return hits.select(F.col("row").alias("line_id"), mant.alias("mant"), exp.alias("exp"))


def _similarities(spark: SparkSession, d: str) -> DataFrame:
    """The similarity table, one record per pair; taxa that are missing come from the ids."""
    ids = {c: clean_id(F.col(c)) for c in ("query_id", "subject_id")}
    rows = table(spark, d, "similarities").withColumns(ids)
    rows = rows.withColumns({f"{s}_taxon": F.coalesce(clean_id(F.col(f"{s}_taxon")), _taxon_of(F.col(f"{s}_id"))) for s in ("query", "subject")})
    return pairs.last_records(rows, ["loaded_at", "record_id"])


def zero_exponent_repair(spark: SparkSession, d: str) -> DataFrame:
    return repair_zero_exponents(_similarities(spark, d)).select("query_id", "subject_id", "evalue_mant", "evalue_exp")


def threshold_legacy(spark: SparkSession, d: str) -> DataFrame:
    return _similarities(spark, d).where(pairs.accepted(PairConfig(50.0, Cutoff(1.0, -5), legacy=True))).select("query_id", "subject_id")


def threshold_mantissa(spark: SparkSession, d: str) -> DataFrame:
    return repair_zero_exponents(_similarities(spark, d)).where(pairs.accepted(PairConfig())).select("query_id", "subject_id")


def best_hit_per_taxon(spark: SparkSession, d: str) -> DataFrame:
    best = pairs.best_per_taxon(repair_zero_exponents(_similarities(spark, d)))
    return best.select("query_id", "subject_taxon", "best.exp", "best.mant")


def best_hit_other_taxon(spark: SparkSession, d: str) -> DataFrame:
    return pairs.best_other_taxon(repair_zero_exponents(_similarities(spark, d))).select("query_id", "best.exp", "best.mant")


def best_hits(spark: SparkSession, d: str) -> DataFrame:
    return pairs.best_hits(repair_zero_exponents(_similarities(spark, d)), PairConfig()).select("query_id", "subject_id")


def reciprocal_global(spark: SparkSession, d: str) -> DataFrame:
    hits = order_hits(spark, d)
    evalue = F.col("evalue_mant") * F.pow(F.lit(10.0), F.col("evalue_exp"))
    return pairs.global_reciprocal(hits.select("query_id", "subject_id", evalue.alias("evalue"), F.col("length").alias("bits")))


def _edges(df: DataFrame) -> DataFrame:
    return df.select("seq_a", "seq_b", "taxon_a", "taxon_b", *[F.round(c, 6).alias(c) for c in ("unnormalized_score", "normalized_score")])


def orthologs(spark: SparkSession, d: str) -> DataFrame:
    return _edges(pairs.orthologs(_sim(spark, d), CFG))


def inparalogs(spark: SparkSession, d: str) -> DataFrame:
    sim = _needed(spark, d, every=False)
    return _edges(pairs.inparalogs(sim, CFG, pairs.orthologs(sim, CFG)))


def coorthologs(spark: SparkSession, d: str) -> DataFrame:
    return _edges(pairs.build(_sim(spark, d), CFG)["coorthologs"])


def relation_edges(spark: SparkSession, d: str) -> DataFrame:
    """All three classes of edges."""
    found = pairs.relations(_needed(spark, d), CFG)
    return pairs.edge_union(found["orthologs"], found["inparalogs"], found["coorthologs"])


def edge_union(spark: SparkSession, d: str) -> DataFrame:
    return relation_edges(spark, d).select("seq_a", "seq_b", "edge_type", edge_score(F.col("normalized_score")).alias("score"))


def reciprocal_strict(spark: SparkSession, d: str) -> DataFrame:
    return pairs.strict_reciprocal(_sim(spark, d), CFG)


def raw_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """Scores of orthologs and of all reciprocal records, which hold the orthologs again, as one list."""
    sim = _sim(spark, d)
    all_pairs = pairs._reciprocal(sim.where(pairs.accepted(CFG) & (F.col("query_taxon") != F.col("subject_taxon"))), pairs.BEST_ZERO)
    raw = [df.select("seq_a", "seq_b", "unnormalized_score") for df in (pairs.orthologs(sim, CFG), all_pairs)]
    return pairs.raw_dedupe(raw[0].unionByName(raw[1]), ["seq_a", "seq_b"], "unnormalized_score").withColumn("unnormalized_score", F.round("unnormalized_score", 6))


def _of_similarities(spark: SparkSession, d: str) -> DataFrame:
    return checkpointed(repair_zero_exponents(_similarities(spark, d)))


def similarity_orthologs(spark: SparkSession, d: str) -> DataFrame:
    return _edges(pairs.orthologs(_of_similarities(spark, d), PairConfig()))


def similarity_inparalogs(spark: SparkSession, d: str) -> DataFrame:
    return _edges(pairs.build(_of_similarities(spark, d), PairConfig())["inparalogs"])


def similarity_coorthologs(spark: SparkSession, d: str) -> DataFrame:
    return _edges(pairs.build(_of_similarities(spark, d), PairConfig())["coorthologs"])


def similarity_reciprocal(spark: SparkSession, d: str) -> DataFrame:
    return pairs.strict_reciprocal(_of_similarities(spark, d), PairConfig())


QUERIES = {
    f.__name__: f
    for f in (hsp_collapse, blast_similarities, accumulated_similarities, evalue_split, zero_exponent_repair, threshold_legacy, threshold_mantissa, best_hit_per_taxon, best_hit_other_taxon, best_hits, reciprocal_global, orthologs, inparalogs, coorthologs, edge_union, reciprocal_strict, raw_dedupe, similarity_orthologs, similarity_inparalogs, similarity_coorthologs, similarity_reciprocal)
}

_RECORDS = f"""
r0 AS (SELECT DISTINCT record_id, {_bare("query_id")} q, {_bare("subject_id")} s, {_bare("query_taxon")} qt, {_bare("subject_taxon")} st, evalue_mant m, evalue_exp e, percent_match pm, loaded_at FROM similarities),
r1 AS (SELECT record_id, loaded_at, q, s, coalesce(qt, split_part(q, '|', 1)) qt, coalesce(st, split_part(s, '|', 1)) st, m, e, pm FROM r0 WHERE q IS NOT NULL AND s IS NOT NULL AND m IS NOT NULL AND e IS NOT NULL AND pm IS NOT NULL),
sim0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q, s ORDER BY loaded_at DESC, record_id DESC) k FROM r1) WHERE k = 1),
lo AS (SELECT min(e) FILTER (WHERE m <> 0) lo FROM sim0),
sim AS (SELECT q, s, qt, st, m, (CASE WHEN m = 0 THEN lo - 1 ELSE e END)::INT e, pm FROM sim0, lo)
"""
_OK5 = "(pm >= 50 AND (m = 0 OR e < -5 OR (e = -5 AND m <= 1.0)))"


def _score(z: object) -> str:
    return f"CASE WHEN l.m < {z} OR r.m < {z} THEN (l.e+r.e)/-2.0 ELSE (log10(l.m*r.m)+l.e+r.e)/-2.0 END"


def _relations(ok: str) -> str:
    score = _score
    return f"""
bt AS (SELECT q, st, min(struct_pack(e := e, m := m)) b FROM sim WHERE qt <> st GROUP BY q, st),
bh AS (SELECT sim.* FROM sim JOIN bt USING (q, st) WHERE qt <> st AND {ok} AND (m < 0.01 OR (e = b.e AND m = b.m))),
oraw AS (SELECT l.q a, l.s b, l.qt ta, l.st tb, {score(0.01)} raw FROM bh l JOIN bh r ON l.q = r.s AND l.s = r.q WHERE l.q < l.s),
ortho AS (SELECT *, raw / nullif(avg(raw) OVER (PARTITION BY least(ta, tb), greatest(ta, tb)), 0) norm FROM oraw),
bi AS (SELECT q, min(struct_pack(e := e, m := m)) b FROM sim WHERE qt <> st GROUP BY q),
ic AS (SELECT sim.* FROM sim LEFT JOIN bi USING (q) WHERE qt = st AND q <> s AND {ok} AND (b IS NULL OR m < 0.001 OR e < b.e OR (e = b.e AND m <= b.m))),
iraw AS (SELECT l.q a, l.s b, l.qt ta, l.st tb, {score(0.01)} raw FROM ic l JOIN ic r ON l.q = r.s AND l.s = r.q WHERE l.q < l.s),
oid AS (SELECT a id FROM ortho UNION SELECT b FROM ortho),
ifl AS (SELECT *, a IN (SELECT id FROM oid) OR b IN (SELECT id FROM oid) f FROM iraw),
para AS (SELECT a, b, ta, tb, raw, raw / nullif(coalesce(avg(raw) FILTER (WHERE f) OVER (PARTITION BY ta), avg(raw) OVER (PARTITION BY ta)), 0) norm FROM ifl),
ip2 AS (SELECT a x, b y FROM para UNION ALL SELECT b, a FROM para), or2 AS (SELECT a x, b y FROM ortho UNION ALL SELECT b, a FROM ortho),
cand AS (SELECT DISTINCT least(x, z) a, greatest(x, z) b FROM (SELECT i.x, o.y z FROM ip2 i JOIN or2 o ON i.y = o.x UNION ALL SELECT i.x, j.y FROM ip2 i JOIN or2 o ON i.y = o.x JOIN ip2 j ON j.x = o.y) WHERE x <> z),
cnew AS (SELECT * FROM cand WHERE NOT EXISTS (SELECT 1 FROM ortho WHERE ortho.a = cand.a AND ortho.b = cand.b)),
acc AS (SELECT * FROM sim WHERE {ok}),
craw AS (SELECT c.a, c.b, l.qt ta, l.st tb, {score(0.00001)} raw FROM cnew c JOIN acc l ON l.q = c.a AND l.s = c.b JOIN acc r ON r.q = c.b AND r.s = c.a),
co AS (SELECT *, raw / nullif(avg(raw) OVER (PARTITION BY least(ta, tb), greatest(ta, tb)), 0) norm FROM craw)
"""


_ORDER = f"WITH {HITS_SQL}, {_relations(_OK)} "
_REC = f"WITH {_RECORDS} "
_SIM = f"WITH {_RECORDS}, {_relations(_OK5)} "
_STRICT = """, acc AS (SELECT * FROM sim WHERE qt <> st AND {ok}), k AS (SELECT q, s, st, rank() OVER (PARTITION BY q, st ORDER BY e, m) k FROM acc),
u AS (SELECT q, any_value(s) s FROM k WHERE k = 1 GROUP BY q, st HAVING count(*) = 1) SELECT x.q seq_a, x.s seq_b FROM u x JOIN u y ON x.q = y.s AND x.s = y.q WHERE x.q < x.s"""
_EDGE = "a seq_a, b seq_b, ta taxon_a, tb taxon_b, round(raw, 6) unnormalized_score, round(norm, 6) normalized_score"
_SIMCOLS = "q query_id, s subject_id, qt query_taxon, st subject_taxon, m evalue_mant, e evalue_exp, pi percent_identity, pm percent_match"
_HITS = _CELLS + r""", h AS (SELECT line_id, trim(v[1], E' \t\r') q, trim(v[2], E' \t\r') s, v[3]::DOUBLE pident, v[4]::BIGINT len, v[7]::BIGINT qs, v[8]::BIGINT qe, v[9]::BIGINT ss, v[10]::BIGINT se,
(CASE WHEN regexp_matches(v[11], '^[eE]') THEN '1' || v[11] ELSE v[11] END)::DOUBLE ev, v[12]::DOUBLE bits FROM j WHERE ok), h2 AS (SELECT *, split(format('{:.3e}', ev * (1 + 1e-12)), 'e') ev2 FROM h), h3 AS (SELECT *, floor(ev2[1]::DOUBLE*100 + 0.5)/100 m, ev2[2]::INT e FROM h2)
"""
_COVER = "iv AS (SELECT *, max(y) OVER (PARTITION BY q, s ORDER BY x, y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) p FROM sp), cov AS (SELECT q, s, sum(greatest(0, y - greatest(x - 1, coalesce(p, 0)))) c FROM iv GROUP BY q, s)"

SQL = {
    "hsp_collapse": f"WITH {HITS_SQL} SELECT {_SIMCOLS} FROM sim",
    "blast_similarities": _HITS
    + f""", gn AS (SELECT {_bare("gene_id")} id, {_bare("taxon")} t, length l, loaded_at FROM genes WHERE length IS NOT NULL), g AS (SELECT id, arg_max(struct_pack(t := t, l := l), struct_pack(a := loaded_at, l := l)) g FROM gn WHERE id IS NOT NULL GROUP BY id),
k AS (SELECT h3.*, a.g.t qt, b.g.t st, a.g.l ql, b.g.l sl FROM h3 JOIN g a ON a.id = h3.q JOIN g b ON b.id = h3.s),
sp AS (SELECT q, s, CASE WHEN ql < sl THEN least(qs, qe) ELSE least(ss, se) END x, CASE WHEN ql < sl THEN greatest(qs, qe) ELSE greatest(ss, se) END y FROM k), {_COVER},
col AS (SELECT q, s, any_value(qt) qt, any_value(st) st, min(struct_pack(l := line_id, e := e, m := m)).m m, min(struct_pack(l := line_id, e := e, m := m)).e e0, floor(sum(pident*len)/sum(len)*10 + 0.5)/10 pi, any_value(least(ql, sl)) sh FROM k GROUP BY q, s),
lo AS (SELECT coalesce(min(e0) FILTER (WHERE m <> 0), 0) lo FROM col)
SELECT q query_id, s subject_id, qt query_taxon, st subject_taxon, m evalue_mant, (CASE WHEN m = 0 THEN lo - 1 ELSE e0 END)::INT evalue_exp, pi percent_identity, floor(1000*c/sh::DOUBLE + 0.5)/10 percent_match FROM col JOIN cov USING (q, s), lo""",
    "accumulated_similarities": f"""
WITH a AS (SELECT DISTINCT acc_id, {_bare("query_id")} q, {_bare("subject_id")} s, run_no, query_length ql, subject_length sl, evalue_mant m, evalue_exp e, total_identities ti, total_length tl FROM subject_accumulators),
u AS (SELECT {_bare("query_id")} q, {_bare("subject_id")} s, unnest(spans) z FROM subject_accumulators),
sp AS (SELECT q, s, least(z.span_start, z.span_end)::BIGINT x, greatest(z.span_start, z.span_end)::BIGINT y FROM u WHERE z.span_start IS NOT NULL AND z.span_end IS NOT NULL), {_COVER},
f AS (SELECT q, s, m, e, row_number() OVER (PARTITION BY q, s ORDER BY run_no, acc_id) k FROM a WHERE m IS NOT NULL AND e IS NOT NULL),
p AS (SELECT q, s, sum(ti) ti, sum(tl) tl, max(ql) ql, max(sl) sl FROM a WHERE q IS NOT NULL AND s IS NOT NULL GROUP BY q, s HAVING sum(tl) > 0)
SELECT p.q query_id, p.s subject_id, split_part(p.q, '|', 1) query_taxon, split_part(p.s, '|', 1) subject_taxon, f.m evalue_mant, f.e evalue_exp, floor(ti/tl*10 + 0.5)/10 percent_identity,
floor(1000*coalesce(c, 0)/least(ql, sl)::DOUBLE + 0.5)/10 percent_match FROM p LEFT JOIN cov ON cov.q = p.q AND cov.s = p.s LEFT JOIN f ON f.q = p.q AND f.s = p.s AND f.k = 1""",
    "evalue_split": _HITS + "SELECT line_id, m mant, e exp FROM h3",
    "zero_exponent_repair": _REC + "SELECT q query_id, s subject_id, m evalue_mant, e evalue_exp FROM sim",
    "threshold_legacy": _REC + "SELECT q query_id, s subject_id FROM sim0 WHERE pm >= 50 AND e <= -5",
    "threshold_mantissa": _REC + f"SELECT q query_id, s subject_id FROM sim WHERE {_OK5}",
    "best_hit_per_taxon": _REC + "SELECT q query_id, st subject_taxon, b.e exp, b.m mant FROM (SELECT q, st, min(struct_pack(e := e, m := m)) b FROM sim WHERE qt <> st GROUP BY q, st)",
    "best_hit_other_taxon": _REC + "SELECT q query_id, b.e exp, b.m mant FROM (SELECT q, min(struct_pack(e := e, m := m)) b FROM sim WHERE qt <> st GROUP BY q)",
    "best_hits": f"WITH {_RECORDS}, {_relations(_OK5)} SELECT q query_id, s subject_id FROM bh",
    "reciprocal_global": f"WITH {HITS_SQL}"
    + """, b AS (SELECT q, s FROM (SELECT q, s, row_number() OVER (PARTITION BY q ORDER BY m * power(10.0, e), len DESC, s) k FROM hits) WHERE k = 1)
SELECT DISTINCT least(x.q, x.s) seq_a, greatest(x.q, x.s) seq_b FROM b x JOIN b y ON x.q = y.s AND x.s = y.q""",
    "orthologs": _ORDER + f"SELECT {_EDGE} FROM ortho",
    "inparalogs": _ORDER + f"SELECT {_EDGE} FROM para",
    "coorthologs": _ORDER + f"SELECT {_EDGE} FROM co",
    "edge_union": _ORDER
    + "SELECT a seq_a, b seq_b, t edge_type, trunc(norm::FLOAT::DOUBLE*1000 + 0.5)/1000 score FROM (SELECT *, 'ortholog' t FROM ortho UNION ALL SELECT a, b, ta, tb, raw, norm, 'inparalog' FROM para UNION ALL SELECT *, 'coortholog' FROM co)",
    "reciprocal_strict": f"WITH {HITS_SQL}" + _STRICT.format(ok=_OK),
    "raw_dedupe": _ORDER
    + f"""SELECT DISTINCT l.q seq_a, l.s seq_b, round({_score("0.01")}, 6) unnormalized_score FROM acc l JOIN acc r ON l.q = r.s AND l.s = r.q WHERE l.q < l.s AND l.qt <> l.st""",
    "similarity_orthologs": _SIM + f"SELECT {_EDGE} FROM ortho",
    "similarity_inparalogs": _SIM + f"SELECT {_EDGE} FROM para",
    "similarity_coorthologs": _SIM + f"SELECT {_EDGE} FROM co",
    "similarity_reciprocal": f"WITH {_RECORDS}" + _STRICT.format(ok=_OK5),
}
