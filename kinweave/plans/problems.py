"""Queries pN_... of the general problems, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions.evalue import ordered_evalue
from kinweave.operators import chunked, intervals, orphans, parsing
from kinweave.session import checkpointed
from kinweave.tables import clean_id, table


def _graph(spark: SparkSession, d: str, children: list[str]) -> DataFrame:
    """Orphans of the gene graph: taxa <- genes <- children (similarities, subject_accumulators)."""
    genes = table(spark, d, "genes")
    registration = F.struct(clean_id(F.col("gene_id")).alias("gene_id"), clean_id(F.col("taxon")).alias("taxon"), "loaded_at", "withdrawn_at")
    gene_row = F.to_json(registration, {"ignoreNullFields": "false"})
    entities = {"taxa": orphans.Entity(table(spark, d, "taxa"), F.col("taxon"), F.lit(None).cast("timestamp")), "genes": orphans.Entity(genes, gene_row, F.col("loaded_at").cast("timestamp"))}
    references = [orphans.Reference("genes", "taxon", clean_id(F.col("taxon")), "taxa", clean_id(F.col("taxon")))]
    for child, row in (("similarities", "record_id"), ("subject_accumulators", "acc_id")):
        if child not in children:
            continue
        entities[child] = orphans.Entity(table(spark, d, child), F.col(row).cast("string"), F.col("loaded_at").cast("timestamp"))
        references += [
            orphans.Reference(child, field, clean_id(F.col(field)), "genes", clean_id(F.col("gene_id")), F.col("loaded_at").cast("timestamp"), F.col("withdrawn_at").cast("timestamp"))
            for field in ("query_id", "subject_id")
        ]
    return orphans.cascade(entities, references)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    found = _graph(spark, d, ["similarities"]).where("kind = 'direct' AND `table` = 'similarities'")
    return found.select(F.col("row").cast("bigint").alias("record_id"), F.col("field").alias("ref_field"))


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.report(_graph(spark, d, ["similarities", "subject_accumulators"]))


def _records(spark: SparkSession, d: str, *more: str) -> DataFrame:
    ids = {c: clean_id(F.col(c)) for c in ("query_id", "query_taxon")}
    rows = chunked.distinct_rows(table(spark, d, "similarities"), F.col("record_id"), ids | {c: F.col(c) for c in more})
    return checkpointed(rows)  # every pass of the chunking reads them


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    rows = _records(spark, d)
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    found = []
    for key, share in (("query_id", 0.01), ("query_taxon", 0.1)):
        counts = chunked.key_counts(rows.select("_row", key), key)
        heavy = counts.join(F.broadcast(total), F.col("n_records") >= F.lit(share) * F.col("total"))  # one row
        found.append(heavy.select(F.lit(key).alias("key_field"), "key_value"))
    return found[0].unionByName(found[1])


def p2_results(spark: SparkSession, d: str) -> DataFrame:
    rows = _records(spark, d, "subject_taxon", "evalue_mant", "evalue_exp").withColumn("subject_taxon", clean_id(F.col("subject_taxon")))
    exp, mant = ordered_evalue(F.col("evalue_mant"), F.col("evalue_exp"))
    best = F.when(F.col("evalue_mant").isNotNull() & F.col("evalue_exp").isNotNull(), F.struct(exp.alias("exp"), mant.alias("mant")))
    results = chunked.key_results(rows, "query_id", "subject_taxon", best)
    return results.select(
        F.col("key_value").alias("query_id"), F.col("n_records").cast("bigint"), F.col("first_row").alias("first_record"), F.col("last_row").alias("last_record"),
        F.col("best.exp").alias("best_exp"), F.col("best.mant").alias("best_mant"), F.col("longest_streak").cast("bigint"),
    )


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return parsing.errors(parsing.parsed(table(spark, d, "blast_lines")), spark).select(F.col("row").alias("line_id"))


def p4_rejects(spark: SparkSession, d: str) -> DataFrame:
    found = parsing.errors(parsing.parsed(table(spark, d, "blast_lines")), spark)
    return found.select(F.col("row").alias("line_id"), F.concat_ws("; ", "reasons").alias("reasons"))


def p4_hits(spark: SparkSession, d: str) -> DataFrame:
    return parsing.clean(parsing.parsed(table(spark, d, "blast_lines")), spark).withColumnRenamed("row", "line_id")


def _pair_spans(spark: SparkSession, d: str) -> tuple[DataFrame, dict, object, object]:
    rows = table(spark, d, "subject_accumulators").select("query_id", "subject_id", F.explode("spans").alias("span"))
    return rows, {c: clean_id(F.col(c)) for c in ("query_id", "subject_id")}, F.col("span.span_start"), F.col("span.span_end")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return intervals.gaps(*_pair_spans(spark, d))


def p5_periods(spark: SparkSession, d: str) -> DataFrame:
    return intervals.periods(*_pair_spans(spark, d))


QUERIES = {f.__name__: f for f in (p1_found, p1_report, p2_found, p2_results, p4_found, p4_rejects, p4_hits, p5_found, p5_periods)}


def _bare(col: str) -> str:
    return f"nullif(trim({col}, E' \\t\\r'), '')"


_ORPHANS = f"""
WITH g AS (SELECT DISTINCT {_bare("gene_id")} id, {_bare("taxon")} taxon, loaded_at, withdrawn_at FROM genes),
t AS (SELECT DISTINCT {_bare("taxon")} taxon FROM taxa),
p AS (SELECT g.*, (taxon IS NOT NULL AND taxon NOT IN (SELECT taxon FROM t)) dead FROM g),
refs AS (
  SELECT DISTINCT 'similarities' tab, record_id rid, 'query_id' f, {_bare("query_id")} id, loaded_at FROM similarities
  UNION SELECT DISTINCT 'similarities', record_id, 'subject_id', {_bare("subject_id")}, loaded_at FROM similarities
  UNION SELECT DISTINCT 'subject_accumulators', acc_id, 'query_id', {_bare("query_id")}, loaded_at FROM subject_accumulators
  UNION SELECT DISTINCT 'subject_accumulators', acc_id, 'subject_id', {_bare("subject_id")}, loaded_at FROM subject_accumulators),
judged AS (
  SELECT r.tab, r.rid, r.f, r.loaded_at, count(p.id) n, count(p.id) FILTER (WHERE NOT p.dead) alive
  FROM refs r LEFT JOIN p ON p.id = r.id AND p.loaded_at <= r.loaded_at AND (p.withdrawn_at IS NULL OR p.withdrawn_at > r.loaded_at)
  WHERE r.id IS NOT NULL GROUP BY ALL)
"""

_RECORDS = f"WITH r AS (SELECT DISTINCT record_id, {_bare('query_id')} q, {_bare('query_taxon')} qt, {_bare('subject_taxon')} st, evalue_mant m, evalue_exp e FROM similarities)"

_CELLS = r"""
WITH t AS (SELECT DISTINCT line_id, regexp_replace(line, '[\r\n]+$', '') x FROM blast_lines),
r AS (SELECT * FROM t WHERE regexp_matches(x, '[^ \t\n\x0B\f\r]') AND NOT starts_with(x, '#')),
s AS (SELECT line_id, regexp_full_match(chr(9) || x, '(?:\t(?: *"(?:[^"]|"")*" *|[^"\t]*))+', 's') good, regexp_extract_all(chr(9) || x, '\t( *"(?:[^"]|"")*" *|[^"\t]*)', 1) raw FROM r),
c AS (SELECT line_id, good, list_transform(raw, lambda v: trim(CASE WHEN contains(v, '"') THEN replace(substr(trim(v, ' '), 2, length(trim(v, ' ')) - 2), '""', '"') ELSE v END, ' ')) v FROM s),
n AS (SELECT '^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$' num),
j AS (SELECT line_id, v, good AND len(v) = 12 AND trim(v[1], E' \t\r') <> '' AND trim(v[2], E' \t\r') <> ''
  AND regexp_matches(v[3], num) AND coalesce(try_cast(v[3] AS DOUBLE) BETWEEN 0 AND 100, false)
  AND list_aggregate(list_transform(v[4:10], lambda z: regexp_matches(z, '^[0-9]+$')), 'bool_and') AND list_aggregate(list_transform(v[7:10], lambda z: regexp_matches(z, '[1-9]')), 'bool_and')
  AND (regexp_matches(v[11], num) OR regexp_matches(v[11], '^[eE][+-]?[0-9]+$')) AND NOT coalesce(try_cast(v[11] AS DOUBLE) < 0, false)
  AND regexp_matches(v[12], num) AND NOT coalesce(try_cast(v[12] AS DOUBLE) < 0, false) ok FROM c, n)
"""

def _reason(pos: int, name: str, kind: str, low: float | None, high: float | None) -> str:
    """The reason why a column breaks its rule, or null."""
    v, number = f"v[{pos + 1}]", "'^[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?$'"
    shape = {
        "id": f"trim({v}, E' \\t\\r') = '' THEN 'empty id'",
        "digits": f"NOT regexp_matches({v}, '^[0-9]+$') THEN 'not digits'",
        "number": f"NOT regexp_matches({v}, {number}) THEN 'not a number'",
        "evalue": f"NOT (regexp_matches({v}, {number}) OR regexp_matches({v}, '^[eE][+-]?[0-9]+$')) THEN 'not a number'",
    }[kind]
    bounds = (f" WHEN try_cast({v} AS DOUBLE) < {low} THEN 'too small'" if low is not None else "") + (f" WHEN try_cast({v} AS DOUBLE) > {high} THEN 'too large'" if high is not None else "")
    return f"'{name}: ' || CASE WHEN {shape}{bounds} END"


_COUNTS = ("length", "mismatch", "gapopen", "q_start", "q_end", "s_start", "s_end")

_SPANS = f"""
WITH u AS (SELECT {_bare("query_id")} query_id, {_bare("subject_id")} subject_id, unnest(spans) s FROM subject_accumulators),
s AS (SELECT query_id, subject_id, least(s.span_start, s.span_end)::BIGINT a, greatest(s.span_start, s.span_end)::BIGINT b FROM u
  WHERE s.span_start IS NOT NULL AND s.span_end IS NOT NULL AND query_id IS NOT NULL AND subject_id IS NOT NULL),
w AS (SELECT *, max(b) OVER (PARTITION BY query_id, subject_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) p FROM s)
"""

SQL = {
    "p1_found": _ORPHANS + "SELECT rid record_id, f ref_field FROM judged WHERE tab = 'similarities' AND n = 0",
    "p1_report": _ORPHANS
    + """SELECT tab table_name, f ref_field, strftime(loaded_at, '%Y-%m') "month", count(*) FILTER (WHERE n = 0) direct_orphans, count(*) FILTER (WHERE n > 0) inherited_orphans
FROM judged WHERE alive = 0 GROUP BY ALL
UNION ALL SELECT 'genes', 'taxon', strftime(loaded_at, '%Y-%m'), count(*), 0 FROM p WHERE dead GROUP BY ALL""",
    "p2_found": _RECORDS
    + """SELECT 'query_id' key_field, q key_value FROM r WHERE q IS NOT NULL GROUP BY q HAVING count(*) >= 0.01 * (SELECT count(*) FROM r)
UNION ALL SELECT 'query_taxon', qt FROM r WHERE qt IS NOT NULL GROUP BY qt HAVING count(*) >= 0.1 * (SELECT count(*) FROM r)""",
    "p2_results": _RECORDS
    + """, o AS (SELECT *, CASE WHEN lag(record_id) OVER w IS NOT NULL AND lag(st) OVER w IS NOT DISTINCT FROM st THEN 0 ELSE 1 END c FROM r WHERE q IS NOT NULL WINDOW w AS (PARTITION BY q ORDER BY record_id)),
i AS (SELECT *, sum(c) OVER (PARTITION BY q ORDER BY record_id) i FROM o), l AS (SELECT q, i, count(*) n FROM i GROUP BY ALL), x AS (SELECT q, max(n) longest FROM l GROUP BY q),
b AS (SELECT q, CASE WHEN m = 0 THEN -2147483648 ELSE e END e, m, row_number() OVER (PARTITION BY q ORDER BY CASE WHEN m = 0 THEN -2147483648 ELSE e END, m) k FROM r WHERE m IS NOT NULL AND e IS NOT NULL)
SELECT r.q query_id, count(*) n_records, min(record_id) first_record, max(record_id) last_record, any_value(b.e)::INT best_exp, any_value(b.m) best_mant, any_value(longest) longest_streak
FROM r JOIN x ON x.q = r.q LEFT JOIN b ON b.q = r.q AND b.k = 1 GROUP BY r.q""",
    "p4_found": _CELLS + "SELECT line_id FROM j WHERE NOT ok",
    "p4_rejects": _CELLS
    + """, w AS (SELECT line_id, CASE WHEN NOT good THEN 'stray quote' WHEN len(v) < 12 THEN 'too few fields' WHEN len(v) > 12 THEN 'too many fields' ELSE array_to_string(list_sort(list_filter(["""
    + ", ".join(_reason(*rule) for rule in parsing.RULES)
    + """], lambda x: x IS NOT NULL)), '; ') END reasons FROM c) SELECT line_id, reasons FROM w WHERE reasons <> ''""",
    "p4_hits": _CELLS
    + r"""SELECT line_id, trim(v[1], E' \t\r') query_id, trim(v[2], E' \t\r') subject_id, v[3]::DOUBLE percent_identity, """
    + ", ".join(f"try_cast(v[{i}] AS BIGINT) {n}" for i, n in enumerate(_COUNTS, 4))
    + r""", (CASE WHEN regexp_matches(v[11], '^[eE]') THEN '1' || v[11] ELSE v[11] END)::DOUBLE evalue, v[12]::DOUBLE bits, concat_ws('; ', """
    + ", ".join(f"CASE WHEN try_cast(v[{i}] AS BIGINT) IS NULL THEN '{n}=' || v[{i}] END" for i, n in enumerate(_COUNTS, 4))
    + ") beyond FROM j WHERE ok",
    "p5_found": _SPANS + "SELECT DISTINCT query_id, subject_id, p + 1 gap_start, a - 1 gap_end FROM w WHERE a > p + 1",
    "p5_periods": _SPANS
    + """, g AS (SELECT *, sum(CASE WHEN p IS NULL OR a > p + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY query_id, subject_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) i FROM w)
SELECT query_id, subject_id, min(a) period_start, max(b) period_end FROM g GROUP BY query_id, subject_id, i""",
}
