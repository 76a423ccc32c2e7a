"""From alignment hits to one similarity record per query and subject.

Hits of a pair are collapsed in two aggregations of one pass: the first e-value in line order,
the length-weighted identity, and the residues of the shorter protein covered by any hit.
Spans of accumulators, which have no length to bound them, go through the interval operator.

Defined results: hits without ids are ignored; a pair with one hit is a record; equal
lengths count on the subject; hits whose gene has no length are dropped, or raise with
``strict``; columns besides the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.evalue import repair_zero_exponents, round_tenth, split_evalue
from kinweave.operators.chunked import chunked
from kinweave.operators.intervals import gaps

_PAIR = ["query_id", "subject_id"]


def with_genes(hits: DataFrame, genes: DataFrame, strict: bool = False) -> DataFrame:
    """``hits`` with query_taxon, query_length, subject_taxon and subject_length.

    genes: gene_id (unique), taxon, length. With ``strict`` an unknown gene is an error."""
    def look_up(df: DataFrame, side: str) -> DataFrame:
        own = genes.select(F.col("gene_id").alias(f"{side}_id"), F.col("taxon").alias(f"{side}_taxon"), F.col("length").alias(f"{side}_length"))
        return df.join(own, f"{side}_id", "left" if strict else "inner")

    joined = look_up(look_up(hits, "query"), "subject")
    if strict:  # no other filter here: it would drop the rows before they are judged
        known = F.col("query_length").isNotNull() & F.col("subject_length").isNotNull()
        return joined.where(F.assert_true(known, F.lit("a hit names an unknown gene")).isNull())
    return joined.where("query_length IS NOT NULL AND subject_length IS NOT NULL")


def unique_genes(genes: DataFrame, gene_id, taxon) -> DataFrame:
    """One row per id, of the latest registration that has a length."""
    latest = F.max_by(F.struct(taxon.alias("taxon"), "length"), F.struct("loaded_at", "length"))
    rows = genes.where(gene_id.isNotNull() & F.col("length").isNotNull()).groupBy(gene_id.alias("gene_id")).agg(latest.alias("g"))
    return rows.select("gene_id", "g.taxon", "g.length")


def uncovered(spans: DataFrame, start, end) -> DataFrame:
    """(query_id, subject_id, missing): residues between the outermost spans of a pair in none."""
    found = gaps(spans, {k: F.col(k) for k in _PAIR}, start, end)
    return found.groupBy(*_PAIR).agg(F.sum(F.col("gap_end") - F.col("gap_start") + 1).alias("missing"))


def extent(start, end) -> tuple:
    """Aggregates for the outermost residues of spans with both bounds."""
    whole = start.isNotNull() & end.isNotNull()
    return F.min(F.when(whole, F.least(start, end))).alias("first_residue"), F.max(F.when(whole, F.greatest(start, end))).alias("last_residue")


def _shaped(pairs: DataFrame, residues: Column) -> DataFrame:
    shorter = F.least("query_length", "subject_length")
    return pairs.select(
        *_PAIR, "query_taxon", "subject_taxon", "evalue_mant", "evalue_exp",
        round_tenth(F.col("identities") / F.col("total_length")).alias("percent_identity"),
        round_tenth(100 * F.coalesce(residues, F.lit(0)) / shorter).alias("percent_match"),
    )


def _finish(pairs: DataFrame, missing: DataFrame) -> DataFrame:
    return _shaped(pairs.join(missing, _PAIR, "left"), F.col("last_residue") - F.col("first_residue") + 1 - F.coalesce("missing", F.lit(0)))


def covered(spans: Column) -> Column:
    """Residues in any of the (lo, hi) spans of an array that is sorted by lo."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-(2**62)).alias("end"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["hi"] - F.greatest(s["lo"] - 1, acc["end"])
        return F.struct((acc["n"] + F.greatest(fresh, F.lit(0))).alias("n"), F.greatest(acc["end"], s["hi"]).alias("end"))

    return F.aggregate(spans, start, step, lambda acc: acc["n"])


def collapse(hits: DataFrame, order: str = "line_id") -> DataFrame:
    """Similarity records of ``hits`` that carry evalue_mant, evalue_exp, genes and coordinates.

    The e-value is that of the first hit by ``order``, of equal ones the smallest. Hits are read
    once: first one row per pair and first residue is left, with the farthest last one, so that
    a pair has at most as many rows as its shorter protein has residues, however many hits."""
    on_query = F.col("query_length") < F.col("subject_length")
    a, b = F.when(on_query, F.col("q_start")).otherwise(F.col("s_start")), F.when(on_query, F.col("q_end")).otherwise(F.col("s_end"))
    whole = a.isNotNull() & b.isNotNull()
    kept = ("query_taxon", "subject_taxon", "query_length", "subject_length")
    starts = hits.groupBy(*_PAIR, F.when(whole, F.least(a, b).cast("bigint")).alias("_lo")).agg(
        F.max(F.when(whole, F.greatest(a, b).cast("bigint"))).alias("_hi"), F.min(F.struct(order, "evalue_exp", "evalue_mant")).alias("_first"),
        F.sum(F.col("percent_identity") * F.col("length")).alias("identities"), F.sum("length").alias("total_length"), *[F.max(c).alias(c) for c in kept],
    )
    span = F.when(F.col("_lo").isNotNull(), F.struct(F.col("_lo").alias("lo"), F.col("_hi").alias("hi")))
    pairs = starts.groupBy(*_PAIR).agg(
        F.min("_first").alias("_first"), F.sum("identities").alias("identities"), F.sum("total_length").alias("total_length"),
        F.array_sort(F.collect_list(span)).alias("_spans"), *[F.max(c).alias(c) for c in kept],
    )
    return _shaped(pairs.select("*", "_first.evalue_exp", "_first.evalue_mant"), covered(F.col("_spans")))


def to_similarities(hits: DataFrame, genes: DataFrame, strict: bool = False) -> DataFrame:
    """Parsed 12-column hits and genes to similarity records with repaired zero exponents."""
    mant, exp = split_evalue(F.col("evalue"))
    known = with_genes(hits, genes, strict).withColumn("evalue_mant", mant).withColumn("evalue_exp", exp)
    return repair_zero_exponents(collapse(known))


def finish_accumulators(parts: DataFrame, taxon_of) -> DataFrame:
    """Partial results of several runs per pair, put together; copies of a row count once.

    parts: acc_id, query_id, subject_id, run_no, query_length, subject_length, evalue_mant,
    evalue_exp, total_identities, total_length, spans. The e-value is that of the first run
    that has one. Pairs without aligned length are dropped."""
    rows = parts.select("acc_id", *_PAIR, "run_no", "query_length", "subject_length", "evalue_mant", "evalue_exp", "total_identities", "total_length").distinct()
    has = F.when(F.col("evalue_mant").isNotNull() & F.col("evalue_exp").isNotNull(), F.struct("run_no", "acc_id"))
    pairs = (
        rows.where("query_id IS NOT NULL AND subject_id IS NOT NULL")
        .groupBy(*_PAIR)
        .agg(
            F.min_by("evalue_mant", has).alias("evalue_mant"), F.min_by("evalue_exp", has).alias("evalue_exp"),
            F.sum("total_identities").alias("identities"), F.sum("total_length").alias("total_length"), F.max("query_length").alias("query_length"), F.max("subject_length").alias("subject_length"),
        )
        .where("total_length > 0")
        .withColumn("query_taxon", taxon_of(F.col("query_id")))
        .withColumn("subject_taxon", taxon_of(F.col("subject_id")))
    )
    spans = parts.select(*_PAIR, F.explode("spans").alias("span"))
    start, end = F.col("span.span_start"), F.col("span.span_end")
    extents = spans.groupBy(*_PAIR).agg(*extent(start, end))
    return _finish(pairs.join(extents, _PAIR, "left"), uncovered(spans, start, end))


def runs(hits: DataFrame, order: str = "line_id", within: str = "file_name", chunk_rows: int | None = None) -> DataFrame:
    """``hits`` with ``run``: hits of a pair that stand together in a file; a later return of the
    pair is a new run. For input whose separate runs are to stay separate records.

    A file may hold most of the rows: it is numbered in equal chunks, of which the first and last
    pair and the number of changes are merged in order. ``order`` identifies a row; hits without a
    file have no run and are left out."""
    kept = [c for c in hits.columns if c != order]
    rows = chunked(hits.select(F.col(order).alias("_row"), *kept), within, chunk_rows)
    pair = F.struct(*_PAIR)
    along = Window.partitionBy(within, "_chunk").orderBy("_row")
    changed = F.coalesce((~F.lag(pair).over(along).eqNullSafe(pair) & F.lag(F.lit(1)).over(along).isNotNull()).cast("int"), F.lit(0))
    rows = rows.withColumn("_changed", changed)
    states = rows.groupBy(within, "_chunk").agg(F.min_by(pair, "_row").alias("_head"), F.max_by(pair, "_row").alias("_tail"), F.sum("_changed").alias("_inside"))
    chunks = Window.partitionBy(within).orderBy("_chunk")
    opens = (F.lag("_chunk").over(chunks).isNull() | ~F.lag("_tail").over(chunks).eqNullSafe(F.col("_head"))).cast("int")
    begun = F.sum(F.col("_opens") + F.col("_inside")).over(chunks) - F.col("_inside")
    offsets = states.withColumn("_opens", opens).select(within, "_chunk", begun.alias("_offset"))
    run = F.sum("_changed").over(along.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_offset")
    return rows.join(offsets, [within, "_chunk"]).select(F.col("_row").alias(order), *kept, run.alias("run"))
