"""Typed relations between genes: orthologs, in-paralogs, co-orthologs, reciprocal best hits.

Input is one similarity record per query and subject (see ``last_records``). Best hits are
group minima that are joined back, with hot queries salted; they are taken over all records,
before any threshold, except for the strict reciprocal pairs. Reciprocal joins use both ids
as their key and so meet no hot key. Thresholds and ties are as documented per function.

Defined results: records with a null id, taxon, e-value or percent match must be dropped
before (``last_records`` does); an empty input gives empty results; a mean score of zero gives
a null normalised score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.config import PairConfig
from kinweave.functions.evalue import pair_score, passes
from kinweave.operators.skew import salted_join
from kinweave.session import checkpointed

#: Pairs of which the hashes are broadcast, to leave out other records before these are shuffled.
FEW = 1_000_000
#: Mantissas below these count as zero: for best hits and scores, for in-paralogs, for co-orthologs.
BEST_ZERO, KEEP_ZERO, CO_ZERO = 0.01, 0.001, 0.00001


def last_records(records: DataFrame, order: list[str]) -> DataFrame:
    """One record per (query_id, subject_id), the last in ``order``; incomplete ones are dropped."""
    rest = [c for c in ("query_taxon", "subject_taxon", "evalue_mant", "evalue_exp", "percent_identity", "percent_match") if c in records.columns]
    whole = records.dropna(subset=["query_id", "subject_id", *[c for c in rest if c != "percent_identity"]])
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("r")
    return whole.groupBy("query_id", "subject_id").agg(last).select("query_id", "subject_id", "r.*")


def accepted(cfg: PairConfig) -> Column:
    """Whether a record passes the thresholds."""
    if cfg.legacy:
        return (F.col("percent_match") >= cfg.percent_match) & (F.col("evalue_exp") <= cfg.evalue.exp)
    return (F.col("percent_match") >= cfg.percent_match) & passes(F.col("evalue_mant"), F.col("evalue_exp"), cfg.evalue)


def _evalue() -> Column:
    return F.struct(F.col("evalue_exp").alias("exp"), F.col("evalue_mant").alias("mant"))


def best_per_taxon(sim: DataFrame) -> DataFrame:
    """(query_id, subject_taxon, best): smallest e-value to each other taxon."""
    return sim.where("query_taxon <> subject_taxon").groupBy("query_id", "subject_taxon").agg(F.min(_evalue()).alias("best"))


def best_other_taxon(sim: DataFrame) -> DataFrame:
    """(query_id, best): smallest e-value to any other taxon."""
    return sim.where("query_taxon <> subject_taxon").groupBy("query_id").agg(F.min(_evalue()).alias("best"))


def best_hits(sim: DataFrame, cfg: PairConfig) -> DataFrame:
    """Records to other taxa that pass the thresholds and are the best or have e-value zero."""
    candidates = salted_join(sim.where((F.col("query_taxon") != F.col("subject_taxon")) & accepted(cfg)), best_per_taxon(sim), ["query_id", "subject_taxon"])
    return candidates.where((F.col("evalue_mant") < BEST_ZERO) | (_evalue() == F.col("best"))).drop("best")


def paralog_hits(sim: DataFrame, cfg: PairConfig) -> DataFrame:
    """Records within a taxon that pass and are no worse than the query's best to any other."""
    own = sim.where((F.col("query_taxon") == F.col("subject_taxon")) & (F.col("query_id") != F.col("subject_id")) & accepted(cfg))
    judged = salted_join(own, best_other_taxon(sim), ["query_id"], "left")
    return judged.where(F.col("best").isNull() | (F.col("evalue_mant") < KEEP_ZERO) | (_evalue() <= F.col("best"))).drop("best")


def _reciprocal(hits: DataFrame, zero: float) -> DataFrame:
    """(seq_a, seq_b, taxon_a, taxon_b, unnormalized_score) of pairs with a record each way.

    Both directions meet in one aggregation, so that ``hits`` are made and shuffled once, where a
    self-join would do so twice. The edges, few beside the records, are written once as their
    means are joined back."""
    forward = F.col("query_id") < F.col("subject_id")
    side = F.struct(F.col("evalue_mant").alias("m"), F.col("evalue_exp").alias("e"), F.col("query_taxon").alias("q"), F.col("subject_taxon").alias("s"))
    ends = [F.least("query_id", "subject_id").alias("seq_a"), F.greatest("query_id", "subject_id").alias("seq_b")]
    both = hits.where(F.col("query_id") != F.col("subject_id")).groupBy(*ends).agg(F.max(F.when(forward, side)).alias("l"), F.max(F.when(~forward, side)).alias("r"))
    score = pair_score(F.col("l.m"), F.col("l.e"), F.col("r.m"), F.col("r.e"), zero)
    edges = both.where("l IS NOT NULL AND r IS NOT NULL")
    return checkpointed(edges.select("seq_a", "seq_b", F.col("l.q").alias("taxon_a"), F.col("l.s").alias("taxon_b"), score.alias("unnormalized_score")))


def by_taxon_pair(edges: DataFrame, kind: str) -> DataFrame:
    """Scores divided by the mean over all edges between the same two taxa, in either order."""
    pair = [F.least("taxon_a", "taxon_b").alias("_t1"), F.greatest("taxon_a", "taxon_b").alias("_t2")]
    keyed = edges.select("*", *pair)
    means = keyed.groupBy("_t1", "_t2").agg(F.avg("unnormalized_score").alias("_mean"))  # at most a row per two taxa
    return _scored(salted_join(keyed, means, ["_t1", "_t2"]), kind)


def _scored(edges: DataFrame, kind: str) -> DataFrame:
    score = F.col("unnormalized_score") / F.nullif(F.col("_mean"), F.lit(0.0))
    return edges.select("seq_a", "seq_b", "taxon_a", "taxon_b", "unnormalized_score", score.alias("normalized_score"), F.lit(kind).alias("edge_type"))


def orthologs(sim: DataFrame, cfg: PairConfig) -> DataFrame:
    """Pairs of different taxa that are best hits of each other."""
    return by_taxon_pair(_reciprocal(best_hits(sim, cfg), BEST_ZERO), "ortholog")


def inparalogs(sim: DataFrame, cfg: PairConfig, ortho: DataFrame) -> DataFrame:
    """Pairs of one taxon closer to each other than to other taxa. Scores are divided by the mean
    of the taxon's pairs that touch an ortholog, or of all its pairs where none does."""
    raw = _reciprocal(paralog_hits(sim, cfg), BEST_ZERO)
    ids = ortho.select(F.explode(F.array("seq_a", "seq_b")).alias("id")).distinct().withColumn("touches", F.lit(True))
    flagged = raw.join(ids.withColumnRenamed("id", "seq_a").withColumnRenamed("touches", "_a"), "seq_a", "left")
    flagged = flagged.join(ids.withColumnRenamed("id", "seq_b").withColumnRenamed("touches", "_b"), "seq_b", "left")
    touching = F.coalesce("_a", "_b", F.lit(False))
    mean = F.coalesce(F.avg(F.when(touching, F.col("unnormalized_score"))), F.avg("unnormalized_score"))
    means = flagged.groupBy("taxon_a").agg(mean.alias("_mean"))  # a row per taxon
    return _scored(salted_join(flagged, means, ["taxon_a"]), "inparalog")


def both_ways(edges: DataFrame) -> DataFrame:
    """(x, y): every edge in either direction."""
    return edges.select(F.explode(F.array(F.struct(F.col("seq_a").alias("x"), F.col("seq_b").alias("y")), F.struct(F.col("seq_b").alias("x"), F.col("seq_a").alias("y")))).alias("p")).select("p.x", "p.y")


def coorthologs(sim: DataFrame, cfg: PairConfig, ortho: DataFrame, para: DataFrame) -> DataFrame:
    """Pairs joined through an ortholog and in-paralogs at one or both ends, with accepted
    records both ways, that are no orthologs themselves."""
    ip, orth = both_ways(para), both_ways(ortho)
    reach = ip.join(orth.select(F.col("x").alias("y"), F.col("y").alias("z")), "y").select("x", "z").distinct()
    further = reach.join(ip.select(F.col("x").alias("z"), F.col("y").alias("w")), "z").select("x", F.col("w").alias("z"))
    ends = reach.unionByName(further).where("x <> z")
    pairs = ends.select(F.least("x", "z").alias("seq_a"), F.greatest("x", "z").alias("seq_b")).distinct()
    pairs = checkpointed(pairs.join(ortho.select("seq_a", "seq_b"), ["seq_a", "seq_b"], "left_anti"))
    either = F.least("query_id", "subject_id").alias("seq_a"), F.greatest("query_id", "subject_id").alias("seq_b")
    records, code = sim.where(accepted(cfg)).select("*", *either), F.xxhash64("seq_a", "seq_b").alias("_code")
    if pairs.count() <= FEW:
        records = records.withColumn("_code", code).join(F.broadcast(pairs.select(code)), "_code", "left_semi").drop("_code")
    records = records.join(pairs, ["seq_a", "seq_b"], "left_semi")
    return by_taxon_pair(_reciprocal(records, CO_ZERO), "coortholog")


def edge_union(*edges: DataFrame) -> DataFrame:
    """All edges of the given classes; a pair may occur in several classes."""
    out = edges[0]
    for more in edges[1:]:
        out = out.unionByName(more)
    return out


def raw_dedupe(rows: DataFrame, keys: list[str], score: str, tolerance: float = 1e-9) -> DataFrame:
    """One row per key; an error where scores of a key differ by more than ``tolerance``."""
    merged = rows.groupBy(*keys).agg(F.min(score).alias(score), F.max(score).alias("_most"))
    same = F.assert_true(F.col("_most") - F.col(score) <= tolerance, F.lit("scores of one pair differ")).isNull()
    return merged.where(same).drop("_most")


def strict_reciprocal(sim: DataFrame, cfg: PairConfig) -> DataFrame:
    """(seq_a, seq_b): each the only best accepted hit of the other in its taxon."""
    own = sim.where((F.col("query_taxon") != F.col("subject_taxon")) & accepted(cfg))
    best = own.groupBy("query_id", "subject_taxon").agg(F.min(_evalue()).alias("best"))
    tied = salted_join(own, best, ["query_id", "subject_taxon"]).where(_evalue() == F.col("best"))
    only = tied.groupBy("query_id", "subject_taxon").agg(F.min("subject_id").alias("s"), F.max("subject_id").alias("_last")).where("s = _last").select(F.col("query_id").alias("q"), "s")
    mutual = only.where("q < s").join(only.select(F.col("s").alias("q"), F.col("q").alias("s")).where("q < s"), ["q", "s"])
    return mutual.select(F.col("q").alias("seq_a"), F.col("s").alias("seq_b"))


def global_reciprocal(hits: DataFrame) -> DataFrame:
    """(seq_a, seq_b): each the best hit of the other by e-value, then bits, then subject id.

    Self hits are not excluded: a gene that is its own best hit is a pair with itself."""
    best = hits.groupBy("query_id").agg(F.min(F.struct("evalue", (-F.col("bits")).alias("b"), "subject_id")).alias("m")).select(F.col("query_id").alias("q"), F.col("m.subject_id").alias("s"))
    mutual = best.join(best.select(F.col("s").alias("q"), F.col("q").alias("s")), ["q", "s"])
    return mutual.select(F.least("q", "s").alias("seq_a"), F.greatest("q", "s").alias("seq_b")).distinct()


def relations(sim: DataFrame, cfg: PairConfig) -> dict[str, DataFrame]:
    """The three classes of edges of one similarity table; the table and the two first results are used
    often, so the caller may want to persist ``sim``. A column ``leading`` tells records apart that orthologs and
    in-paralogs depend on; the others only have to be there for the further relations."""
    first = sim.where("leading") if "leading" in sim.columns else sim
    ortho = orthologs(first, cfg)
    para = inparalogs(first, cfg, ortho)
    return {"orthologs": ortho, "inparalogs": para, "coorthologs": coorthologs(sim, cfg, ortho, para)}


def build(sim: DataFrame, cfg: PairConfig) -> dict[str, DataFrame]:
    """All relations: the edges and the strict reciprocal pairs."""
    return {**relations(sim, cfg), "reciprocal": strict_reciprocal(sim, cfg)}
