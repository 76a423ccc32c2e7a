"""The whole run: hits and genes to named groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.config import RunConfig
from kinweave.functions.evalue import edge_score
from kinweave.operators import clusters, flow, hsp, pairs
from kinweave.session import checkpointed, is_written


def run(hits: DataFrame, genes: DataFrame, cfg: RunConfig = RunConfig()) -> dict[str, DataFrame]:
    """Parsed hits and genes to similarities, relations, edges, clusters and groups."""
    return from_similarities(hsp.to_similarities(hits, genes), cfg)


def from_similarities(sim: DataFrame, cfg: RunConfig = RunConfig()) -> dict[str, DataFrame]:
    """The same from similarity records, one per pair. They are written once, being read often, if they are not yet."""
    sim = sim if is_written(sim) else checkpointed(sim)
    found = pairs.build(sim, cfg.pairs)
    edges = checkpointed(pairs.edge_union(found["orthologs"], found["inparalogs"], found["coorthologs"]))
    arcs = edges.select(F.col("seq_a").alias("src"), F.col("seq_b").alias("dst"), edge_score(F.col("normalized_score")).alias("weight"))
    grouped = flow.flow_clusters(arcs, cfg.flow)
    named = clusters.numbered(grouped, cfg.prefix, cfg.start)
    return {"similarities": sim, **found, "edges": edges, "clusters": grouped, "groups": named}
