"""Schemas of the tables that the operators exchange, as DDL."""

HIT = "line_id bigint, query_id string, subject_id string, percent_identity double, length bigint, mismatch bigint, gapopen bigint, q_start bigint, q_end bigint, s_start bigint, s_end bigint, evalue double, bits double"
GENE = "gene_id string, taxon string, length int"
SIMILARITY = "query_id string, subject_id string, query_taxon string, subject_taxon string, evalue_mant double, evalue_exp int, percent_identity double, percent_match double"
EDGE = "seq_a string, seq_b string, taxon_a string, taxon_b string, unnormalized_score double, normalized_score double, edge_type string"
GRAPH = "src string, dst string, weight double"
CLUSTER = "cluster_id bigint, node string"
FASTA = "taxon string, ord bigint, header string, sequence string"
