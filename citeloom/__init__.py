"""citeloom: a citation-graph and reference-data engine written for Spark."""
