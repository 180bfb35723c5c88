"""All queries of the core and their SQL."""

from litweave.plans import format_queries, record_queries, reference_queries

FLAGSHIP = "best_protein_per_gene"
QUERIES = {**record_queries.QUERIES, **reference_queries.QUERIES, **format_queries.QUERIES}
ORACLE = {**record_queries.ORACLE, **reference_queries.ORACLE, **format_queries.ORACLE}
