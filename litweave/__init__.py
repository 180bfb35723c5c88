"""Literature data processing on Spark: ingest, enrichment, matching, retrieval, graphs and staged dataflow."""
