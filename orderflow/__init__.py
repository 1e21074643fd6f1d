"""orderflow: ingest, validate, generate, convert and query food-ordering data on Spark."""
