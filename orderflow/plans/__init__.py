"""Whole jobs: ingest a file into a table, and convert a file to another format."""
