"""Compositions of operators: one ingest run, one document-processing run."""
