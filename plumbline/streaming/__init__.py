"""Incremental runs of the row-wise part of the pipeline."""
