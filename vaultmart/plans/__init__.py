"""Metadata (specs), year pipelines and the query catalogue."""
