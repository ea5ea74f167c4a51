"""Reusable DataFrame operators (bars, chunked lag, book, ingest, compaction)."""
