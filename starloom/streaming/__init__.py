"""Incremental landing of raw sales into bronze with Structured Streaming.

The reference appends each arriving batch to bronze; here a file-source
stream with a checkpoint does that exactly once per file.  Nothing else in
the warehouse is streaming (each later layer is rebuilt or merged as a
batch over whole tables)."""

from starloom.streaming.ingest import ingest_sales_files, source_schema  # noqa: F401
