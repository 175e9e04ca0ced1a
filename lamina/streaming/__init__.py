"""Structured Streaming jobs: incremental, exactly-once ingest of new facts."""

from lamina.streaming.ingest import IngestReport, InvalidFactsError, ingest, ingest_snapshot, snapshot_new

__all__ = ["IngestReport", "InvalidFactsError", "ingest", "ingest_snapshot", "snapshot_new"]
