"""Incremental ingest as a stream of landed files."""

from slotledger.streaming.ingest import ingest_stream

__all__ = ["ingest_stream"]
