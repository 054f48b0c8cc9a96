"""Incremental shredding with Structured Streaming."""

from docshred.streaming.incremental import compact, shred_batch, start, stream_documents

__all__ = ["compact", "shred_batch", "start", "stream_documents"]
