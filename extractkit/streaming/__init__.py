"""Incremental copies driven by Structured Streaming."""

from .copies import stream_parts, stream_upsert

__all__ = ["stream_parts", "stream_upsert"]
