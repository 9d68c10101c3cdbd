"""Structured Streaming refresh."""

from .refresh import ingest, refresh_latest, upsert_latest

__all__ = ["ingest", "refresh_latest", "upsert_latest"]
