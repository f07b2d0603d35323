"""Change-driven processing: fingerprint refresh (in-place rewrites) and
Structured Streaming ingest (new files)."""

from .ingest import read_ingested, start_ingest, stop_ingest
from .refresh import (
    ChangeListener,
    SourceState,
    fingerprint,
    listen,
    read_state,
    refresh_if_changed,
    source_fingerprint,
    write_state,
)

__all__ = [
    "ChangeListener",
    "SourceState",
    "fingerprint",
    "listen",
    "read_ingested",
    "read_state",
    "refresh_if_changed",
    "source_fingerprint",
    "start_ingest",
    "stop_ingest",
    "write_state",
]
