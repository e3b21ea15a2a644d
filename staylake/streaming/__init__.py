"""Structured Streaming: incremental file loads merged insert-only."""

from .incremental import incremental_merge, incremental_star  # noqa: F401
