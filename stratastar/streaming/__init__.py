"""Incremental landing of source versions."""

from stratastar.streaming.landing import append_available

__all__ = ["append_available"]
