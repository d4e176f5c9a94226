"""Structured Streaming variant of collecting."""

from .collect import collect_stream

__all__ = ["collect_stream"]
