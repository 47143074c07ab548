"""Sinks: text lines (the only output form of the original jobs)."""

from .text import write_lines  # noqa: F401
