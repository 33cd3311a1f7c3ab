"""Batch sinks (SNK-1); streaming sinks live in ``spindle.streaming.sinks``."""

from spindle.sinks.batch import read_pairs_text, save_pairs_text

__all__ = ["save_pairs_text", "read_pairs_text"]
