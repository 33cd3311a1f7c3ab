"""Structured Streaming operators (STR-1..11) and per-batch sinks (SNK-2..8)."""
