"""Batch operators: text statistics, keyed/global statistics, layout."""
