"""Batch and streaming sources (SRC-1..6)."""

from spindle.sources.files import document_lines, read_lines, read_stopwords, stopword_frame
from spindle.sources.memory import int_list, int_range, key_values
from spindle.sources.streams import socket_lines, stream_lines
from spindle.sources.tables import load_table

__all__ = [
    "document_lines", "read_lines", "read_stopwords", "stopword_frame",
    "int_list", "int_range", "key_values", "load_table", "stream_lines", "socket_lines",
]
