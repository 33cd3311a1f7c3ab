"""Column-expression building blocks (all JVM-side, codegen-friendly)."""

from spindle.functions.parse import parse_long_fields, parse_status_code, strict_long
from spindle.functions.tokens import clean_tokens, space_tokens, text_lines

__all__ = ["clean_tokens", "space_tokens", "text_lines",
           "parse_long_fields", "parse_status_code", "strict_long"]
