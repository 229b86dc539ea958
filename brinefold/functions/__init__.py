"""Encodings: canonical JSON, nanosecond timestamps and wide decimals."""
