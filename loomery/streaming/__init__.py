"""Streams over the append-only relations."""
