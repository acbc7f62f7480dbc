"""Readers: tables, delimited files, inline rows, and extracts kept for reuse."""
