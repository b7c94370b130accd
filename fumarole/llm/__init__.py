"""Operators on text corpora: dedup, filtering, mixing, tokens and chat formatting."""
