"""Operators for preparing training text: deduplication, search, tokenizing, filtering, mixing."""
