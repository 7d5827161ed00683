"""Operators that prepare training text: deduplication, filtering, mixing, packing."""
