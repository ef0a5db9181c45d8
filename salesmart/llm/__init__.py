"""Operators for preparing training text: duplicates, packing, scoring, search, files."""
