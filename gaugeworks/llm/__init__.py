"""Operators for preparing training text: quality, duplicates, contamination, language, mixing, formats."""
