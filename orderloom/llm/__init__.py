"""Operators that prepare training text: filters, duplicates, tokens, files."""
