"""Operators that prepare training text: placement, search, filters, duplicates, tokens."""
