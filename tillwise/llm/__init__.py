"""Operators for preparing training text: search, filters, near copies, mixing, encoding, scoring."""
