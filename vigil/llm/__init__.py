"""Operators for preparing training data: tokens, packing, search, duplicates, scoring."""
