"""Operators for preparing training data: near duplicates, filters, mixing, search and packing."""
