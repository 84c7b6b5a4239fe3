"""Operators for preparing training data: mixing, filtering, de-duplication, search and packing."""
