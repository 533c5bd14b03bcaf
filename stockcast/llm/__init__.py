"""Operators for preparing training text: archives, counts, filters, duplicates, mixing, sharding, packing, search."""
