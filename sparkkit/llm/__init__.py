"""Operators for preparing training data: archives, filters, near-duplicate detection, mixing and packing."""
