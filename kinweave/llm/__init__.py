"""Operators for building training corpora: deduplication, filters, mixing, packing, archives."""
