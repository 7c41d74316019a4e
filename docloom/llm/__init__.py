"""Training-data operators: packing, quality rules, deduplication, tokenisation, extraction, filters.

Nothing else in the library imports this subpackage.
"""
