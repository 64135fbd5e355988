"""Training-data operators: dedup, packing, token output, filters, archives, extraction.

Nothing outside this subpackage imports it.
"""
