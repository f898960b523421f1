"""Training-data operators: tokenizing, PII surrogates, near-duplicates, mixing,
substring dedup, quality models, web archives, quality rules and search.

Nothing outside this subpackage imports it.
"""
