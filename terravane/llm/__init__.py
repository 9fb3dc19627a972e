"""Training-data operators: packing, search, classifiers, deduplication, token work and media columns.

Nothing outside this subpackage imports it; ``queries.py`` holds the thin registered queries.
"""
