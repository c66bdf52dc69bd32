"""Training-data operators: extraction, filtering, deduplication, search, tokenization, archives.

Nothing else in the library imports this subpackage.  Operators take and return DataFrames; the
``op*`` queries in ``queries.py`` derive the digest columns of each operator's contract.
"""
