"""Operators of a training-data pipeline: cleaning, deduplication, mixing, packing, archives, search.

Nothing else in the library imports this subpackage. Each module holds one operator with its own
general interface; ``registry`` derives the registered ``opN_*`` queries from them.
"""
