"""Training-data operators: dedup, filters, search, tokenisation, packing, sharding.

Nothing outside this package imports it; ``queries`` holds the registered queries.
"""
