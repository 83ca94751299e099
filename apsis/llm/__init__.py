"""Training-data operators: filtering, deduplication, tokenisation, search and sharding of a text corpus.

Nothing outside this subpackage imports it.
"""
