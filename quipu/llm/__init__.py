"""Training-data operators: quality, toxicity, near-duplicates, tokens, packing,
record files, nearest neighbours, chat rendering and shard placement.

Nothing outside this subpackage imports it.
"""
