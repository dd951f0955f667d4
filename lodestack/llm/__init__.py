"""Training-data operators: language ID, packing, dedup, media, HTML, tokens, quality, shards.

Nothing outside this subpackage imports it, so it can be removed as a whole.
"""
