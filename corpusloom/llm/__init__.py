"""Training-data operators: quality, deduplication, language, toxicity, search, mixing and sharding.

Nothing outside this subpackage imports it. Its queries are in ``llm.queries``.
"""
