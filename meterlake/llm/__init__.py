"""Training-data operators: deduplication, filtering, tokenising, sharding and search.

Nothing outside this folder imports it; ``llm.catalog`` holds the queries and their SQL.
"""
