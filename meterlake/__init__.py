"""meterlake: usage, cost and tenancy analytics written as plain Spark DataFrame jobs.

Layout
------
sources/    reading tables, the replay-safe sync (full / incremental copy, sync log, compaction)
operators/  schema-aligned union, tenant scoping, pricing, lineage, attribution, key checks
functions/  small Column helpers and exact distributed ranks / quantiles
plans/      fixture roles, the query catalogue and the DuckDB oracle SQL
streaming/  the incremental copy as a Structured Streaming ``availableNow`` job
"""

__version__ = "0.1.0"
