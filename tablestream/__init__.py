"""Event tables on Spark: lenient ingest, event-time windows, allowed lateness,
keyed tables with versions and branches, compaction and data-quality checks.

Every transform is a plain ``DataFrame -> DataFrame`` function, so the same code
serves batch reads and Structured Streaming micro-batches.
"""
