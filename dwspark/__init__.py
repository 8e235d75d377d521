"""dwspark: analytical warehousing as Spark DataFrame jobs.

Layers (module boundaries, not catalogs):

* ``sources``   - readers for the given tables, CSV contracts, loads, watermarks
* ``functions`` - column expressions (cleaning, calendar, keys, safe ratios)
* ``operators`` - DataFrame-in / DataFrame-out building blocks (joins, windows,
                  aggregates, data-quality checks, SCD type 2, upserts)
* ``plans``     - the warehouse itself: staging, dimensions, facts, marts,
                  analytical queries and measures
* ``streaming`` - incremental upsert as a Structured Streaming job
"""

__version__ = "0.1.0"
