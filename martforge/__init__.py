"""martforge: a retail-warehouse pipeline and its analytics as Spark jobs.

Layers
------
sources    driver tables -> messy landing frames, CSV scan, calendar spine
functions  column expressions used by the cleaning and analytics jobs
operators  reusable DataFrame operators (global ranking, dedup, tree walk,
           data-quality checks, change capture)
plans      staging / star schema / marts / analytics jobs, publish, oracle SQL
streaming  Structured Streaming form of the order-status audit
"""

__version__ = "0.1.0"
