"""fundlens: fund-position analytics on Spark.

Every public function takes and returns DataFrames (lazy, no action) unless
its docstring says otherwise. Subpackages:

- ``sources``   readers and writers (JDBC, Parquet, CSV, insert-if-absent)
- ``functions`` column expressions (exact decimal ratios, text, dates)
- ``operators`` reusable relational building blocks (dedup, joins, ordered
                scans, quantiles, quality rules)
- ``plans``     the portfolio queries built from the above
- ``streaming`` the daily incremental load as a Structured Streaming job
"""

__version__ = "0.1.0"
