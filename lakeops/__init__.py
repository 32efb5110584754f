"""lakeops: Spark-native marketing lakehouse operators.

Subpackages:

* ``functions``  column helpers (surrogate keys, NULL-safe ratios, day counts), as Columns or SQL text
* ``operators``  DataFrame operators (dedup, joins, counts, top-k, contracts, quality checks)
* ``sources``    file and JDBC sources, the table catalog (``Lake``), raw-table loaders
* ``plans``      the Silver and Gold models, the context document, declared quality rules,
                 the full pipeline run and the registered queries
* ``streaming``  new-file ingest with Structured Streaming

Every function takes and returns lazy DataFrames; nothing reads the clock or
the environment inside a model.
"""

__version__ = "0.1.0"
