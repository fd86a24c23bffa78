"""coview: behaviour-log analytics as Spark DataFrame jobs.

Subpackages:
    sources    readers and writers (text, CSV, JSON, Parquet, LibSVM, tables)
    functions  column expressions (Java-compatible split, number text, math)
    operators  the jobs: behaviour counts, similarity, text, logs, graphs,
               gradient descent, evaluation, MLlib-backed learning
    plans      the registered queries over the driver's tables and their
               DuckDB oracle SQL
"""

__version__ = "0.1.0"
