"""emporia: retail analytics and table sync as Spark DataFrame jobs.

Subpackages: ``sources`` (test-data adapters, versioned store, serving
reads), ``functions`` (column expressions, dense ids, two-level running
sums), ``operators`` (the operator groups A-J), ``plans`` (registered
queries with their oracle SQL) and ``streaming`` (Structured Streaming
forms).
"""

__version__ = "0.1.0"
