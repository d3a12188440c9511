"""vigil: transaction-risk analytics as Spark DataFrame, Spark ML and
Structured Streaming jobs.

Sub-packages:
  sources    canonical schemas, table readers, adapters, history sinks
  functions  reusable column expressions
  operators  the dataflow operators (features, splits, metrics, drift, ...)
  plans      composed flows and the query catalogue checked against DuckDB
  streaming  the stateful streaming twin of the feature operators
"""

__version__ = "0.1.0"
