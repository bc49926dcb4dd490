"""tessera — a Spark-native engine for property-transaction analytics.

Layers (each a set of ``DataFrame -> DataFrame`` functions):

* ``sources``   — typed scans and the adapter from the benchmark tables to the raw record
* ``functions`` — column expressions (rounding, title case, hash keys, bands, scores)
* ``operators`` — reusable relational building blocks (dedup, exact quantiles, checked
  broadcast joins, z-score anomalies, expectations, SCD2)
* ``plans``     — the business tables: ETL, star schema, marts, layered models,
  data-quality suite, dashboard datasets
* ``sinks``     — partitioned Parquet / CSV / JSON writers with read-back
* ``streaming`` — incremental ingest with Structured Streaming
"""

__all__ = ["session", "schema"]
