"""voltmart: Spark-native analytics for half-hourly electricity-market data.

Layers:
  sources/    raw scans (CSV with header drift, weather JSON, seeds, test adapters)
  functions/  Column -> Column helpers (units, flags, calendar, lenient parsing)
  operators/  DataFrame -> DataFrame building blocks (dedup, upsert, unpivot,
              shares, conditional / ordered-set aggregates, windows, checks)
  plans/      the model DAG (staging -> intermediate -> marts) and driver queries
  sinks/      table writes (append, overwrite, versioned upsert, CSV export)
  streaming/  incremental file ingest with Structured Streaming
"""

__version__ = "0.1.0"
