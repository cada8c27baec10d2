"""Landing (bronze) sources and sinks: delimited text, JSON, Parquet by day."""
