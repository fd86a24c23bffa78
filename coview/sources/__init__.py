"""Sources and sinks: text, CSV, JSON, Parquet, LibSVM and catalog tables."""
