"""Sources and sinks: Parquet scans, rate documents, JDBC, versioned snapshots."""
