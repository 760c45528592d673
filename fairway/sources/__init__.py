"""Sources and sinks: declared schemas, landed JSON ingest, Parquet/CSV I/O,
and a rounds-shaped view over the driver's tables."""
