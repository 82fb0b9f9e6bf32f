"""Sources: message text, file listings, the trade Parquet reader, Kafka adapters."""
