"""Writers: Parquet history, CSV feeds, element documents, numbered batches, logs."""
