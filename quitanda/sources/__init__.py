"""Raw tables: declared schemas, readers, and the raw views over the benchmark tables."""
