"""Sources: files, batches, tables and queries as DataFrames."""
