"""Table catalogue (schemas, keys, references) and parquet readers."""
