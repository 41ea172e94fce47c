"""Sources: parquet readers, the mapping of the driver tables onto the domain tables, and the
reshaping of extracted frames (wide -> long, documents -> rows)."""
