"""Reading CSV as text, and writing and reading Parquet layers."""
