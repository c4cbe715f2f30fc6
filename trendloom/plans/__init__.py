"""The jobs bound to a set of Parquet tables, each with an equal SQL text."""
