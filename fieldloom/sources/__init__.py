"""Aliased and range-partitioned scans over Parquet and JDBC."""
