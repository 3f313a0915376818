"""Readers and writers: driver tables, stand-in client/request tables, CSV,
JSON events and the Parquet sinks."""
