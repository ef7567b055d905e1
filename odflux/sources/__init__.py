"""Scans and sinks: trip files, event streams, keyed Parquet tables, zone polygons."""
