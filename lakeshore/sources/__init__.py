"""Scans and sinks: test-table mapping, pipe-separated and landing files, bucketed tables, refreshes."""
