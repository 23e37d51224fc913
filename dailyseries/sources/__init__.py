"""Scans and sinks: parquet tables, CSV folders, split folders, daily
payload documents, and the write/read round trips of scores and reports."""
