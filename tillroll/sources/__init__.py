"""Readers: folder listing, CSV scans, the load ledger and the cleansed table."""
