"""Jobs: whole loads, incremental loads, reports."""
