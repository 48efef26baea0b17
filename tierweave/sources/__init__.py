"""Reading, incremental windows, lookups, and the layered table store."""
