"""DataFrame-to-DataFrame operators: cleaning, histories, lookups, merges, rollups, quality rules."""
