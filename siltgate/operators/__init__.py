"""DataFrame operators: dedup, classification, lookups, checks, process folding."""
