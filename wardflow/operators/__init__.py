"""DataFrame operators: validation, lookups, dedup, merge, history, masking, audits."""
