"""DataFrame operators: surrogate keys, lookups and size-checked broadcasts,
the ordered rule gate, the rejection audit, upserts and constraint checks."""
