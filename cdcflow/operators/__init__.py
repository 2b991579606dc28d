"""DataFrame operators: envelope, mapping, rejects, keys, lookups, address match."""
