"""DataFrame operators: schema-adaptive projection, merging, lookups, series, keys, warehouse loads."""
