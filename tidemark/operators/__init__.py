"""DataFrame operators: envelope, change data, quality, merge, lookups, audit."""
