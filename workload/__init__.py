"""The registered queries: inputs derived from the test tables, queries, SQL oracles."""
