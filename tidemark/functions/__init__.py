"""Column-level building blocks: hashes, clocks, type conformance."""
