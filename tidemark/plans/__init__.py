"""End-to-end use cases built from the operators."""
