"""Column functions: text parsing, hash keys, bands."""
