"""Column functions: little-endian integers, base58, prices, cleaning."""
