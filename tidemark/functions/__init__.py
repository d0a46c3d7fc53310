"""Column expressions: text cleansing, typing, keys and hashes."""
