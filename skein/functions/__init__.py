"""Column expressions: clocks, tokens, JSON, hashes."""
