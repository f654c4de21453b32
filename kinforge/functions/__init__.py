"""Column expressions: normalization, tokens, blocking keys, character classes."""
