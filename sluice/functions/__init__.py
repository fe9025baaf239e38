"""Column expressions: format rules, flags, casts."""
