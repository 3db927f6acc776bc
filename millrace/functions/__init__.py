"""Column expressions: safe casts, time arithmetic and masks."""
