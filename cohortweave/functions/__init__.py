"""Column expressions and shared scale primitives."""
