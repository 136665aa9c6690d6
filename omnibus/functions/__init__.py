"""Column expressions, all built in: no Python runs per row."""
