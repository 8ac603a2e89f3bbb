"""Column expressions and UDF hooks."""
