"""Column expressions: all built-in, so they stay inside Spark's generated code."""
