"""Column functions: small expressions that stay inside Spark's generated code."""
