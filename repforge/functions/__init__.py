"""Column expressions built only from Spark built-ins (stay in codegen)."""
