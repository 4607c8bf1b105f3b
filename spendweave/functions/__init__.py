"""Column expressions: native Spark functions only, no UDFs."""
