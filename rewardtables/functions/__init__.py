"""Column functions: native Spark expressions, usable in batch and in streams."""
