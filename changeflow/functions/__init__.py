"""Column-level decoding functions. All are native expressions, no Python UDFs."""
