"""Column -> Column functions; all native Spark expressions, no Python UDFs."""
