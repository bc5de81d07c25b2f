"""Column-to-column functions built from Spark SQL expressions."""
