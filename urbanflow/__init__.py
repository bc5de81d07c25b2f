"""urbanflow: tabular mobility analytics expressed as Spark DataFrame jobs."""
