"""Customer analytics for an online shop as PySpark DataFrame jobs."""
