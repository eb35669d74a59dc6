"""Hospital operations analytics as Spark jobs."""
