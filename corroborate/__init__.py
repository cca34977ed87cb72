"""Evidence fusion as Spark jobs."""
