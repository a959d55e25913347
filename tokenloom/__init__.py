"""Language-corpus analytics as Spark jobs."""
