"""Person and household record analytics as Spark jobs."""
