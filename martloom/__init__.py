"""martloom: layered commerce analytics as Spark jobs."""
