"""airstrata: air-quality analytics as Spark jobs, from landed JSON files to city rollups."""
