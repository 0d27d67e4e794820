"""Open-source activity analytics as Spark jobs: DataFrames in, lazy DataFrames out."""
