"""Shop analytics as plain Spark jobs: DataFrames in, DataFrames out."""
