"""Order and rental analytics as Spark jobs: DataFrames in, DataFrames out."""
