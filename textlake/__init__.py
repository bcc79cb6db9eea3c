"""textlake: text, vector and training-data computations as Spark DataFrame jobs."""
