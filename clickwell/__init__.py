"""clickwell: real-time retail analytics as Spark DataFrame transformations."""
