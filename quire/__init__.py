"""Document-structure analytics on PySpark: positioned primitives in, verified structured records out."""
