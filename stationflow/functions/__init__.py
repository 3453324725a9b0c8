"""Scalar functions, all composed from built-in Spark expressions."""
