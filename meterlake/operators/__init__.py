"""Operators: each is a pure ``DataFrame(s) -> DataFrame`` function with column names as parameters."""
