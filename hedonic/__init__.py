"""Property-valuation analytics as Spark DataFrame functions."""
