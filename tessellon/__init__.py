"""Identifier-clique analytics and data preparation on Spark."""
