"""Behavioural features and ranking analytics as PySpark DataFrame operators."""
