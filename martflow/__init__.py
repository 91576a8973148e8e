"""Staged retail analytics expressed as lazy Spark DataFrame operators."""
