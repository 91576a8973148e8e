"""Operators put together: recipes, star, mart, measures, whole runs."""
