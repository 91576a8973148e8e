"""Queries of the library on the test tables, with an SQL text to check each."""
